"""Groups of zones by their reaction to the condition.

A zone is one row here, so the tables are bounded by the number of valid zone
ids, whatever the number of trips.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Row, Window as W, functions as F

from fareweather.config import CLEAR, ClusterSettings, ProfileThresholds
from fareweather.config import HIGH_LABEL, MEDIUM_LABEL
from fareweather.functions.labels import group_profile
from fareweather.operators import order_statistics
from fareweather.functions.numeric import exact_avg, exact_sum, finite, round_even, round_half

#: The model's input in its order.
FEATURES = (
    "total_weather_trips",
    "total_weather_zone_hours",
    "weather_condition_count",
    "avg_demand_lift_pct",
    "max_demand_lift_pct",
    "avg_duration_delta_minutes",
    "max_duration_delta_minutes",
    "avg_minutes_per_mile_delta",
    "max_minutes_per_mile_delta",
    "avg_fare_delta_amount",
    "avg_tip_delta_pct",
    "avg_precipitation",
    "high_sensitive_condition_count",
    "medium_sensitive_condition_count",
)


def _mean4(name: str) -> Column:
    return round_half(exact_avg(name), 4)


def zone_features(
    elasticity: DataFrame, min_trips: int = 100, baseline: str = CLEAR
) -> DataFrame:
    """One row per named zone with its reaction over all other conditions."""
    label = F.col("weather_sensitivity_label")
    return (
        elasticity.filter(F.col("weather_condition") != baseline)
        .dropna(subset=["pickup_zone", "pickup_borough", "demand_lift_pct"])
        .groupBy("zone_id", "pickup_borough", "pickup_zone")
        .agg(
            F.sum("total_trips").alias("total_weather_trips"),
            F.sum("total_zone_hours").alias("total_weather_zone_hours"),
            # A zone has one row per condition.
            F.count("weather_condition").alias("weather_condition_count"),
            _mean4("demand_lift_pct").alias("avg_demand_lift_pct"),
            round_half(F.max("demand_lift_pct"), 4).alias("max_demand_lift_pct"),
            _mean4("duration_delta_minutes").alias("avg_duration_delta_minutes"),
            round_half(F.max("duration_delta_minutes"), 4).alias("max_duration_delta_minutes"),
            _mean4("minutes_per_mile_delta").alias("avg_minutes_per_mile_delta"),
            round_half(F.max("minutes_per_mile_delta"), 4).alias("max_minutes_per_mile_delta"),
            _mean4("fare_delta_amount").alias("avg_fare_delta_amount"),
            _mean4("tip_delta_pct").alias("avg_tip_delta_pct"),
            _mean4("avg_precipitation").alias("avg_precipitation"),
            F.count_if(label == HIGH_LABEL).alias("high_sensitive_condition_count"),
            F.count_if(label == MEDIUM_LABEL).alias("medium_sensitive_condition_count"),
        )
        .filter(F.col("total_weather_trips") >= min_trips)
    )


def numeric_features(zones: DataFrame) -> DataFrame:
    """Features as doubles; missing and infinite values become 0."""
    return zones.withColumns({c: F.coalesce(finite(F.col(c)), F.lit(0.0)) for c in FEATURES})


def _statistics(df: DataFrame, **of: Column) -> Row:
    """Aggregates over the whole frame, as an estimator's fit takes them."""
    return df.agg(*[c.alias(name) for name, c in of.items()]).first()


def clip_features(
    zones: DataFrame, low: float = 0.01, high: float = 0.99, approximate: bool = False
) -> DataFrame:
    """Each feature limited to its own low and high percentile.

    The percentiles are exact and interpolated, whatever the number of rows: they are
    found for all features at once by radix descent. ``approximate`` takes one pass.
    """
    if approximate:
        limits = _statistics(zones, **{c: F.percentile_approx(F.col(c), [low, high]) for c in FEATURES}).asDict()
    else:
        limits = order_statistics.percentiles(zones, FEATURES, (low, high))
    return zones.withColumns(
        {
            c: F.least(F.greatest(F.col(c), F.lit(limits[c][0])), F.lit(limits[c][1]))
            for c in FEATURES
            if limits.get(c) is not None
        }
    )


def standardize_features(zones: DataFrame) -> DataFrame:
    """Zero mean and unit population deviation; constant features only centred.

    Both figures come from exact sums, of the values and then of the squares of what
    differs from the mean, so they do not depend on how the rows are laid out.
    """
    means = _statistics(zones, **{f"mean_{c}": exact_avg(c) for c in FEATURES}).asDict()
    away = {c: f"({c} - double('{means[f'mean_{c}']!r}'))" for c in FEATURES if means[f"mean_{c}"] is not None}
    spreads = {f"spread_{c}": F.sqrt(exact_avg(f"{x} * {x}")) for c, x in away.items()}
    measured = dict.fromkeys([f"spread_{c}" for c in FEATURES]) | means
    if spreads:
        measured |= _statistics(zones, **spreads).asDict()

    def unit(c: str) -> Column:
        mean, spread = measured[f"mean_{c}"], measured[f"spread_{c}"]
        # A constant feature may show a spread of rounding noise only.
        constant = spread is None or spread <= abs(mean) * 1e-12
        return (F.col(c) - F.lit(mean)) / F.lit(1.0 if constant else spread)

    return zones.withColumns({c: unit(c) for c in FEATURES})


def cluster_count(zones: int, settings: ClusterSettings = ClusterSettings()) -> int:
    return min(settings.most, max(settings.least, zones // settings.zones_per_cluster))


def model_input(zones: DataFrame, settings: ClusterSettings = ClusterSettings()) -> DataFrame:
    """Clipped and standardised features as a vector column."""
    ready = standardize_features(clip_features(numeric_features(zones), *settings.clip))
    return ready.withColumn("features", array_to_vector(F.array(*FEATURES)))


def fit_clusters(ready: DataFrame, settings: ClusterSettings = ClusterSettings()) -> KMeansModel:
    """The best of several k-means starts by within-cluster cost.

    The starts, which are mostly job overhead, run side by side. What a start draws
    follows from the partition and place of the points, so both come from the zone
    ids and the settings.
    """
    points = (
        ready.select("zone_id", "features")
        .repartition(settings.partitions, "zone_id")
        .sortWithinPartitions("zone_id")
        .select("features")
        .persist()
    )
    try:
        k = cluster_count(points.count(), settings)

        def fit(start: int) -> KMeansModel:
            return KMeans(
                k=k,
                seed=settings.seed + start,
                maxIter=settings.max_iter,
                tol=settings.tolerance,
                featuresCol="features",
                predictionCol="cluster_id",
            ).fit(points)

        with ThreadPoolExecutor(settings.parallel_fits) as pool:
            models = list(pool.map(fit, range(settings.starts)))
        # Costs are sums of doubles in the order in which tasks end: what differs in
        # the last digits is equal, and the first start wins.
        return min(models, key=lambda m: float(f"{m.summary.trainingCost:.9e}"))
    finally:
        points.unpersist()


def assign_clusters(model: KMeansModel, zones: DataFrame, ready: DataFrame) -> DataFrame:
    """Cluster of each zone beside its features before clipping."""
    chosen = model.transform(ready).select("zone_id", "cluster_id")
    return numeric_features(zones).join(chosen, "zone_id")


def group_summary(
    zones: DataFrame,
    group: str = "cluster_id",
    limits: ProfileThresholds = ProfileThresholds(),
) -> DataFrame:
    """Size, volume, mean reaction and profile of each group of zones."""
    means = [
        "avg_demand_lift_pct",
        "max_demand_lift_pct",
        "avg_duration_delta_minutes",
        "avg_minutes_per_mile_delta",
        "avg_fare_delta_amount",
        "avg_tip_delta_pct",
        "high_sensitive_condition_count",
    ]
    summary = zones.groupBy(group).agg(
        F.count(F.lit(1)).alias("zone_count"),
        F.sum("total_weather_trips").alias("total_weather_trips"),
        *[exact_avg(c).alias(c) for c in means],
    )
    profile = group_profile(
        F.col("avg_demand_lift_pct"),
        F.col("avg_duration_delta_minutes"),
        F.col("avg_minutes_per_mile_delta"),
        F.col("total_weather_trips"),
        F.col("zone_count"),
        limits,
    )
    return summary.withColumn("cluster_profile", profile)


def rounded_summary(summary: DataFrame) -> DataFrame:
    """The summary as it is reported, four decimals."""
    doubles = [f.name for f in summary.schema if f.dataType.typeName() == "double"]
    return summary.withColumns({c: round_even(F.col(c), 4) for c in doubles})


def with_profile(
    zones: DataFrame,
    group: str = "cluster_id",
    limits: ProfileThresholds = ProfileThresholds(),
) -> DataFrame:
    """Zones with the profile of their group, a handful of rows that is joined."""
    profiles = group_summary(zones, group, limits).select(group, "cluster_profile")
    names = dict.fromkeys(["zone_id", "pickup_borough", "pickup_zone", group, "cluster_profile"])
    return zones.join(profiles, group, "left").select(*names, *FEATURES)


def ordered_clusters(clusters: DataFrame) -> DataFrame:
    return clusters.orderBy("cluster_id", F.desc_nulls_last("avg_demand_lift_pct"), "zone_id")


# Ranking of the zones inside a group, by the wording of its profile: all words
# of an entry have to occur; the first fitting entry wins. A minus sign means
# largest first. Fixed values.
_RANKINGS = (
    (("high-volume", "high demand"), ("-total_weather_trips", "-avg_demand_lift_pct")),
    (
        ("high-volume", "lower demand"),
        ("-total_weather_trips", "avg_duration_delta_minutes", "avg_demand_lift_pct"),
    ),
    (
        ("low-volume", "lower demand"),
        ("total_weather_trips", "avg_duration_delta_minutes", "avg_demand_lift_pct"),
    ),
    (("duration",), ("-avg_duration_delta_minutes",)),
    (("faster",), ("avg_duration_delta_minutes",)),
    (("lower demand",), ("avg_demand_lift_pct",)),
    ((), ("-avg_demand_lift_pct",)),
)


def _ranking_keys(profile: Column) -> list[Column]:
    """Three sort keys whose meaning follows from the row's profile."""

    def signed(keys: tuple[str, ...], place: int) -> Column:
        if place >= len(keys):
            return F.lit(0.0)
        name = keys[place]
        value = F.col(name.lstrip("-")).cast("double")
        return -value if name.startswith("-") else value

    keys = []
    for place in range(3):
        chain = F
        for words, order in _RANKINGS:
            fits = F.lit(True)
            for word in words:
                fits = fits & F.lower(profile).contains(word)
            chain = chain.when(fits, signed(order, place))
        keys.append(F.asc_nulls_last(chain.otherwise(None)))
    return keys


_TOP_COLUMNS = (
    "zone_rank",
    "pickup_borough",
    "pickup_zone",
    "cluster_profile",
    "avg_demand_lift_pct",
    "avg_duration_delta_minutes",
    "total_weather_trips",
)


def top_zones_by_cluster(clusters: DataFrame, n: int = 10, group: str = "cluster_id") -> DataFrame:
    """The first n zones of each group in the order its profile asks for."""
    order = W.partitionBy(group).orderBy(*_ranking_keys(F.col("cluster_profile")), "zone_id")
    return (
        clusters.withColumn("zone_rank", F.row_number().over(order).cast("bigint"))
        .filter(F.col("zone_rank") <= n)
        .select(*dict.fromkeys([group, *_TOP_COLUMNS]))
    )


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def silhouette(ready: DataFrame, chosen: DataFrame, most: int = 10_000) -> DataFrame:
    """Exact mean silhouette with Euclidean distance; null for one cluster.

    Zone ids are unique. Up to ``most`` points go to every task as one value, and each
    point sums its distances on its own; above, distances are summed in pairs of
    blocks (:func:`blocked_silhouette`). No pairs of points are emitted. In linear
    time, with squared distances, there is :func:`squared_silhouette`.
    """
    points = ready.join(chosen, "zone_id").select("zone_id", "cluster_id", F.array(*FEATURES).alias("at"))
    if points.limit(most + 1).count() > most:
        return blocked_silhouette(points)
    groups = points.groupBy("cluster_id").agg(F.sort_array(F.collect_list("at")).alias("all"))
    groups = groups.agg(F.sort_array(F.collect_list(F.struct("cluster_id", "all"))).alias("groups"))
    placed = points.withColumn("groups", groups.scalar())

    def mean(g: Column) -> Column:
        own = g["cluster_id"] == F.col("cluster_id")
        total = F.aggregate(g["all"], F.lit(0.0), lambda s, p: s + _distance(F.col("at"), p))
        others = F.size(g["all"]) - F.when(own, 1).otherwise(0)
        return F.struct(own.alias("own"), F.try_divide(total, others).alias("mean"))

    means = placed.select(F.transform("groups", mean).alias("means"))
    inside = F.element_at(F.filter("means", lambda m: m["own"]), 1)["mean"]
    outside = F.array_min(F.transform(F.filter("means", lambda m: ~m["own"]), lambda m: m["mean"]))
    larger = F.greatest(inside, outside)
    # A zone alone in its cluster counts as 0; a single cluster has no score.
    width = F.when(inside.isNull() | (larger == 0), 0.0).otherwise((outside - inside) / larger)
    widths = means.select(F.when(outside.isNotNull(), width).alias("width"))
    return widths.agg(exact_avg("width").alias("silhouette_score"))


def _block_sums(batches):
    """Of each pair of blocks the distances of every point to the other block's
    clusters, added up: one row a point and cluster, in both directions."""
    import numpy as np
    import pyarrow as pa

    def unpacked(members):
        values = members.values
        at = values.field("at").flatten().to_numpy().reshape(len(values), -1)
        return values.field("zone_id"), values.field("cluster_id").to_numpy(), at

    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            ids, kinds, a = unpacked(pa.concat_arrays([row.column("members")]))
            other_ids, other_kinds, b = unpacked(pa.concat_arrays([row.column("others")]))
            apart = np.zeros((len(a), len(b)))
            for f in range(a.shape[1]):
                step = a[:, f, None] - b[None, :, f]
                apart += step * step
            apart = np.sqrt(apart)
            same = row.column("block")[0].as_py() == row.column("other")[0].as_py()
            ways = [(ids, apart, other_kinds)] + ([] if same else [(other_ids, apart.T, kinds)])
            for own, distance, towards in ways:
                order = np.argsort(towards, kind="stable")
                names, first = np.unique(towards[order], return_index=True)
                sums = np.add.reduceat(distance[:, order], first, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(np.repeat(np.arange(len(own)), len(names)))), pa.array(np.tile(names, len(own))), pa.array(sums.ravel())],
                    names=["zone_id", "towards", "distance"],
                )


def blocked_silhouette(points: DataFrame, block: int = 1024) -> DataFrame:
    """The exact silhouette of any number of points (zone_id, cluster_id, at).

    Points are dealt into blocks of about ``block`` by their id. A task takes two blocks
    and gives one sum for each point and cluster; only these are shuffled. The work is
    quadratic, as the figure is. Sums of blocks are added exactly, so the answer does
    not depend on the order in which tasks end.
    """
    rows = points.count()
    blocks = max(1, -(-rows // block))
    kind = dict(points.dtypes)["zone_id"]
    # Clusters may have names of any type; only whether they are equal counts.
    dealt = points.select("zone_id", F.xxhash64("cluster_id").alias("cluster_id"), "at", F.pmod(F.xxhash64("zone_id"), F.lit(blocks)).alias("block"))
    held = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("zone_id", "cluster_id", "at"))).alias("members"))
    left = held.select("block", "members", F.explode(F.sequence(F.col("block"), F.lit(blocks - 1).cast("long"))).alias("other"))
    right = held.select(F.col("block").alias("other"), F.col("members").alias("others"))
    # Block pairs are the unit of work, so they are spread evenly before it.
    pairs = left.join(right, "other").select("block", "other", "members", "others").repartition(min(blocks * blocks, 2000), "block", "other")
    sums = pairs.mapInArrow(_block_sums, f"zone_id {kind}, towards long, distance double")
    totals = sums.groupBy("zone_id", "towards").agg(exact_sum("distance").alias("total"))
    sizes = dealt.groupBy("cluster_id").count()
    own = F.col("cluster_id") == F.col("towards")
    means = (
        totals.join(dealt.select("zone_id", "cluster_id"), "zone_id")
        .join(sizes.select(F.col("cluster_id").alias("towards"), "count"), "towards")
        .withColumn("mean", F.try_divide(F.col("total"), F.col("count") - F.when(own, 1).otherwise(0)))
        .groupBy("zone_id")
        .agg(F.max(F.when(own, F.col("mean"))).alias("inside"), F.min(F.when(~own, F.col("mean"))).alias("outside"))
    )
    larger = F.greatest("inside", "outside")
    width = F.when(F.col("inside").isNull() | (larger == 0), 0.0).otherwise((F.col("outside") - F.col("inside")) / larger)
    widths = means.select(F.when(F.col("outside").isNotNull(), width).alias("width"))
    return widths.agg(exact_avg("width").alias("silhouette_score"))


def squared_silhouette(ready: DataFrame, chosen: DataFrame) -> DataFrame:
    """Mean silhouette with squared distances, in time linear in the points."""
    points = ready.join(chosen, "zone_id").select("features", "cluster_id")
    spark = points.sparkSession
    if points.select("cluster_id").distinct().count() < 2:
        return spark.range(1).select(F.lit(None).cast("double").alias("squared_silhouette_score"))
    score = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id").evaluate(points)
    return spark.range(1).select(F.lit(score).alias("squared_silhouette_score"))
