from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fareweather.config import ClusterSettings, ForestSettings
from fareweather.functions import labels
from fareweather.operators import demand_model, quality, zone_model

ROWS = (
    "pickup_date date, pickup_hour long, pickup_day_name string, is_weekend boolean,"
    " pickup_location_id long, pickup_borough string, pickup_zone string,"
    " temperature_2m double, precipitation double, rain double, snowfall double,"
    " wind_speed_10m double, total_trips long"
)


def zone_hours(spark, days=20):
    """Demand that follows the hour and the zone, and doubles in rain."""
    rows = []
    for d in range(days):
        for hour in range(0, 24, 3):
            for zone in range(1, 5):
                rain = 4.0 if (d + hour) % 4 == 0 else 0.0
                trips = (10 * zone + hour) * (2 if rain else 1)
                day = date(2025, 1, 1) + timedelta(days=d)
                rows.append(
                    (day, hour, "x", day.weekday() > 4, zone, f"B{zone % 2}", f"Z{zone}",
                     5.0, rain, None if zone == 4 else rain, 0.0, 1.0, trips)
                )
    return spark.createDataFrame(rows, ROWS)


@pytest.fixture(scope="module")
def rows(spark):
    return demand_model.training_rows(zone_hours(spark)).cache()


def test_training_rows(spark, rows):
    first = rows.filter("pickup_zone = 'Z4' AND precipitation > 0").first()
    assert first["rain"] == 0.0 and first["weather_condition"] == "moderate_rain"
    monday = rows.filter("pickup_date = DATE'2025-01-06'").first()
    assert (monday["pickup_dayofweek"], monday["pickup_day"], monday["is_weekend"]) == (0, 6, 0)
    hidden = zone_hours(spark, 1).withColumn("temperature_2m", F.lit(None).cast("double"))
    assert demand_model.training_rows(hidden).count() == 0


def test_split_loses_nothing(rows):
    train, test = demand_model.time_split(rows, "2025-01-15")
    assert train.count() + test.count() == rows.count()
    assert test.agg(F.min("pickup_date")).first()[0] == date(2025, 1, 15)
    with pytest.raises(demand_model.EmptySplit):
        demand_model.require_both(*demand_model.time_split(rows, "2030-01-01"))


def test_unseen_category_is_minus_one(rows):
    train = rows.filter("pickup_zone <> 'Z2'")
    coded = demand_model.encode(demand_model.fit_codes(train), rows)
    got = {r[0]: r[1] for r in coded.select("pickup_zone", "pickup_zone_ordinal").distinct().collect()}
    assert got == {"Z1": 0.0, "Z2": -1.0, "Z3": 1.0, "Z4": 2.0}
    assert not coded.schema["pickup_zone_ordinal"].metadata


def test_forest_learns_a_planted_signal(spark, rows, tmp_path):
    train, test = demand_model.time_split(rows, "2025-01-15")
    model = demand_model.fit_forest(train, ForestSettings(trees=10, max_depth=10, min_leaf=1))
    scored = demand_model.predict(model, test)
    metrics = demand_model.error_metrics(scored).first()
    baseline = demand_model.mean_baseline(train, test).first()
    assert metrics["mae"] < baseline["baseline_mean_mae"] / 4
    assert metrics["r2"] > 0.9
    importance = demand_model.feature_importance(spark, model)
    assert importance.count() == 14
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    quality.check_predictions(demand_model.published(scored), importance)
    with pytest.raises(quality.QualityError, match="lacks"):
        quality.check_predictions(scored.drop("absolute_error"), importance)
    # The saved model predicts the same.
    from pyspark.ml import PipelineModel

    from fareweather.sources.writers import write_model

    path = write_model(model, str(tmp_path / "model"))
    again = demand_model.predict(PipelineModel.load(path), test)
    assert demand_model.error_metrics(again).first() == metrics


def test_mape(spark):
    df = spark.createDataFrame([(0, 5.0), (10, 5.0), (4, 5.0)], "a long, p double")
    value = demand_model.mape(F.col("a"), F.col("p"))
    assert df.agg(value).first()[0] == 37.5
    assert df.filter("a = 0").agg(value).first()[0] == 0.0


def test_predictions_are_floored(spark, rows):
    scored = rows.withColumn("predicted_total_trips", F.lit(-3.0))
    assert demand_model.as_predictions(scored).first()["predicted_total_trips"] == 0.0


# --- zones -------------------------------------------------------------------


def zones(spark, n=60, groups=3):
    """Zones in clearly separated groups."""
    rng = np.random.default_rng(7)
    rows = [
        (i, f"B{i % 2}", f"Z{i}", *[float(v) for v in 100.0 * (i % groups) + rng.normal(size=14)])
        for i in range(n)
    ]
    names = ", ".join(f"{c} double" for c in zone_model.FEATURES)
    return spark.createDataFrame(rows, f"zone_id long, pickup_borough string, pickup_zone string, {names}")


def test_cluster_count():
    assert [zone_model.cluster_count(n) for n in (20, 45, 116, 60)] == [2, 2, 4, 3]


def test_clip_uses_interpolated_percentiles(spark):
    df = zones(spark, 50)
    column = np.array([r[0] for r in df.select("avg_precipitation").collect()])
    low, high = np.quantile(column, [0.01, 0.99])
    got = [r[0] for r in zone_model.clip_features(df).select("avg_precipitation").collect()]
    assert sorted(got) == pytest.approx(sorted(np.clip(column, low, high)))


def test_standardize_with_a_constant(spark):
    df = zones(spark, 30).withColumn("weather_condition_count", F.lit(0.1))
    got = zone_model.standardize_features(df).toPandas()
    assert abs(got["avg_tip_delta_pct"].mean()) < 1e-9
    assert got["avg_tip_delta_pct"].std(ddof=0) == pytest.approx(1.0)
    assert (got["weather_condition_count"].abs() < 1e-9).all()


def test_missing_and_infinite_numbers_become_zero(spark):
    df = zones(spark, 3).withColumns(
        {
            "avg_precipitation": F.lit(float("inf")),
            "avg_tip_delta_pct": F.lit(float("nan")),
            "avg_fare_delta_amount": F.lit(None).cast("double"),
        }
    )
    row = zone_model.numeric_features(df).first()
    assert (row["avg_precipitation"], row["avg_tip_delta_pct"], row["avg_fare_delta_amount"]) == (0, 0, 0)


def brute_silhouette(points, names):
    widths = []
    for i, p in enumerate(points):
        gaps = np.linalg.norm(points - p, axis=1)
        own = (names == names[i]) & (np.arange(len(points)) != i)
        if not own.any():
            widths.append(0.0)
            continue
        a = gaps[own].mean()
        b = min(gaps[names == other].mean() for other in set(names) - {names[i]})
        widths.append((b - a) / max(a, b))
    return float(np.mean(widths))


def test_clusters_and_silhouette(spark):
    df = zones(spark)
    settings = ClusterSettings(starts=3)
    ready = zone_model.model_input(df, settings)
    model = zone_model.fit_clusters(ready, settings)
    chosen = zone_model.assign_clusters(model, df, ready)
    table = chosen.select("zone_id", "cluster_id").toPandas()
    assert table.groupby(table["zone_id"] % 3)["cluster_id"].nunique().max() == 1
    assert table["cluster_id"].nunique() == 3
    labelled = ready.join(chosen.select("zone_id", "cluster_id"), "zone_id").toPandas()
    points = labelled[list(zone_model.FEATURES)].to_numpy()
    got = zone_model.silhouette(ready, chosen.select("zone_id", "cluster_id")).first()[0]
    assert got == pytest.approx(brute_silhouette(points, labelled["cluster_id"].to_numpy()))
    clusters = zone_model.with_profile(chosen)
    quality.check_clusters(clusters)
    with pytest.raises(quality.QualityError, match="two clusters"):
        quality.check_clusters(clusters.filter("cluster_id = 0"))


def test_same_clusters_and_forest_for_any_layout(spark):
    """What a machine with other cores would give: input in other partitions."""
    df = zones(spark)
    settings = ClusterSettings(starts=2)
    ready = zone_model.model_input(df, settings).persist()

    def chosen(points):
        model = zone_model.fit_clusters(points, settings)
        return sorted(map(tuple, model.transform(points).select("zone_id", "cluster_id").collect()))

    assert chosen(ready.repartition(2)) == chosen(ready.repartition(7).orderBy(F.desc("zone_id")))


def test_silhouette_in_blocks_equals_the_small_one(spark):
    ready = zone_model.model_input(zones(spark))
    for kind in ("int", "string"):
        chosen = ready.select("zone_id", (F.col("zone_id") % 2).cast(kind).alias("cluster_id"))
        small = zone_model.silhouette(ready, chosen).first()[0]
        points = ready.join(chosen, "zone_id").select("zone_id", "cluster_id", F.array(*zone_model.FEATURES).alias("at"))
        blocks = [zone_model.blocked_silhouette(p, 7).first()[0] for p in (points, points.repartition(5))]
        assert blocks[0] == blocks[1] == pytest.approx(small, abs=1e-12)
        assert zone_model.silhouette(ready, chosen, most=5).first()[0] == pytest.approx(small, abs=1e-12)
    one = points.withColumn("cluster_id", F.lit(3))
    assert zone_model.blocked_silhouette(one, 7).first()[0] is None
    lonely = points.withColumn("cluster_id", F.when(F.col("zone_id") == 0, 9).otherwise(F.col("cluster_id").cast("int")))
    want = zone_model.silhouette(ready, lonely.select("zone_id", "cluster_id")).first()[0]
    assert zone_model.blocked_silhouette(lonely, 7).first()[0] == pytest.approx(want, abs=1e-12)
    assert -1 <= zone_model.squared_silhouette(ready, chosen.withColumn("cluster_id", F.col("cluster_id").cast("int"))).first()[0] <= 1


def test_silhouette_of_twenty_thousand_points(spark):
    draw, n = np.random.default_rng(8), 20_000
    x = draw.normal(size=(n, 3)) + 3 * (np.arange(n) % 3)[:, None]
    kind = np.arange(n) % 3
    df = spark.createDataFrame(pd.DataFrame({"zone_id": np.arange(n), "cluster_id": kind, "at": x.tolist()}))
    sums = np.zeros((n, 3))
    for a in range(0, n, 1000):
        apart = np.sqrt(((x[a : a + 1000, None] - x[None]) ** 2).sum(axis=2))
        for c in range(3):
            sums[a : a + 1000, c] = apart[:, kind == c].sum(axis=1)
    size = np.bincount(kind)
    own = sums[np.arange(n), kind] / (size[kind] - 1)
    other = np.where(np.arange(3)[None] == kind[:, None], np.inf, sums / size).min(axis=1)
    want = ((other - own) / np.maximum(own, other)).mean()
    assert zone_model.blocked_silhouette(df).first()[0] == pytest.approx(want, abs=1e-10)


def test_silhouette_edge_cases(spark):
    ready = zones(spark, 5)
    one = ready.select("zone_id", F.lit(0).alias("cluster_id"))
    assert zone_model.silhouette(ready, one).first()[0] is None
    lonely = ready.select("zone_id", F.when(F.col("zone_id") == 0, 1).otherwise(0).alias("cluster_id"))
    points = ready.toPandas()
    want = brute_silhouette(
        points[list(zone_model.FEATURES)].to_numpy(), (points["zone_id"] == 0).astype(int).to_numpy()
    )
    assert zone_model.silhouette(ready, lonely).first()[0] == pytest.approx(want)


ORDERS = {
    labels.PROFILE_HIGH_VOLUME_LIFT: [3, 2, 1],
    labels.PROFILE_HIGH_VOLUME_FAST: [3, 2, 1],
    labels.PROFILE_LOW_VOLUME_FAST: [1, 2, 3],
    labels.PROFILE_SLOW: [2, 3, 1],
    labels.PROFILE_HIGH_VOLUME_SLOW: [2, 3, 1],
    labels.PROFILE_FAST: [1, 3, 2],
    labels.PROFILE_LOWER: [2, 1, 3],
    labels.PROFILE_STABLE: [3, 1, 2],
}


def test_order_inside_a_cluster_follows_its_profile(spark):
    rows = [
        (i, f"{z}", p, lift, minutes, trips)
        for i, p in enumerate(ORDERS)
        for z, lift, minutes, trips in [(1, 5.0, -3.0, 10.0), (2, 1.0, 9.0, 20.0), (3, 8.0, 0.0, 30.0)]
    ]
    df = spark.createDataFrame(
        rows,
        "cluster_id int, pickup_zone string, cluster_profile string, avg_demand_lift_pct double,"
        " avg_duration_delta_minutes double, total_weather_trips double",
    ).withColumns({"zone_id": F.col("pickup_zone").cast("long"), "pickup_borough": F.lit("B")})
    got = zone_model.top_zones_by_cluster(df).orderBy("cluster_id", "zone_rank").collect()
    order = {p: [int(r["pickup_zone"]) for r in got if r["cluster_profile"] == p] for p in ORDERS}
    assert order == ORDERS
    assert zone_model.top_zones_by_cluster(df, 2).count() == 2 * len(ORDERS)


def test_settings_can_change():
    assert replace(ClusterSettings(), starts=1).starts == 1


def test_error_figures_and_features_equal_to_the_bit(spark):
    draw = np.random.default_rng(11)
    rows = [(int(n), float(g)) for n, g in zip(draw.integers(0, 50_000, 3000), draw.uniform(0, 50_000, 3000))] + [(0, 1 / 3)]
    df = spark.createDataFrame(rows, "total_trips long, exact_prediction double")
    got = [tuple(demand_model.error_metrics(d).first()) for d in (df.repartition(1), df.repartition(7), df.orderBy(F.desc("exact_prediction")))]
    assert got[0] == got[1] == got[2]
    y, p = np.array(rows).T
    n, mae, rmse, r2, mape = got[0]
    assert n == 3001 and mae == pytest.approx(np.abs(y - p).mean()) and rmse == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert mape == pytest.approx((np.abs(y - p)[y != 0] / y[y != 0]).mean() * 100)
    points = zones(spark, 300)
    ways = [zone_model.standardize_features(d).orderBy("zone_id").select(*zone_model.FEATURES).collect() for d in (points.repartition(1), points.repartition(9))]
    assert ways[0] == ways[1]
    none = demand_model.error_metrics(df.where("false")).first()
    assert none["test_rows"] == 0 and none["mae"] is None and none["mape_percent"] == 0.0


def test_parts_of_a_fit_follow_from_the_rows():
    parts = ForestSettings().parts
    assert [parts(n) for n in (0, 1, 2_500, 2_501, 17_000, 200_000, 3_200_000, 10_000_000)] == [1, 1, 1, 2, 7, 64, 64, 200]
