"""Interactive questions over the published tables: filters, totals, top lists.

All functions take the tables of the other modules, which are small next to the
trips. Still nothing is gathered in one task except rows that are already one
per group or limited by a top-k.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import IntegralType

from fareweather.config import CLEAR
from fareweather.functions.labels import condition_rank
from fareweather.functions.local import local_rows
from fareweather.functions.numeric import (
    exact_avg,
    exact_sum,
    round_half,
    strict_weighted_mean,
)
from fareweather.operators import order_statistics

ALL = "All"
WEEKDAYS, WEEKENDS = "Weekdays", "Weekends"


# --- column choice -----------------------------------------------------------


def first_existing(df: DataFrame, candidates: Iterable[str]) -> str | None:
    return next((name for name in candidates if name in df.columns), None)


def select_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The wanted columns the frame has; the frame itself when it has none."""
    present = [name for name in columns if name in df.columns]
    return df.select(*present) if present else df


#: Names under which predictions, actual values and errors are stored.
PREDICTION_NAMES = {
    "total_trips": ("actual_total_trips", "actual_trips", "total_trips", "y_actual"),
    "predicted_total_trips": ("predicted_total_trips", "predicted_trips", "prediction", "y_pred"),
    "absolute_error": ("absolute_error", "abs_error", "prediction_abs_error"),
}


def named_predictions(predictions: DataFrame) -> DataFrame:
    """Predictions under the names of this engine, whatever names they are stored under.

    Of several columns for one thing the first of its list is taken; the others go. An
    absolute error that is not stored is the difference of the other two.
    """
    chosen = {name: first_existing(predictions, known) for name, known in PREDICTION_NAMES.items()}
    known = {c for names in PREDICTION_NAMES.values() for c in names}
    rest = [F.col(f"`{c}`") for c in predictions.columns if c not in known]
    named = [F.col(source).alias(name) for name, source in chosen.items() if source]
    found = predictions.select(*rest, *named)
    if chosen["absolute_error"] or not (chosen["total_trips"] and chosen["predicted_total_trips"]):
        return found
    return with_absolute_error(found)


def normal_types(df: DataFrame) -> DataFrame:
    """Date and weekend columns in their own types, when present."""
    kinds = {"pickup_date": "date", "is_weekend": "boolean"}
    return df.withColumns({c: F.col(c).cast(k) for c, k in kinds.items() if c in df.columns})


# --- filters -----------------------------------------------------------------


def with_value(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose text equals the value; ``All`` or a missing column passes."""
    if value == ALL or column not in df.columns:
        return df
    return df.filter(F.col(column).cast("string") == str(value))


def with_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Rows whose text is in the list; an empty list or missing column passes."""
    values = [str(v) for v in values]
    if not values or column not in df.columns:
        return df
    return df.filter(F.col(column).cast("string").isin(values))


def with_day_type(df: DataFrame, days: str) -> DataFrame:
    if days not in (WEEKDAYS, WEEKENDS) or "is_weekend" not in df.columns:
        return df
    return df.filter(F.col("is_weekend").cast("boolean") == F.lit(days == WEEKENDS))


def with_min_trips(df: DataFrame, least: int) -> DataFrame:
    return df.filter(F.col("total_trips") >= least)


def explore(
    df: DataFrame,
    borough: str = ALL,
    conditions: Iterable[str] = (),
    days: str = "",
    borough_column: str = "pickup_borough",
) -> DataFrame:
    """The three common filters together."""
    df = with_value(df, borough_column, borough)
    df = with_values(df, "weather_condition", conditions)
    return with_day_type(df, days)


def filter_options(
    elasticity: DataFrame, hidden: Iterable[str] = ("EWR", "Unknown", "nan")
) -> DataFrame:
    """Choices of the borough and the condition filter, each in its order."""
    boroughs = (
        elasticity.select(F.col("pickup_borough").cast("string").alias("value"))
        .filter(F.col("value").isNotNull() & ~F.col("value").isin(list(hidden)))
        .distinct()
        .select(F.lit("borough").alias("filter"), "value", F.lit(0).cast("bigint").alias("rank"))
    )
    conditions = (
        elasticity.select(F.col("weather_condition").alias("value"))
        .filter(F.col("value").isNotNull())
        .distinct()
        .select(
            F.lit("weather_condition").alias("filter"),
            "value",
            condition_rank(F.col("value")).cast("bigint").alias("rank"),
        )
        .filter("rank < 99")
    )
    return boroughs.unionByName(conditions).orderBy("filter", "rank", "value")


# --- weighted statistics -----------------------------------------------------


def weighted_average(df: DataFrame, value: str, weight: str) -> Column:
    """Aggregate expression; 0 when no row has a value and a positive weight.

    ``df`` only tells which columns exist.
    """
    if value not in df.columns or weight not in df.columns:
        return F.lit(0.0)
    whole = isinstance(df.schema[weight].dataType, IntegralType)
    return F.coalesce(strict_weighted_mean(value, weight, whole), F.lit(0.0))


def weighted_medians(df: DataFrame, values: Mapping[str, str], weight: str) -> DataFrame:
    """Lower weighted medians, exact: the first value at half of all weight.

    One row per measure with a value; they are taken by a few small jobs when the
    frame is built, see :mod:`fareweather.operators.order_statistics`.
    """
    found = order_statistics.weighted_medians(df, values, weight)
    return local_rows(df.sparkSession, {"measure": "STRING", "weighted_median": "DOUBLE"}, found.items())


def weighted_median(df: DataFrame, value: str, weight: str) -> DataFrame:
    """One row; 0 when no row has a value and a positive weight."""
    if value not in df.columns or weight not in df.columns:
        return df.sparkSession.range(1).select(F.lit(0.0).alias("weighted_median"))
    found = weighted_medians(df, {value: value}, weight)
    return found.agg(F.coalesce(F.max("weighted_median"), F.lit(0.0)).alias("weighted_median"))


def rainy_day_share(hourly_weather: DataFrame, more_than: float = 0.1) -> DataFrame:
    """Percentage of days whose mean hourly rain exceeds a limit."""
    days = (
        hourly_weather.filter(F.col("pickup_date").isNotNull())
        .groupBy("pickup_date")
        .agg(exact_avg("rain").alias("rain"))
    )
    return share_of_rainy_days(days, more_than)


def share_of_rainy_days(days: DataFrame, more_than: float = 0.1) -> DataFrame:
    """The share from the mean rain of each day."""
    wet = F.count_if(F.col("rain") > more_than)
    share = F.try_divide(wet.cast("double"), F.count(F.lit(1))) * 100.0
    return days.agg(F.coalesce(share, F.lit(0.0)).alias("rainy_day_share"))


#: Measures shown with their weighted mean and median.
#: The columns by name.
KPI_MEASURES = {
    "fare": "avg_total_amount",
    "duration": "avg_trip_duration_minutes",
    "distance": "avg_trip_distance",
}


def overview_kpis(hourly_weather: DataFrame) -> DataFrame:
    trips = F.coalesce(F.sum("total_trips"), F.lit(0))
    days = F.countDistinct("pickup_date")
    per_day = F.coalesce(F.try_divide(trips.cast("double"), days), F.lit(0.0))
    totals = hourly_weather.agg(
        trips.alias("total_trips"),
        days.alias("pickup_days"),
        per_day.alias("avg_trips_per_day"),
        F.coalesce(exact_sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
        *[
            weighted_average(hourly_weather, source, "total_trips").alias(f"avg_{name}")
            for name, source in KPI_MEASURES.items()
        ],
    )
    medians = order_statistics.weighted_medians(hourly_weather, KPI_MEASURES, "total_trips")
    return totals.withColumns(
        {"rainy_day_share": rainy_day_share(hourly_weather).scalar()}
        | {f"median_{name}": F.lit(medians.get(name, 0.0)) for name in KPI_MEASURES}
    )


# --- trends and patterns -----------------------------------------------------


def daily_trend(hourly_weather: DataFrame) -> DataFrame:
    rain = (
        exact_avg("precipitation")
        if "precipitation" in hourly_weather.columns
        else F.count(F.lit(1)).cast("double")
    )
    return (
        hourly_weather.filter(F.col("pickup_date").isNotNull())
        .groupBy("pickup_date")
        .agg(F.sum("total_trips").alias("total_trips"), rain.alias("avg_precipitation"))
        .orderBy("pickup_date")
    )


def hourly_pattern(hourly_weather: DataFrame) -> DataFrame:
    return (
        hourly_weather.filter(F.col("pickup_hour").isNotNull())
        .groupBy("pickup_hour")
        .agg(F.sum("total_trips").alias("total_trips"))
        .orderBy("pickup_hour")
    )


def hourly_pattern_by_day_type(hourly_weather: DataFrame) -> DataFrame:
    """Weekday and weekend patterns below each other, from one grouping."""
    day_type = F.when(F.col("is_weekend"), WEEKENDS).otherwise(WEEKDAYS)
    return (
        hourly_weather.filter("pickup_hour IS NOT NULL AND is_weekend IS NOT NULL")
        .groupBy("pickup_hour", day_type.alias("day_type"))
        .agg(F.sum("total_trips").alias("total_trips"))
        .orderBy("pickup_hour", "day_type")
    )


# --- zones -------------------------------------------------------------------

ZONE = ("pickup_location_id", "pickup_borough", "pickup_zone")
#: The measures of a zone, those that a table has.
ZONE_METRICS = (
    "avg_total_amount",
    "avg_trip_duration_minutes",
    "avg_trip_distance",
    "avg_speed_mph",
    "avg_tip_percentage",
    "avg_tip_pct",
)


def regroup_zones(hourly: DataFrame, fallback: DataFrame) -> DataFrame:
    """Zone totals of a filtered hourly table.

    The fallback table stands in when the columns are missing; for an empty
    input use :func:`zones_or_fallback`. A zone-hour without a metric is left
    out for that metric only.
    """
    if not set(ZONE) | {"total_trips"} <= set(hourly.columns):
        return fallback
    trips = F.coalesce(F.col("total_trips").cast("bigint"), F.lit(0))
    work = hourly.dropna(subset=list(ZONE)).withColumn("total_trips", trips)
    measures = [F.sum("total_trips").alias("total_trips")]
    if "total_revenue" in hourly.columns:
        measures.append(F.coalesce(exact_sum("total_revenue"), F.lit(0.0)).alias("total_revenue"))
    measures += [
        strict_weighted_mean(name, "total_trips", whole=True).alias(name)
        for name in ZONE_METRICS
        if name in hourly.columns
    ]
    return work.groupBy(*ZONE).agg(*measures)


def zones_or_fallback(hourly: DataFrame, fallback: DataFrame) -> DataFrame:
    """As :func:`regroup_zones`, with the fallback for an empty input."""
    return fallback if hourly.isEmpty() else regroup_zones(hourly, fallback)


def map_values(
    zones: DataFrame,
    id_column: str,
    metric: str,
    by_borough: bool = False,
    total: bool = False,
    log: bool = False,
    keep_missing: bool = False,
) -> DataFrame:
    """The value and colour value of each zone on a map.

    ``total`` adds the zones of a borough up, otherwise they are averaged.
    ``keep_missing`` shows zones without the metric as 0 instead of dropping
    them.
    """
    key = F.col(id_column).try_cast("double").try_cast("bigint").cast("string")
    number = F.col(metric).cast("double")
    if keep_missing:
        number = F.coalesce(number, F.lit(0.0))
    placed = zones.withColumns({"map_id": key, metric: number}).dropna(subset=["map_id", metric])
    value = F.col(metric)
    if by_borough:
        # A zone without a borough has no group to show, and joins none.
        shown = (exact_sum if total else exact_avg)(value)
        groups = placed.groupBy("pickup_borough").agg(shown.alias("_shown"))
        groups = groups.withColumnRenamed("pickup_borough", "_borough")
        placed = placed.join(groups, F.col("pickup_borough") == F.col("_borough"), "left")
        placed = placed.withColumn("display_value", F.col("_shown")).drop("_borough", "_shown")
        value = F.col("display_value")
    placed = placed.withColumn("display_value", value)
    shown = F.col("display_value")
    # greatest would turn a null into the 0.
    colour = F.when(shown < 0, 0.0).otherwise(F.log1p(shown)) if log else shown
    return placed.withColumn("map_color_value", colour)


def map_domain(values: DataFrame) -> DataFrame:
    return values.agg(
        F.min("display_value").alias("min_value"), F.max("display_value").alias("max_value")
    )


# --- top lists ---------------------------------------------------------------


def top_by(df: DataFrame, metric: str, n: int, *ties: str, ascending: bool = False) -> DataFrame:
    """The first n rows by a metric, nulls last, ties by the given keys.

    ``orderBy`` with ``limit`` keeps n rows per task; nothing else is moved.
    """
    order = F.asc_nulls_last(metric) if ascending else F.desc_nulls_last(metric)
    return df.orderBy(order, *[F.asc_nulls_last(t) for t in ties]).limit(n)


def top_pickup_zones(zone_summary: DataFrame, n: int = 10) -> DataFrame:
    top = top_by(zone_summary, "total_trips", n, "pickup_location_id")
    return top.select("pickup_borough", "pickup_zone", "total_trips", "total_revenue")


def top_sensitive_zones(elasticity: DataFrame, n: int = 10, baseline: str = CLEAR) -> DataFrame:
    rows = elasticity.filter(F.col("weather_condition") != baseline)
    return top_by(rows, "demand_lift_pct", n, "zone_id", "weather_condition").select(
        "zone_id",
        "pickup_borough",
        "pickup_zone",
        "weather_condition",
        "demand_lift_pct",
        "duration_delta_minutes",
        "weather_sensitivity_label",
    )


def top_elastic_zones(
    elasticity: DataFrame, metric: str, n: int = 10, min_trips: int = 50
) -> DataFrame:
    rows = with_min_trips(elasticity, min_trips)
    return top_by(rows, metric, n, "zone_id", "weather_condition")


def with_route(flows: DataFrame) -> DataFrame:
    names = [F.coalesce(F.col(c), F.lit("None")) for c in ("origin_zone", "destination_zone")]
    return flows.withColumn("route", F.concat_ws(" → ", *names))


def top_routes(flows: DataFrame, n: int = 10) -> DataFrame:
    keys = ("origin_location_id", "destination_location_id", "weather_condition")
    return top_by(with_route(flows), "trip_count", n, *keys)


def best_conditions(impact: DataFrame) -> DataFrame:
    """The condition that leads in each metric, with its value."""
    metrics = ["demand_lift_pct", "duration_delta_minutes", "fare_delta_amount", "total_trips"]
    leaders = impact.agg(
        *[
            F.max_by(
                F.struct(
                    F.lit(m).alias("metric"),
                    "weather_condition",
                    F.col(m).cast("double").alias("value"),
                ),
                # Ties go to the condition shown first.
                F.struct(F.col(m), -condition_rank(F.col("weather_condition"))),
            ).alias(m)
            for m in metrics
        ]
    )
    return leaders.select(F.inline(F.array(*metrics)))


# --- predictions -------------------------------------------------------------


def with_absolute_error(predictions: DataFrame) -> DataFrame:
    if "absolute_error" in predictions.columns:
        return predictions
    error = F.abs(F.col("total_trips") - F.col("predicted_total_trips"))
    return predictions.withColumn("absolute_error", error)


def daily_predictions(predictions: DataFrame) -> DataFrame:
    """Actual and predicted trips per date in long form."""
    daily = predictions.groupBy("pickup_date").agg(
        F.sum("total_trips").cast("double").alias("actual_total_trips"),
        exact_sum("predicted_total_trips").alias("predicted_total_trips"),
    )
    return daily.unpivot(
        "pickup_date", ["actual_total_trips", "predicted_total_trips"], "series", "trips"
    ).orderBy("pickup_date", "series")


def error_histogram(predictions: DataFrame, bins: int = 60) -> DataFrame:
    """Rows per equal-width bin of the absolute error."""
    rows = with_absolute_error(predictions).select("absolute_error").dropna()
    ends = rows.agg(
        F.struct(F.min("absolute_error").alias("low"), F.max("absolute_error").alias("high"))
    ).scalar()
    low, high = ends.getField("low"), ends.getField("high")
    width = (high - low) / bins
    place = F.coalesce(F.floor(F.try_divide(F.col("absolute_error") - low, width)), F.lit(0))
    place = F.least(place, F.lit(bins - 1)).cast("bigint")
    return (
        rows.groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select("bin", round_half(low + F.col("bin") * width, 4).alias("bin_start"), "row_count")
        .orderBy("bin")
    )


def prediction_sample(predictions: DataFrame, n: int = 100) -> DataFrame:
    keys = ["pickup_date", "pickup_hour", "pickup_location_id"]
    sample = with_absolute_error(predictions).orderBy(*keys).limit(n)
    return select_existing(
        sample,
        [
            "pickup_date",
            "pickup_hour",
            "pickup_borough",
            "pickup_zone",
            "weather_condition",
            "total_trips",
            "predicted_total_trips",
            "absolute_error",
        ],
    )


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    return top_by(importance, "importance", n, "feature")


# --- clusters ----------------------------------------------------------------


def cluster_distribution(clusters: DataFrame, column: str = "cluster_profile") -> DataFrame:
    return (
        clusters.groupBy(column)
        .agg(F.countDistinct("pickup_zone").alias("zone_count"))
        .orderBy(F.desc("zone_count"), column)
    )


def candidate_zones(clusters: DataFrame, n: int = 10) -> DataFrame:
    """Zones in groups named for a strong reaction, strongest lift first."""
    named = F.col("cluster_profile").cast("string").rlike("(?i)high|lift|demand|sensitive")
    rows = clusters.filter(F.coalesce(named, F.lit(False)))
    return select_existing(
        top_by(rows, "avg_demand_lift_pct", n, "zone_id"),
        [
            "pickup_borough",
            "pickup_zone",
            "cluster_id",
            "cluster_profile",
            "total_weather_trips",
            "avg_demand_lift_pct",
            "avg_duration_delta_minutes",
            "avg_fare_delta_amount",
            "avg_tip_delta_pct",
        ],
    )
