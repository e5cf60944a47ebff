"""Analysis tables over zone-hours with their condition, and route flows.

The averages of a zone-hour are rounded before they are weighted here, and the
lifts use the rounded means: the published figures are defined that way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fareweather.config import CLEAR, CleaningLimits, ConditionThresholds, SensitivityThresholds
from fareweather.functions.labels import condition_rank, sensitivity_label
from fareweather.functions.numeric import (
    delta,
    exact_avg,
    exact_sum,
    lift_pct,
    rounded,
    weighted_mean,
)
from fareweather.operators.hourly_weather import classified_weather
from fareweather.operators.lookups import attach_zone
from fareweather.sources.periods import Period

# Result column -> (column of the zone-hour, decimals kept exactly in its sum).
_WEIGHTED = {
    "avg_duration": "avg_trip_duration_minutes",
    "avg_trip_distance": "avg_trip_distance",
    "avg_total_amount": "avg_total_amount",
    "avg_tip_pct": "avg_tip_percentage",
    "avg_minutes_per_mile": "avg_minutes_per_mile",
}

# Measures compared with the baseline: result column -> name of its difference.
_DELTAS = {
    "avg_duration": "duration_delta_minutes",
    "avg_minutes_per_mile": "minutes_per_mile_delta",
    "avg_total_amount": "fare_delta_amount",
    "avg_tip_pct": "tip_delta_pct",
}


def _by_trips(names: list[str]) -> list[Column]:
    return [weighted_mean(_WEIGHTED[name], "total_trips", whole=True).alias(name) for name in names]


def _plain(names: list[str]) -> list[Column]:
    return [exact_avg(n).alias(f"avg_{n}") for n in names]


def _per_zone_hour() -> Column:
    ratio = F.sum("total_trips").cast("double") / F.count(F.lit(1))
    return ratio.alias("avg_trips_per_zone_hour")


def daily_zone_metrics(enriched: DataFrame) -> DataFrame:
    weather = ["temperature_2m", "precipitation", "rain", "snowfall", "wind_speed_10m"]
    grouped = enriched.groupBy(
        "pickup_date",
        F.col("pickup_location_id").alias("zone_id"),
        "pickup_borough",
        "pickup_zone",
        "weather_condition",
    ).agg(
        F.count(F.lit(1)).alias("active_hours"),
        F.sum("total_trips").alias("trip_count"),
        F.sum("total_passengers").alias("total_passengers"),
        exact_sum("total_revenue").alias("total_revenue"),
        exact_sum("total_tip").alias("total_tip"),
        F.try_divide(exact_sum("total_revenue"), F.sum("total_trips").cast("double")).alias("avg_fare"),
        *_by_trips(list(_WEIGHTED)),
        *_plain(weather),
    )
    return rounded(grouped, 2, "total_revenue", "total_tip", "avg_fare", *_WEIGHTED, *[f"avg_{n}" for n in weather])


def hourly_summary(enriched: DataFrame) -> DataFrame:
    weather = ["temperature_2m", "precipitation", "rain", "wind_speed_10m"]
    grouped = enriched.groupBy("pickup_hour", "pickup_borough", "weather_condition").agg(
        F.count(F.lit(1)).alias("total_zone_hours"),
        F.sum("total_trips").alias("total_trips"),
        F.sum("total_passengers").alias("total_passengers"),
        exact_sum("total_revenue").alias("total_revenue"),
        exact_sum("total_tip").alias("total_tip"),
        _per_zone_hour(),
        *_by_trips(list(_WEIGHTED)),
        *_plain(weather),
    )
    means = ["avg_trips_per_zone_hour", *_WEIGHTED, *[f"avg_{n}" for n in weather]]
    return rounded(grouped, 2, "total_revenue", "total_tip", *means)


def _reaction(enriched: DataFrame, keys: list, plain: list[str]) -> DataFrame:
    grouped = enriched.groupBy(*keys, "weather_condition").agg(
        F.count(F.lit(1)).alias("total_zone_hours"),
        F.sum("total_trips").alias("total_trips"),
        _per_zone_hour(),
        *_by_trips(list(_DELTAS)),
        *_plain(plain),
    )
    return rounded(grouped, 4, "avg_trips_per_zone_hour", *_DELTAS, *[f"avg_{n}" for n in plain])


def against_baseline(df: DataFrame, over: list, baseline: str = CLEAR) -> DataFrame:
    """Lift and differences against the baseline row of the same group.

    A window over the grouped rows finds the baseline, so the grouping runs once
    and is not joined with itself. A group holds one row per condition.
    """
    group = W.partitionBy(*over)

    def base(name: str) -> Column:
        return F.max(F.when(F.col("weather_condition") == baseline, F.col(name))).over(group)

    volume = "avg_trips_per_zone_hour"
    compared = {"demand_lift_pct": lift_pct(F.col(volume), F.col("_base_volume"))}
    bases = {"_base_volume": base(volume)}
    for name, difference in _DELTAS.items():
        bases[f"_base_{name}"] = base(name)
        compared[difference] = delta(F.col(name), F.col(f"_base_{name}"))
    return df.withColumns(bases).withColumns(compared).drop(*bases)


def weather_impact(enriched: DataFrame, baseline: str = CLEAR) -> DataFrame:
    """One row per condition against the baseline; no row without a baseline.

    Conditions are the few labels of the classification, so the window over all
    of them sees a handful of rows.
    """
    by_condition = _reaction(enriched, [], ["precipitation", "rain"])
    seen = F.count_if(F.col("weather_condition") == baseline).over(W.partitionBy(F.lit(1)))
    compared = against_baseline(by_condition, [F.lit(1)], baseline).withColumn("_seen", seen)
    return compared.filter("_seen > 0").select(
        "weather_condition",
        "total_zone_hours",
        "total_trips",
        "avg_trips_per_zone_hour",
        "demand_lift_pct",
        *[c for pair in _DELTAS.items() for c in pair],
        "avg_precipitation",
        "avg_rain",
    )


def in_condition_order(df: DataFrame, column: str = "weather_condition") -> DataFrame:
    return df.orderBy(condition_rank(F.col(column)))


def by_lift(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc_nulls_last("demand_lift_pct"), "weather_condition")


def zone_elasticity(
    enriched: DataFrame,
    limits: SensitivityThresholds = SensitivityThresholds(),
    baseline: str = CLEAR,
) -> DataFrame:
    """One row per zone and condition against the zone's own baseline."""
    zone = [F.col("pickup_location_id").alias("zone_id"), "pickup_borough", "pickup_zone"]
    compared = against_baseline(
        _reaction(enriched, zone, ["precipitation"]), ["zone_id"], baseline
    )
    label = sensitivity_label(
        F.col("weather_condition"),
        F.col("demand_lift_pct"),
        F.col("duration_delta_minutes"),
        limits,
        baseline,
    )
    return compared.select(
        "zone_id",
        "pickup_borough",
        "pickup_zone",
        "weather_condition",
        "total_zone_hours",
        "total_trips",
        "avg_trips_per_zone_hour",
        "demand_lift_pct",
        *[c for pair in _DELTAS.items() for c in pair],
        "avg_precipitation",
        label.alias("weather_sensitivity_label"),
    )


def od_flow(
    trips: DataFrame,
    weather: DataFrame,
    zones: DataFrame,
    period: Period | None = None,
    min_trips: int = 50,
    zone_range: tuple[int, int] | None = CleaningLimits().zones,
    limits: ConditionThresholds = ConditionThresholds(),
) -> DataFrame:
    """Routes by condition with at least ``min_trips`` trips.

    The only shuffle carries partial sums of routes, so a busy route costs one
    row per task. Trips without weather keep a null condition.
    """
    keys = ["pickup_location_id", "dropoff_location_id", "weather_condition"]
    side = classified_weather(weather, period, limits)
    flows = (
        trips.join(side, ["pickup_date", "pickup_hour"], "left")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            exact_avg("trip_duration_minutes").alias("avg_duration"),
            exact_avg("trip_distance").alias("avg_trip_distance"),
            exact_avg("average_speed_mph").alias("avg_speed_mph"),
            exact_sum("total_amount").alias("total_revenue"),
            exact_avg("total_amount").alias("avg_total_amount"),
            exact_avg("tip_percentage").alias("avg_tip_pct"),
        )
        .filter(F.col("trip_count") >= min_trips)
        .withColumnsRenamed(
            {
                "pickup_location_id": "origin_location_id",
                "dropoff_location_id": "destination_location_id",
            }
        )
    )
    measures = ["avg_duration", "avg_trip_distance", "avg_speed_mph", "total_revenue", "avg_total_amount", "avg_tip_pct"]
    flows = rounded(flows, 2, *measures)
    flows = attach_zone(flows, zones, "origin_location_id", "origin", zone_range)
    flows = attach_zone(flows, zones, "destination_location_id", "destination", zone_range)
    return flows.select(
        "origin_location_id",
        "origin_borough",
        "origin_zone",
        "destination_location_id",
        "destination_borough",
        "destination_zone",
        "weather_condition",
        "trip_count",
        "avg_duration",
        "avg_trip_distance",
        "avg_speed_mph",
        "total_revenue",
        "avg_total_amount",
        "avg_tip_pct",
    )
