"""Star schema: zone dimension, trip facts and the three trip aggregates.

The aggregates group by ids and dates and attach names afterwards: names and
calendar columns depend on those keys, so the rows that are shuffled stay narrow
and the lookup is joined to the few result rows instead of to every trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from fareweather.config import CleaningLimits
from fareweather.functions.numeric import rounded, state_avg, state_sum, sum_state
from fareweather.functions.timing import day_name, is_weekend
from fareweather.operators.lookups import attach_zone, bounded

ZONE_RANGE = CleaningLimits().zones


def dim_location(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("LocationID").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    ).orderBy("location_id")


def canonical_trips(clean: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Clean trips under the column names of the star schema, without names."""
    return clean.select(
        *carry,
        F.col("VendorID").alias("vendor_id"),
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        "pickup_date",
        "pickup_hour",
        "pickup_month",
        "pickup_dayofweek",
        "pickup_day_name",
        "is_weekend",
        "passenger_count",
        "trip_distance",
        "trip_duration_minutes",
        "average_speed_mph",
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        "payment_type",
        "fare_amount",
        "tip_amount",
        "tip_percentage",
        "total_amount",
        "tolls_amount",
        "extra",
        "mta_tax",
        "congestion_surcharge",
        "Airport_fee",
    )


def fact_trips(
    clean: DataFrame,
    zones: DataFrame,
    zone_range: tuple[int, int] | None = ZONE_RANGE,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Trips with names for both zone roles; no shuffle of the trips.

    ``carry`` names further columns to keep, such as the row number.
    """
    trips = canonical_trips(clean, carry)
    facts = attach_zone(trips, zones, "pickup_location_id", "pickup", zone_range, True)
    return attach_zone(facts, zones, "dropoff_location_id", "dropoff", zone_range, True)


def numbered(spark: SparkSession, path: str, id_column: str = "trip_id") -> DataFrame:
    """Dense row numbers 1..n for a published Parquet table.

    A row is numbered by its position in its file plus the rows of all files
    before it. The counts come from file footers, no row is moved, and a task
    that runs again gives the same numbers. Only the files are ordered in one
    task, one row each.
    """
    rows = spark.read.parquet(path)
    place = rows.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"), "*"
    )
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        rows.groupBy(F.col("_metadata.file_path").alias("_file"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    starts = bounded(starts, len(rows.inputFiles()))
    number = F.col("_start") + F.col("_at") + 1
    return place.join(starts, "_file").select(number.alias(id_column), *rows.columns)


_SUMMED = (
    "trip_distance",
    "trip_duration_minutes",
    "total_amount",
    "tip_amount",
    "tip_percentage",
    "average_speed_mph",
)


def trip_state(trips: DataFrame) -> DataFrame:
    """Exact sums of the trips of each date, hour and pickup zone.

    The one pass over trips that the hourly, zone and daily totals share: the sums
    are integers, so totals of totals are equal to totals of trips to the bit.
    """
    return trips.groupBy("pickup_date", "pickup_hour", "pickup_location_id").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("passenger_count").alias("passengers"),
        F.min("pickup_datetime").alias("first_pickup"),
        F.max("pickup_datetime").alias("last_pickup"),
        *[part for name in _SUMMED for part in sum_state(name)],
    )


_MEANS = {
    "avg_trip_distance": "trip_distance",
    "avg_trip_duration_minutes": "trip_duration_minutes",
    "avg_total_amount": "total_amount",
    "avg_tip_percentage": "tip_percentage",
    "avg_speed_mph": "average_speed_mph",
}
_TOTALS = {"total_revenue": "total_amount", "total_tip": "tip_amount"}


def _trip_measures(state: DataFrame, *keys: str, more: tuple[Column, ...] = ()) -> DataFrame:
    """Counts, totals and means of the state by some keys, rounded to cents."""
    grouped = state.groupBy(*keys).agg(
        F.sum("trips").alias("total_trips"),
        F.sum("passengers").alias("total_passengers"),
        *[state_avg(name).alias(out) for out, name in _MEANS.items()],
        *[state_sum(name).alias(out) for out, name in _TOTALS.items()],
        *more,
    )
    return rounded(grouped, 2, *_MEANS, *_TOTALS)


def hourly_demand(
    state: DataFrame, zones: DataFrame, zone_range: tuple[int, int] | None = ZONE_RANGE
) -> DataFrame:
    """One row per date, hour and pickup zone, from :func:`trip_state`."""
    grouped = _trip_measures(state, "pickup_date", "pickup_hour", "pickup_location_id")
    named = attach_zone(grouped, zones, "pickup_location_id", "pickup", zone_range)
    return named.select(
        "pickup_date",
        "pickup_hour",
        day_name(F.col("pickup_date")).alias("pickup_day_name"),
        is_weekend(F.col("pickup_date")).alias("is_weekend"),
        "pickup_location_id",
        "pickup_borough",
        "pickup_zone",
        "total_trips",
        "total_passengers",
        "avg_trip_distance",
        "avg_trip_duration_minutes",
        "avg_speed_mph",
        "total_revenue",
        "avg_total_amount",
        "total_tip",
        "avg_tip_percentage",
    )


def zone_summary(
    state: DataFrame, zones: DataFrame, zone_range: tuple[int, int] | None = ZONE_RANGE
) -> DataFrame:
    """One row per pickup zone, from :func:`trip_state`."""
    span = (F.min("first_pickup").alias("first_pickup_datetime"), F.max("last_pickup").alias("last_pickup_datetime"))
    grouped = _trip_measures(state, "pickup_location_id", more=span)
    named = attach_zone(grouped, zones, "pickup_location_id", "pickup", zone_range, True)
    return named.select(
        "pickup_location_id",
        "pickup_borough",
        "pickup_zone",
        "pickup_service_zone",
        "total_trips",
        "total_passengers",
        "total_revenue",
        "avg_total_amount",
        "avg_trip_distance",
        "avg_trip_duration_minutes",
        "avg_speed_mph",
        "total_tip",
        "avg_tip_percentage",
        "first_pickup_datetime",
        "last_pickup_datetime",
    )


def daily_summary(state: DataFrame) -> DataFrame:
    """One row per date, from :func:`trip_state`."""
    return (
        _trip_measures(state, "pickup_date")
        .select(
            "pickup_date",
            day_name(F.col("pickup_date")).alias("pickup_day_name"),
            is_weekend(F.col("pickup_date")).alias("is_weekend"),
            "total_trips",
            "total_passengers",
            "total_revenue",
            "avg_total_amount",
            "avg_trip_distance",
            "avg_trip_duration_minutes",
            "total_tip",
            "avg_tip_percentage",
        )
    )
