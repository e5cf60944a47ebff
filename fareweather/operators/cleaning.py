"""Validation, de-duplication and derived columns of raw trips."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareweather.config import CleaningLimits
from fareweather.functions.local import local_rows
from fareweather.functions.numeric import avg2, round_half
from fareweather.functions.timing import calendar_columns, minutes_between
from fareweather.sources import schemas
from fareweather.sources.periods import Period

@dataclass(frozen=True)
class Rule:
    """A named validity rule.

    ``keep`` is the predicate of a valid row, where null means invalid.
    ``null_counts`` tells whether a null is this rule's own fault in the report;
    a missing timestamp, for example, is reported by one rule only.
    """

    name: str
    keep: Column
    null_counts: bool = True

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.keep, F.lit(not self.null_counts))


def trip_minutes() -> Column:
    return minutes_between(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))


def _within(column: Column, limits: tuple[float, float]) -> Column:
    return (column > limits[0]) & (column <= limits[1])


def trip_rules(period: Period, limits: CleaningLimits = CleaningLimits()) -> list[Rule]:
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    start = F.lit(period.start.isoformat()).cast("timestamp_ntz")
    end = F.lit(period.end.isoformat()).cast("timestamp_ntz")
    return [
        Rule("missing_timestamp", pickup.isNotNull() & dropoff.isNotNull()),
        Rule("outside_period", (pickup >= start) & (pickup < end), null_counts=False),
        Rule("passenger_count", _within(F.col("passenger_count"), limits.passengers)),
        Rule("trip_distance", _within(F.col("trip_distance"), limits.distance)),
        Rule("trip_duration", _within(trip_minutes(), limits.minutes), null_counts=False),
        Rule("fare_amount", F.col("fare_amount") >= 0),
        Rule("tip_amount", F.col("tip_amount") >= 0),
        Rule("total_amount", F.col("total_amount") > 0),
        Rule("pickup_zone", F.col("PULocationID").between(*limits.zones)),
        Rule("dropoff_zone", F.col("DOLocationID").between(*limits.zones)),
    ]


def valid_trips(raw: DataFrame, rules: list[Rule]) -> DataFrame:
    for rule in rules:
        raw = raw.filter(rule.keep)
    return raw


def with_ratios(trips: DataFrame) -> DataFrame:
    """Tip percentage (0 without a fare) and average speed."""
    fare, minutes = F.col("fare_amount"), F.col("trip_duration_minutes")
    tip = F.when(fare > 0, round_half(F.col("tip_amount") / fare * 100.0, 2)).otherwise(0.0)
    speed = F.when(minutes > 0, round_half(F.col("trip_distance") / (minutes / 60.0), 2))
    return trips.withColumns({"tip_percentage": tip, "average_speed_mph": speed})


def with_derived(trips: DataFrame) -> DataFrame:
    derived = calendar_columns(F.col("tpep_pickup_datetime"))
    derived["trip_duration_minutes"] = trip_minutes()
    return with_ratios(trips.withColumns(derived))


def clean_trips(
    raw: DataFrame, period: Period, limits: CleaningLimits = CleaningLimits()
) -> DataFrame:
    """Valid, distinct trips with derived columns.

    Rows are filtered first and compared on the raw columns only; everything
    derived is a function of those. ``distinct`` aggregates before the shuffle,
    so a large group of copies leaves each task as one row.
    """
    raw = raw.select(*schemas.RAW_TRIPS.fieldNames())
    return with_derived(valid_trips(raw, trip_rules(period, limits)).distinct())


def rejection_measures(period: Period, limits: CleaningLimits = CleaningLimits()) -> dict[str, Column]:
    return {f"rejected_{rule.name}": F.count_if(rule.broken) for rule in trip_rules(period, limits)}


def rejections(
    raw: DataFrame, period: Period, limits: CleaningLimits = CleaningLimits()
) -> DataFrame:
    """Row count and broken rules in one pass over the raw rows, no row shuffle.

    A row may break several rules.
    """
    measures = rejection_measures(period, limits)
    return raw.agg(F.count(F.lit(1)).alias("raw_rows"), *[c.alias(name) for name, c in measures.items()])


def accounted(counted: DataFrame) -> DataFrame:
    """Removed rows and their share beside ``raw_rows`` and ``cleaned_rows``."""
    removed = F.col("raw_rows") - F.col("cleaned_rows")
    share = F.coalesce(F.try_divide(removed, F.col("raw_rows")) * 100.0, F.lit(0.0))
    return counted.withColumns(
        {"removed_rows": removed, "removed_percentage": round_half(share, 2)}
    )


def cleaning_report(
    raw: DataFrame,
    clean: DataFrame,
    period: Period,
    limits: CleaningLimits = CleaningLimits(),
) -> DataFrame:
    """Raw, clean and removed rows (copies included) beside the broken rules.

    ``clean`` should be the published table, whose count costs no scan.
    """
    kept = clean.agg(F.count(F.lit(1))).scalar()
    return accounted(rejections(raw, period, limits).withColumn("cleaned_rows", kept))


def counted_report(spark: SparkSession, counts: Mapping[str, int], cleaned: int) -> DataFrame:
    """The same report from counts that the cleaning job took on its way."""
    values = {**counts, "cleaned_rows": cleaned}
    return accounted(local_rows(spark, dict.fromkeys(values, "BIGINT"), [tuple(values.values())]))


def _summary_measures() -> dict[str, Column]:
    return {
        "min_pickup_datetime": F.min("tpep_pickup_datetime"),
        "max_pickup_datetime": F.max("tpep_pickup_datetime"),
        "avg_trip_distance": avg2("trip_distance"),
        "avg_trip_duration_minutes": avg2("trip_duration_minutes"),
        "avg_fare_amount": avg2("fare_amount"),
        "avg_tip_amount": avg2("tip_amount"),
        "avg_total_amount": avg2("total_amount"),
    }


def cleaning_summary(clean: DataFrame) -> DataFrame:
    return clean.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("pickup_date").alias("total_pickup_dates"),
        *[c.alias(name) for name, c in _summary_measures().items()],
    )


def summary_measures(period: Period) -> dict[str, Column]:
    """As :func:`cleaning_summary`, for a job that writes trips of the period.

    Dates are marked in a bitmap, as a running job cannot count distinct values; it
    has a bit for 32,768 days.
    """
    day = F.datediff("pickup_date", F.lit(period.start.isoformat()).cast("date"))
    days = F.bitmap_count(F.bitmap_construct_agg(day.cast("bigint")))
    return {"total_pickup_dates": days, **_summary_measures()}


def counted_summary(spark: SparkSession, found: Mapping[str, Any]) -> DataFrame:
    """The summary from what :func:`summary_measures` gave, with ``rows``."""
    kinds = {"total_rows": "BIGINT", "total_pickup_dates": "BIGINT"}
    kinds |= {name: "TIMESTAMP_NTZ" if name.endswith("datetime") else "DOUBLE" for name in _summary_measures()}
    values = {**found, "total_rows": found["rows"]}
    return local_rows(spark, kinds, [tuple(values[name] for name in kinds)])
