"""Time columns that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fareweather.config import DAY_NAMES

_ORIGIN = "TIMESTAMP_NTZ '0001-01-01 00:00:00'"


def minute_index(ts: Column) -> Column:
    """Whole minutes since a fixed origin (zone-less timestamps)."""
    return (ts - F.expr(_ORIGIN)).cast("interval minute").cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed, not elapsed minutes."""
    return minute_index(end) - minute_index(start)


def sunday_first(ts: Column) -> Column:
    """Day of week with Sunday = 0."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def day_name(ts: Column) -> Column:
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    # A null position has to be guarded: element_at only looks at the array's
    # own nullability.
    return F.when(ts.isNotNull(), F.element_at(names, F.dayofweek(ts)))


def calendar_columns(ts: Column) -> dict[str, Column]:
    return {
        "pickup_date": ts.cast("date"),
        "pickup_hour": F.hour(ts).cast("bigint"),
        "pickup_month": F.month(ts).cast("bigint"),
        "pickup_dayofweek": sunday_first(ts),
        "pickup_day_name": day_name(ts),
        "is_weekend": is_weekend(ts),
    }
