"""Joins with small lookups whose size is proven before they are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A lookup of at most this many narrow rows (well under 200 MB) is broadcast.
BROADCAST_ROWS = 1_000_000


def unique_by(df: DataFrame, *keys: str, label: str = "lookup") -> DataFrame:
    """One row per key; the query fails when a key comes twice.

    A repeated key would multiply the rows of the other side of a join, so this
    is checked inside the plan, without an extra job.
    """
    others = [c for c in df.columns if c not in keys]
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), *[F.max(c).alias(c) for c in others]
    )
    clash = F.raise_error(F.concat(F.lit(f"{label}: repeated key "), F.to_json(F.struct(*keys))))
    return counted.filter(F.when(F.col("_copies") > 1, clash).otherwise(F.lit(True))).select(
        *keys, *others
    )


def bounded(df: DataFrame, most_rows: int | None) -> DataFrame:
    """Broadcast a side that holds at most ``most_rows`` rows by construction.

    Without a bound, or beyond the limit, the join stays a shuffled join that
    adaptive execution may still turn into a broadcast after measuring the side,
    and whose hot keys it splits.
    """
    if most_rows is not None and most_rows <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def zone_side(zones: DataFrame, zone_range: tuple[int, int] | None) -> DataFrame:
    """The zone lookup as a join side: unique ids, limited to the valid range."""
    side = zones.select("LocationID", "Borough", "Zone", "service_zone")
    if zone_range is None:
        return unique_by(side, "LocationID", label="zone lookup")
    low, high = zone_range
    side = side.filter(F.col("LocationID").between(low, high))
    return bounded(unique_by(side, "LocationID", label="zone lookup"), high - low + 1)


def attach_zone(
    df: DataFrame,
    zones: DataFrame,
    id_column: str,
    prefix: str,
    zone_range: tuple[int, int] | None,
    service_zone: bool = False,
) -> DataFrame:
    """Left join of zone names; ids the lookup does not know get nulls."""
    names = [F.col("Borough").alias(f"{prefix}_borough"), F.col("Zone").alias(f"{prefix}_zone")]
    if service_zone:
        names.append(F.col("service_zone").alias(f"{prefix}_service_zone"))
    side = zone_side(zones, zone_range).select(F.col("LocationID").alias("_zone_id"), *names)
    return df.join(side, F.col(id_column) == F.col("_zone_id"), "left").drop("_zone_id")
