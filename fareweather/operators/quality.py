"""Checks that stop a run, and the audit counts behind them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


class QualityError(ValueError):
    """A published table breaks one of its guarantees."""


def not_empty(df: DataFrame, label: str) -> DataFrame:
    if df.isEmpty():
        raise QualityError(f"{label} is empty")
    return df


def has_columns(df: DataFrame, columns: Iterable[str], label: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"{label} lacks columns {missing}")
    return df


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; on published tables this reads file footers only."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def invalid_measures() -> dict[str, Column]:
    return {
        "null_pickup": F.count_if(F.col("tpep_pickup_datetime").isNull()),
        "null_dropoff": F.count_if(F.col("tpep_dropoff_datetime").isNull()),
        "invalid_distance": F.count_if(F.col("trip_distance") <= 0),
        "invalid_duration": F.count_if(F.col("trip_duration_minutes") <= 0),
        "invalid_total": F.count_if(F.col("total_amount") <= 0),
    }


def invalid_counts(clean: DataFrame) -> DataFrame:
    measures = [c.alias(name) for name, c in invalid_measures().items()]
    return clean.agg(F.count(F.lit(1)).alias("total_rows"), *measures)


def audit_clean(clean: DataFrame) -> DataFrame:
    return clean.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("trip_distance") <= 0).alias("invalid_distance"),
        F.count_if(F.col("trip_duration_minutes") <= 0).alias("invalid_duration"),
        F.count_if(F.col("total_amount") <= 0).alias("invalid_total_amount"),
        F.min("tpep_pickup_datetime").alias("min_pickup_datetime"),
        F.max("tpep_pickup_datetime").alias("max_pickup_datetime"),
        F.countDistinct("pickup_date").alias("total_pickup_dates"),
    )


def audit_daily(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.min("pickup_date").alias("min_date"),
        F.max("pickup_date").alias("max_date"),
        F.count(F.lit(1)).alias("total_days"),
        F.sum("total_trips").alias("total_trips"),
    )


def check_clean(clean: DataFrame) -> None:
    check_clean_counts(invalid_counts(clean).first().asDict())


def check_clean_counts(found: Mapping[str, int]) -> None:
    """``found`` as from :func:`invalid_counts`."""
    if not found["total_rows"]:
        raise QualityError("clean trips are empty")
    bad = {name: n for name, n in found.items() if n and name != "total_rows"}
    if bad:
        raise QualityError(f"clean trips hold invalid values: {bad}")


def check_weather(weather: DataFrame) -> None:
    not_empty(weather, "hourly weather")


def check_weather_join(hourly_weather: DataFrame) -> None:
    missing = F.count_if(F.col("temperature_2m").isNull())
    check_join_counts(*hourly_weather.agg(F.count(F.lit(1)), missing).first())


def check_join_counts(rows: int, without: int) -> None:
    if not rows:
        raise QualityError("the weather join is empty")
    if without:
        raise QualityError(f"{without} zone-hours have no weather")


def check_tables(tables: Mapping[str, DataFrame]) -> None:
    """All tables hold rows; used for the curated tables and for the marts."""
    for name, df in tables.items():
        not_empty(df, name)


def check_row_counts(counts: Mapping[str, int]) -> None:
    """As :func:`check_tables`, from counts taken by the jobs that wrote the tables."""
    for name, rows in counts.items():
        if not rows:
            raise QualityError(f"{name} is empty")


def check_predictions(predictions: DataFrame, importance: DataFrame) -> None:
    # The columns of the table.
    wanted = ["total_trips", "predicted_total_trips", "prediction_error", "absolute_error"]
    not_empty(has_columns(predictions, wanted, "predictions"), "predictions")
    not_empty(importance, "feature importance")


def check_clusters(clusters: DataFrame) -> None:
    # The columns of the table.
    wanted = [
        "zone_id",
        "pickup_borough",
        "pickup_zone",
        "cluster_id",
        "cluster_profile",
        "avg_demand_lift_pct",
        "avg_duration_delta_minutes",
    ]
    not_empty(has_columns(clusters, wanted, "clusters"), "clusters")
    if clusters.agg(F.countDistinct("cluster_id")).first()[0] < 2:
        raise QualityError("fewer than two clusters")
