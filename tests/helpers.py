"""Small builders for hand-made rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from fareweather.sources import schemas

GOOD_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2025, 1, 4, 10, 0, 0),
    "tpep_dropoff_datetime": datetime(2025, 1, 4, 10, 30, 0),
    "passenger_count": 1.0,
    "trip_distance": 5.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 5.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 26.5,
    "congestion_surcharge": 0.0,
    "Airport_fee": 0.0,
}


def trips(spark: SparkSession, *changes: dict) -> DataFrame:
    names = schemas.RAW_TRIPS.fieldNames()
    rows = [tuple({**GOOD_TRIP, **change}[n] for n in names) for change in changes]
    return spark.createDataFrame(rows, schemas.RAW_TRIPS)


def values(spark: SparkSession, column: Column, schema: str, *rows: tuple) -> list:
    """The column evaluated on each row, in order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}")
    return [r["v"] for r in df.select("_i", column.alias("v")).orderBy("_i").collect()]


def as_dicts(df: DataFrame) -> list[dict]:
    return [row.asDict(recursive=True) for row in df.collect()]
