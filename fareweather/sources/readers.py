"""Readers for trips, zone lookup, hourly weather, zone shapes and reports."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fareweather.sources import schemas, versions
from fareweather.sources.periods import Period


class MissingInput(FileNotFoundError):
    """An expected table or file is absent or holds no rows."""


def require(df: DataFrame, label: str) -> DataFrame:
    """Fail early when an input has no row; reads at most one row."""
    if df.isEmpty():
        raise MissingInput(f"{label} holds no rows")
    return df


def read_table(spark: SparkSession, path: str, label: str = "table") -> DataFrame:
    """Scan one Parquet table, with a clear error when it is absent or empty.

    Of a published table the current version is read.
    """
    try:
        return require(spark.read.parquet(versions.resolve(spark, path)), f"{label} at {path}")
    except AnalysisException as error:
        raise MissingInput(f"{label} not found at {path}") from error


def trip_paths(folder: str, period: Period, fleet: str = "yellow") -> list[str]:
    """One file per month, chosen by name, so other months are never opened."""
    return [f"{folder.rstrip('/')}/{fleet}_tripdata_{month}.parquet" for month in period.months]


def as_declared(df: DataFrame, schema: T.StructType, label: str = "table") -> DataFrame:
    """The declared columns in their declared types.

    A cast between equal types vanishes from the plan, so filters still reach
    the scan.
    """
    present = {name.lower() for name in df.columns}
    missing = [name for name in schema.fieldNames() if name.lower() not in present]
    if missing:
        raise MissingInput(f"{label} lacks columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def scan_trips(
    spark: SparkSession, paths: Iterable[str], schema: T.StructType = schemas.RAW_TRIPS
) -> DataFrame:
    """Scan several monthly Parquet files as one table.

    Months that store a column in another numeric type are scanned apart and
    brought to the declared types; months that are stored alike share one scan.
    """
    alike: dict[str, list[str]] = {}
    stored = {}
    for path in paths:
        try:
            stored[path] = spark.read.parquet(path)
        except AnalysisException as error:
            raise MissingInput(f"trip file not found at {path}") from error
        alike.setdefault(stored[path].schema.simpleString(), []).append(path)
    if not alike:
        raise MissingInput("no trip files named")
    # One job over the footers of all files tells which of them hold rows.
    marks = [df.select(F.lit(path).alias("path")) for path, df in stored.items()]
    filled = {row["path"] for row in reduce(DataFrame.union, marks).distinct().collect()}
    for path in stored:
        if path not in filled:
            raise MissingInput(f"trip file at {path} holds no rows")
    scans = [
        as_declared(spark.read.parquet(*group), schema, f"trip file {group[0]}")
        for group in alike.values()
    ]
    return reduce(DataFrame.unionByName, scans)


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    try:
        zones = spark.read.schema(schemas.ZONE_LOOKUP).option("header", True).csv(path)
        return require(zones, f"zone lookup at {path}")
    except AnalysisException as error:
        raise MissingInput(f"zone lookup not found at {path}") from error


def decode_hourly(payloads: DataFrame) -> DataFrame:
    """Parallel arrays of an hourly weather payload to one row per hour."""
    measures = list(schemas.WEATHER_MEASURES)
    hours = payloads.select(
        F.inline(F.arrays_zip(*[F.col(f"hourly.{name}") for name in ["time", *measures]]))
    )
    stamp = F.col("time").cast("timestamp_ntz")
    return hours.select(
        stamp.alias("weather_datetime"),
        stamp.cast("date").cast("string").alias("pickup_date"),
        F.hour(stamp).alias("pickup_hour"),
        *measures,
    )


def read_weather_payload(spark: SparkSession, path: str) -> DataFrame:
    try:
        raw = spark.read.schema(schemas.WEATHER_PAYLOAD).option("multiLine", True).json(path)
    except AnalysisException as error:
        raise MissingInput(f"weather payload not found at {path}") from error
    if raw.filter(F.col("hourly").isNull()).limit(1).count():
        raise ValueError(f"the payload at {path} has no hourly part")
    return require(decode_hourly(raw), f"weather payload at {path}")


# Property names that may carry a zone id, in order of trust.
ZONE_KEY_NAMES = (
    "LocationID",
    "location_id",
    "location_i",
    "locationid",
    "LocationId",
    "OBJECTID",
    "objectid",
)


_NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def normal_key(text: Column) -> Column:
    """Numeric text to whole-number text, other text unchanged."""
    number = F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))
    return F.coalesce(number.try_cast("bigint").cast("string"), text)


def _filled(value: Column) -> Column:
    """Whether a JSON value counts as given: zero, false and empty ones do not."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return (
        F.when(kind == "STRING", text != "")
        .when(kind == "BOOLEAN", text == "true")
        .when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(value, "$", "double") != 0)
        .when(kind == "VOID", False)
        .otherwise(~text.isin("{}", "[]"))
    )


def _text(value: Column) -> Column:
    text = F.try_variant_get(value, "$", "string")
    return F.when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(text)).otherwise(text)


def zone_shape_keys(shapes: DataFrame) -> DataFrame:
    """One normal zone key per feature of a GeoJSON document.

    Only the properties are read, with their JSON types; the polygons, by far the
    largest part, are left out of the declared schema. The first property that is
    filled names the zone; if none is, the last one does as it stands.
    """
    properties = shapes.select(F.explode("features.properties").alias("properties"))
    values = [F.col("properties")[name] for name in ZONE_KEY_NAMES]
    texts = [_text(value) for value in values]
    filled = [F.when(_filled(value), text) for value, text in zip(values, texts)]
    key = normal_key(F.coalesce(*filled, texts[-1]))
    return properties.select(key.alias("map_id"), "properties")


def read_zone_shapes(spark: SparkSession, path: str) -> DataFrame | None:
    """Zone keys of a GeoJSON file; None when the file is absent or empty."""
    try:
        shapes = spark.read.schema(schemas.ZONE_SHAPES).option("multiLine", True).json(path)
        return None if shapes.isEmpty() else zone_shape_keys(shapes)
    except AnalysisException:
        return None


def read_report(spark: SparkSession, path: str) -> DataFrame:
    try:
        return require(spark.read.json(versions.resolve(spark, path)), f"report at {path}")
    except AnalysisException as error:
        raise MissingInput(f"report not found at {path}") from error


def report_rows(report: DataFrame, section: str) -> DataFrame:
    """Nested records of a report section as rows."""
    return report.select(F.inline(section))
