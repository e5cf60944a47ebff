"""Declared schemas of the inputs; nothing is inferred from the data."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_NTZ, _LONG, _DOUBLE, _TEXT = (
    T.TimestampNTZType(),
    T.LongType(),
    T.DoubleType(),
    T.StringType(),
)

# Column names of the public monthly trip files.
RAW_TRIPS = _struct(
    VendorID=_LONG,
    tpep_pickup_datetime=_NTZ,
    tpep_dropoff_datetime=_NTZ,
    passenger_count=_DOUBLE,
    trip_distance=_DOUBLE,
    RatecodeID=_DOUBLE,
    store_and_fwd_flag=_TEXT,
    PULocationID=_LONG,
    DOLocationID=_LONG,
    payment_type=_LONG,
    fare_amount=_DOUBLE,
    extra=_DOUBLE,
    mta_tax=_DOUBLE,
    tip_amount=_DOUBLE,
    tolls_amount=_DOUBLE,
    improvement_surcharge=_DOUBLE,
    total_amount=_DOUBLE,
    congestion_surcharge=_DOUBLE,
    Airport_fee=_DOUBLE,
)

ZONE_LOOKUP = _struct(LocationID=_LONG, Borough=_TEXT, Zone=_TEXT, service_zone=_TEXT)

# Measures of the hourly weather payload.
WEATHER_MEASURES = {
    "temperature_2m": _DOUBLE,
    "precipitation": _DOUBLE,
    "rain": _DOUBLE,
    "snowfall": _DOUBLE,
    "weather_code": _LONG,
    "wind_speed_10m": _DOUBLE,
}

WEATHER_PAYLOAD = _struct(
    hourly=_struct(
        time=T.ArrayType(_TEXT),
        **{name: T.ArrayType(kind) for name, kind in WEATHER_MEASURES.items()},
    ),
    hourly_units=T.MapType(_TEXT, T.VariantType()),
)

HOURLY_WEATHER = _struct(
    weather_datetime=_NTZ, pickup_date=_TEXT, pickup_hour=T.IntegerType(), **WEATHER_MEASURES
)

ZONE_SHAPES = _struct(features=T.ArrayType(_struct(properties=T.MapType(_TEXT, T.VariantType()))))
