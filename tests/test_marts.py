from datetime import date, datetime

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from fareweather.operators import curation, hourly_weather, lookups, marts, quality
from fareweather.operators.cleaning import clean_trips
from fareweather.plans.standin import Tables
from fareweather.sources import schemas
from fareweather.sources.periods import Period
from tests.helpers import as_dicts, trips

JANUARY = Period.of(["2025-01"])

WEATHER = {
    "weather_datetime": datetime(2025, 1, 4, 10),
    "pickup_date": "2025-01-04",
    "pickup_hour": 10,
    "temperature_2m": 1.0,
    "precipitation": 0.0,
    "rain": 0.0,
    "snowfall": 0.0,
    "weather_code": 0,
    "wind_speed_10m": 3.0,
}


def weather(spark, *changes):
    names = schemas.HOURLY_WEATHER.fieldNames()
    rows = [tuple({**WEATHER, **c}[n] for n in names) for c in changes]
    return spark.createDataFrame(rows, schemas.HOURLY_WEATHER)


def zones(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ZONE_LOOKUP)


@pytest.fixture(scope="module")
def lookup(spark):
    return zones(spark, (1, "EWR", "Newark", "EWR"), (2, "Queens", "Jamaica", "Boro"))


def hourly(spark, lookup, *changes):
    clean = clean_trips(trips(spark, *changes), JANUARY)
    return curation.hourly_demand(curation.trip_state(curation.canonical_trips(clean)), lookup)


def enriched(spark, rows):
    """Zone-hours given as (zone, condition intensity, trips, minutes, miles)."""
    columns = (
        "pickup_location_id long, precipitation double, total_trips long,"
        " avg_trip_duration_minutes double, avg_trip_distance double"
    )
    df = spark.createDataFrame(rows, columns)
    fixed = {
        "pickup_borough": F.lit("B"),
        "pickup_zone": F.concat(F.lit("Z"), F.col("pickup_location_id")),
        "rain": F.lit(0.0),
        "snowfall": F.lit(0.0),
        "avg_total_amount": F.lit(10.0),
        "avg_tip_percentage": F.lit(5.0),
    }
    return hourly_weather.enrich(df.withColumns(fixed))


def test_unknown_zone_keeps_null_names(spark, lookup):
    fact = curation.fact_trips(
        clean_trips(trips(spark, {"DOLocationID": 99}), JANUARY), lookup
    ).first()
    assert fact["pickup_zone"] == "Newark" and fact["dropoff_zone"] is None
    assert len(fact) == 31


def test_repeated_lookup_key_fails_the_query(spark):
    twice = zones(spark, (1, "A", "a", "x"), (1, "B", "b", "x"))
    with pytest.raises(SparkRuntimeException, match="repeated key"):
        hourly(spark, twice, {}).collect()


def test_large_lookup_is_not_broadcast(spark):
    df = spark.range(5)
    plan = df.join(lookups.bounded(spark.range(5), lookups.BROADCAST_ROWS + 1), "id")
    hinted = df.join(lookups.bounded(spark.range(5), 5), "id")
    assert "strategy=broadcast" not in plan._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" in hinted._jdf.queryExecution().logical().toString()


def test_missing_weather(spark, lookup):
    other_hour = {
        "tpep_pickup_datetime": datetime(2025, 1, 4, 12),
        "tpep_dropoff_datetime": datetime(2025, 1, 4, 12, 20),
    }
    rain = weather(spark, {"rain": None, "precipitation": 3.0})
    joined = hourly_weather.join_weather(hourly(spark, lookup, {}, other_hour), rain, JANUARY)
    coverage = hourly_weather.weather_coverage(joined).first()
    assert (coverage["joined_rows"], coverage["missing_weather_rows"]) == (2, 1)
    flags = {r["pickup_hour"]: (r["is_precipitation_hour"], r["is_rain_hour"]) for r in joined.collect()}
    assert flags == {10: (True, False), 12: (False, False)}
    labels = {r["pickup_hour"]: r["weather_condition"] for r in hourly_weather.enrich(joined).collect()}
    assert labels == {10: "moderate_rain", 12: "clear"}
    with pytest.raises(quality.QualityError, match="1 zone-hours"):
        quality.check_weather_join(joined)

    clean = clean_trips(trips(spark, {}, other_hour), JANUARY)
    flows = marts.od_flow(curation.canonical_trips(clean), rain, lookup, JANUARY, min_trips=1)
    assert {r["weather_condition"] for r in flows.collect()} == {"moderate_rain", None}


def test_route_minimum(spark, lookup):
    many = [{"fare_amount": float(i)} for i in range(5)] + [{"PULocationID": 2}]
    canonical = curation.canonical_trips(clean_trips(trips(spark, *many), JANUARY))
    flows = as_dicts(marts.od_flow(canonical, weather(spark, {}), lookup, JANUARY, min_trips=5))
    assert [(f["origin_zone"], f["destination_zone"], f["trip_count"]) for f in flows] == [
        ("Newark", "Jamaica", 5)
    ]


def test_impact_against_clear(spark):
    df = enriched(spark, [(1, 0.0, 10, 20.0, 2.0), (1, 20.0, 15, 26.0, 2.0), (2, 0.0, 10, 20.0, 0.0)])
    rows = {r["weather_condition"]: r for r in marts.weather_impact(df).collect()}
    assert rows["clear"]["demand_lift_pct"] == 0.0
    assert rows["heavy_rain"]["demand_lift_pct"] == 50.0
    assert rows["heavy_rain"]["duration_delta_minutes"] == 6.0
    # No distance: the trips still weigh in the denominator.
    assert rows["clear"]["avg_minutes_per_mile"] == 5.0


def test_without_baseline(spark):
    df = enriched(spark, [(1, 20.0, 15, 26.0, 2.0)])
    assert marts.weather_impact(df).count() == 0
    row = marts.zone_elasticity(df).first()
    assert row["demand_lift_pct"] is None
    assert row["weather_sensitivity_label"] == "low_weather_sensitive"


def test_zone_without_own_baseline(spark):
    df = enriched(spark, [(1, 0.0, 10, 20.0, 2.0), (2, 20.0, 15, 26.0, 2.0)])
    rows = {r["zone_id"]: r for r in marts.zone_elasticity(df).collect()}
    assert rows[1]["weather_sensitivity_label"] == "baseline"
    assert rows[2]["duration_delta_minutes"] is None


def test_condition_order(spark):
    df = enriched(spark, [(1, p, 1, 1.0, 1.0) for p in (20.0, 0.0, 1.0, 5.0)])
    ordered = marts.in_condition_order(marts.weather_impact(df)).collect()
    assert [r["weather_condition"] for r in ordered] == [
        "clear", "light_rain", "moderate_rain", "heavy_rain",
    ]


def test_trips_are_kept_by_every_aggregate(spark, small):
    t = Tables(spark, small)
    n = t.clean.count()
    total = lambda df, c="total_trips": df.agg(F.sum(c)).first()[0]
    assert n == 487
    assert total(t.hourly) == total(t.zone_totals) == total(t.daily) == n
    assert total(t.hourly_weather) == total(t.impact) == total(t.elasticity) == n
    assert total(marts.daily_zone_metrics(t.enriched), "trip_count") == n
    assert total(marts.hourly_summary(t.enriched)) == n
    clear = t.elasticity.filter("weather_condition = 'clear'").first()
    assert clear["demand_lift_pct"] == 0.0 and clear["tip_delta_pct"] == 0.0


def test_daily_columns(spark, small):
    day = Tables(spark, small).daily.orderBy("pickup_date").first()
    assert (day["pickup_date"], day["pickup_day_name"]) == (date(2024, 1, 1), "Monday")
