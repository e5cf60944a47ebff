import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fareweather.operators import explore
from tests.helpers import as_dicts


def median_by_hand(rows):
    rows = sorted((v, w) for v, w in rows if v is not None and w is not None and w > 0)
    half, upto = sum(w for _, w in rows) / 2, 0
    for value, weight in rows:
        upto += weight
        if upto >= half:
            return value
    return 0.0


CASES = {
    "plain": [(1.0, 1), (2.0, 1), (3.0, 2)],
    "exact half": [(1.0, 2), (2.0, 2)],
    "one value": [(5.0, 3)] * 4,
    "nulls and zero weights": [(None, 9), (1.0, 0), (7.0, None), (3.0, 1)],
    "nothing": [(None, 1), (1.0, 0)],
    "one hot value": [(2.5, 100)] * 50 + [(float(i), 1) for i in range(60)],
    "wide range": [(1e-9, 3), (1e12, 2), (1e-9 + 1e-15, 2)],
    "random": [(random.Random(i).gauss(0, 1e4), i % 7) for i in range(500)],
    "skewed": [(random.Random(i).paretovariate(0.3), 1 + i % 3) for i in range(501)],
}


@pytest.mark.parametrize("case", CASES)
def test_weighted_median_matches_brute_force(spark, case):
    df = spark.createDataFrame(CASES[case], "v double, w long").repartition(4)
    assert explore.weighted_median(df, "v", "w").first()[0] == median_by_hand(CASES[case])


def test_missing_columns_give_zero(spark):
    df = spark.range(3)
    assert explore.weighted_median(df, "v", "id").first()[0] == 0.0
    assert df.agg(explore.weighted_average(df, "v", "id")).first()[0] == 0.0


HOURS = (
    "pickup_date date, pickup_hour long, is_weekend boolean, pickup_location_id long,"
    " pickup_borough string, pickup_zone string, weather_condition string, total_trips long,"
    " total_revenue double, avg_total_amount double, rain double, precipitation double"
)


@pytest.fixture(scope="module")
def hours(spark):
    from datetime import date

    a, b = date(2025, 1, 4), date(2025, 1, 6)
    return spark.createDataFrame(
        [
            (a, 1, True, 1, "A", "a", "snow", 4, 40.0, 10.0, 0.0, 0.0),
            (a, 2, True, 2, "B", "b", "clear", 1, 9.0, 9.0, 0.3, 1.0),
            (b, 1, False, 1, "A", "a", "clear", 2, 40.0, None, 0.0, 0.5),
            (b, 1, False, 3, None, None, "clear", 7, 70.0, 10.0, 0.0, 0.0),
        ],
        HOURS,
    )


def test_filters_pass_through(spark, hours):
    assert explore.with_value(hours, "pickup_borough", "All").count() == 4
    assert explore.with_value(hours, "nothing", "A").count() == 4
    assert explore.with_value(hours, "pickup_location_id", "1").count() == 2
    assert explore.with_values(hours, "weather_condition", []).count() == 4
    assert explore.with_values(hours, "weather_condition", ["snow"]).count() == 1
    assert explore.with_day_type(hours, "Comparison").count() == 4
    assert explore.explore(hours, "A", ["clear"], "Weekdays").count() == 1


def test_kpis(spark, hours):
    kpi = hours.withColumns(
        {"avg_trip_duration_minutes": F.lit(5.0), "avg_trip_distance": F.lit(2.0)}
    )
    row = explore.overview_kpis(kpi).first()
    assert (row["total_trips"], row["pickup_days"], row["avg_trips_per_day"]) == (14, 2, 7.0)
    assert row["avg_fare"] == pytest.approx(119 / 12)
    assert (row["median_fare"], row["median_duration"]) == (10.0, 5.0)
    assert row["rainy_day_share"] == 50.0
    empty = explore.overview_kpis(kpi.limit(0)).first()
    assert empty["total_trips"] == 0 and empty["median_fare"] == 0.0


def test_patterns(spark, hours):
    both = as_dicts(explore.hourly_pattern_by_day_type(hours))
    assert both == [
        {"pickup_hour": 1, "day_type": "Weekdays", "total_trips": 9},
        {"pickup_hour": 1, "day_type": "Weekends", "total_trips": 4},
        {"pickup_hour": 2, "day_type": "Weekends", "total_trips": 1},
    ]
    assert [r["total_trips"] for r in explore.hourly_pattern(hours).collect()] == [13, 1]
    trend = explore.daily_trend(hours).collect()
    assert [r["avg_precipitation"] for r in trend] == [0.5, 0.25]


def test_regroup_leaves_unnamed_zones_out(spark, hours):
    rows = as_dicts(explore.regroup_zones(hours, hours).orderBy("pickup_location_id"))
    assert [(r["pickup_zone"], r["total_trips"], r["total_revenue"], r["avg_total_amount"]) for r in rows] == [
        ("a", 6, 80.0, 10.0),  # the row without a fare counts in trips only
        ("b", 1, 9.0, 9.0),
    ]
    fallback = spark.range(2)
    assert explore.zones_or_fallback(hours.limit(0), fallback) is fallback
    assert explore.regroup_zones(spark.range(1), fallback) is fallback


def test_map_values(spark):
    df = spark.createDataFrame(
        [("1", "A", 4.0), ("2.0", "A", 2.0), ("x", "B", 1.0), ("3", "B", None)],
        "id string, pickup_borough string, m double",
    )
    rows = {r["map_id"]: r for r in explore.map_values(df, "id", "m", True, log=True).collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"]["display_value"] == 3.0
    assert rows["1"]["map_color_value"] == pytest.approx(1.3862943611)
    kept = explore.map_values(df, "id", "m", True, total=True, keep_missing=True)
    assert {r["map_id"]: r["display_value"] for r in kept.collect()} == {"1": 6.0, "2": 6.0, "3": 0.0}
    domain = explore.map_domain(kept).first()
    assert (domain["min_value"], domain["max_value"]) == (0.0, 6.0)


def test_top_lists_put_nulls_last_and_break_ties(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, None), (4, 5.0)], "id long, m double")
    assert [r["id"] for r in explore.top_by(df, "m", 3, "id").collect()] == [4, 1, 3]
    assert [r["id"] for r in explore.top_by(df, "m", 9, "id", ascending=True).collect()] == [1, 3, 4, 2]


def test_best_conditions_ties_follow_display_order(spark):
    df = spark.createDataFrame(
        [("snow", 5.0, 1.0, 2.0, 9), ("light_rain", 5.0, 3.0, None, 1)],
        "weather_condition string, demand_lift_pct double, duration_delta_minutes double,"
        " fare_delta_amount double, total_trips long",
    )
    best = {r["metric"]: (r["weather_condition"], r["value"]) for r in explore.best_conditions(df).collect()}
    assert best == {
        "demand_lift_pct": ("light_rain", 5.0),
        "duration_delta_minutes": ("light_rain", 3.0),
        "fare_delta_amount": ("snow", 2.0),
        "total_trips": ("snow", 9.0),
    }


def test_options(spark):
    df = spark.createDataFrame(
        [("Queens", "snow"), ("EWR", "clear"), (None, "clear"), ("Bronx", "fog")],
        "pickup_borough string, weather_condition string",
    )
    rows = [(r["filter"], r["value"]) for r in explore.filter_options(df).collect()]
    assert rows == [
        ("borough", "Bronx"), ("borough", "Queens"),
        ("weather_condition", "clear"), ("weather_condition", "snow"),
    ]


def test_error_histogram(spark):
    df = spark.createDataFrame([(float(i),) for i in range(61)], "absolute_error double")
    bins = explore.error_histogram(df).collect()
    assert len(bins) == 60 and sum(r["row_count"] for r in bins) == 61
    assert bins[-1]["row_count"] == 2  # the largest error belongs to the last bin
    same = spark.createDataFrame([(2.0,)] * 3, "absolute_error double")
    assert [tuple(r) for r in explore.error_histogram(same).collect()] == [(0, 2.0, 3)]


def test_long_predictions(spark, hours):
    rows = explore.daily_predictions(hours.withColumn("predicted_total_trips", F.lit(1.5)))
    got = pd.DataFrame(as_dicts(rows))
    assert list(got["series"]) == ["actual_total_trips", "predicted_total_trips"] * 2
    assert list(got["trips"]) == [5.0, 3.0, 9.0, 3.0]


def test_column_choice(spark):
    df = spark.createDataFrame([("2025-01-01", 1)], "pickup_date string, is_weekend int")
    assert explore.first_existing(df, ["x", "is_weekend"]) == "is_weekend"
    assert explore.first_existing(df, ["x"]) is None
    assert explore.select_existing(df, ["x", "pickup_date"]).columns == ["pickup_date"]
    assert explore.select_existing(df, ["x"]) is df
    assert dict(explore.normal_types(df).dtypes) == {"pickup_date": "date", "is_weekend": "boolean"}


def test_routes_and_candidates(spark):
    flows = spark.createDataFrame(
        [(1, 2, "snow", "a", None, 7), (1, 3, None, "a", "c", 9)],
        "origin_location_id long, destination_location_id long, weather_condition string,"
        " origin_zone string, destination_zone string, trip_count long",
    )
    assert [r["route"] for r in explore.top_routes(flows).collect()] == ["a → c", "a → None"]
    zones = spark.createDataFrame(
        [(1, "z1", "Stable weather response zones", 9.0), (2, "z2", "HIGH demand", 1.0), (3, "z3", None, 5.0)],
        "zone_id long, pickup_zone string, cluster_profile string, avg_demand_lift_pct double",
    )
    assert [r["pickup_zone"] for r in explore.candidate_zones(zones).collect()] == ["z2"]
    spread = [tuple(r) for r in explore.cluster_distribution(zones).collect()]
    assert sorted(spread, key=str) == sorted(
        [("HIGH demand", 1), ("Stable weather response zones", 1), (None, 1)], key=str
    )
