from datetime import datetime

import pytest

from fareweather.operators import cleaning, quality
from fareweather.sources.periods import Period
from tests.helpers import as_dicts, trips

JANUARY = Period.of(["2025-01"])

BAD = {
    "missing_timestamp": {"tpep_dropoff_datetime": None},
    "outside_period": {
        "tpep_pickup_datetime": datetime(2025, 2, 1),
        "tpep_dropoff_datetime": datetime(2025, 2, 1, 0, 9),
    },
    "passenger_count": {"passenger_count": None},
    "trip_distance": {"trip_distance": 100.5},
    "trip_duration": {"tpep_dropoff_datetime": datetime(2025, 1, 4, 16, 1)},
    "fare_amount": {"fare_amount": -1.0},
    "tip_amount": {"tip_amount": None},
    "total_amount": {"total_amount": 0.0},
    "pickup_zone": {"PULocationID": 264},
    "dropoff_zone": {"DOLocationID": 0},
}


def test_good_rows_keep_and_derive(spark):
    row = as_dicts(cleaning.clean_trips(trips(spark, {}), JANUARY))[0]
    assert row["trip_duration_minutes"] == 30
    assert row["tip_percentage"] == 25.0
    assert row["average_speed_mph"] == 10.0
    assert row["pickup_day_name"] == "Saturday" and row["is_weekend"]
    assert len(row) == 28


@pytest.mark.parametrize("rule", BAD)
def test_each_rule_rejects_and_is_counted_alone(spark, rule):
    raw = trips(spark, {}, BAD[rule])
    assert cleaning.clean_trips(raw, JANUARY).count() == 1
    counts = cleaning.rejections(raw, JANUARY).first().asDict()
    assert counts.pop("raw_rows") == 2
    assert {k: v for k, v in counts.items() if v} == {f"rejected_{rule}": 1}


def test_limits_are_inclusive_or_not(spark):
    edge = [
        {"passenger_count": 6.0},
        {"trip_distance": 100.0},
        {"tpep_dropoff_datetime": datetime(2025, 1, 4, 16, 0, 59)},
        {"fare_amount": 0.0},
        {"PULocationID": 263},
        {"tpep_pickup_datetime": datetime(2025, 1, 1), "tpep_dropoff_datetime": datetime(2025, 1, 1, 1)},
    ]
    clean = cleaning.clean_trips(trips(spark, *edge), JANUARY)
    assert clean.count() == len(edge)
    free = clean.filter("fare_amount = 0").first()
    assert free["tip_percentage"] == 0.0


def test_copies_become_one_row(spark):
    raw = trips(spark, *([{}] * 40 + [{"trip_distance": 6.0}]))
    clean = cleaning.clean_trips(raw, JANUARY)
    assert clean.count() == 2
    report = cleaning.cleaning_report(raw, clean, JANUARY).first()
    assert (report["raw_rows"], report["cleaned_rows"], report["removed_rows"]) == (41, 2, 39)
    assert report["removed_percentage"] == 95.12


def test_empty_input_reports_zero(spark):
    raw = trips(spark, {}).limit(0)
    report = cleaning.cleaning_report(raw, cleaning.clean_trips(raw, JANUARY), JANUARY).first()
    assert report["removed_percentage"] == 0.0


def test_check_clean(spark):
    clean = cleaning.clean_trips(trips(spark, {}), JANUARY)
    quality.check_clean(clean)
    with pytest.raises(quality.QualityError, match="empty"):
        quality.check_clean(clean.limit(0))
    with pytest.raises(quality.QualityError, match="invalid_total"):
        quality.check_clean(cleaning.with_derived(trips(spark, {"total_amount": 0.0})))
