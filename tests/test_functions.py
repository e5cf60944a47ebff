from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fareweather.functions import labels, numeric, timing
from fareweather.sources.periods import Period
from tests.helpers import values


def test_rounding_follows_the_scaled_double(spark):
    got = values(
        spark,
        numeric.round_half(F.col("x"), 2),
        "x double",
        *[(x,) for x in (1.005, 0.285, 0.125, -0.125, 2.5, -0.001, None, 1e10 + 0.25)],
    )
    assert got == [1.0, 0.28, 0.13, -0.13, 2.5, 0.0, None, 1e10 + 0.25]
    assert str(got[5]) == "0.0"


def test_rounding_to_even(spark):
    got = values(spark, numeric.round_even(F.col("x"), 0), "x double", (0.5,), (1.5,), (2.5,))
    assert got == [0.0, 2.0, 2.0]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(10**9), 10**9), min_size=1, max_size=50))
def test_exact_sum_does_not_depend_on_order(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(3)
    got = df.agg(numeric.exact_sum(F.col("x")).alias("s"), numeric.exact_avg(F.col("x"))).first()
    assert got[0] == float(Decimal(sum(cents)) / 100)
    assert got[1] == pytest.approx(sum(cents) / 100 / len(cents))


def test_two_weighted_means_differ_on_nulls(spark):
    df = spark.createDataFrame([(10.0, 1), (None, 3), (20.0, 0)], "x double, w long")
    x, w = F.col("x"), F.col("w")
    loose, strict = df.agg(
        numeric.weighted_mean(x, w), numeric.strict_weighted_mean(x, w)
    ).first()
    assert loose == 2.5  # the null row's weight stays in the denominator
    assert strict == 10.0
    assert df.filter("w > 9").agg(numeric.weighted_mean(x, w)).first()[0] is None


def test_lift_needs_a_baseline(spark):
    got = values(
        spark, numeric.lift_pct(F.col("x"), F.col("b")), "x double, b double",
        (5.0, 4.0), (5.0, 0.0), (5.0, None),
    )
    assert got == [25.0, None, None]


def test_minutes_are_boundaries_crossed(spark):
    rows = [
        (datetime(2025, 1, 1, 0, 0, 59), datetime(2025, 1, 1, 0, 1, 1)),
        (datetime(2025, 1, 1, 0, 1, 0), datetime(2025, 1, 1, 0, 1, 59)),
        (datetime(2025, 1, 1, 0, 1, 0), datetime(2025, 1, 1, 0, 0, 59)),
        (datetime(2025, 3, 9, 1, 59), datetime(2025, 3, 9, 3, 1)),
        (datetime(2025, 1, 1), None),
    ]
    schema = "a timestamp_ntz, b timestamp_ntz"
    minutes = timing.minutes_between(F.col("a"), F.col("b"))
    assert values(spark, minutes, schema, *rows) == [1, 0, -1, 62, None]
    # The session time zone, here one with a clock change that day, is not used.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(spark, minutes, schema, *rows) == [1, 0, -1, 62, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_calendar(spark):
    days = [(datetime(2025, 1, d, 5),) for d in (4, 5, 6)] + [(None,)]
    columns = timing.calendar_columns(F.col("t"))
    schema = "t timestamp_ntz"
    assert values(spark, columns["is_weekend"], schema, *days) == [True, True, False, None]
    assert values(spark, columns["pickup_dayofweek"], schema, *days) == [6, 0, 1, None]
    names = values(spark, columns["pickup_day_name"], schema, *days)
    assert names == ["Saturday", "Sunday", "Monday", None]
    assert values(spark, columns["pickup_date"], schema, *days)[0] == date(2025, 1, 4)


def test_conditions(spark):
    label = labels.classify_condition(F.col("s"), F.col("r"), F.col("p"))
    rows = [
        (0.0, 0.0, 0.0), (0.0, 0.1, 0.0), (0.0, 2.5, 0.0), (0.0, 10.0, 0.0),
        (0.0, 10.1, 0.0), (0.1, 20.0, 0.0), (None, None, 3.0), (None, None, None),
    ]
    got = values(spark, label, "s double, r double, p double", *rows)
    assert got == [
        "clear", "light_rain", "moderate_rain", "moderate_rain",
        "heavy_rain", "snow", "moderate_rain", "clear",
    ]


def test_condition_rank(spark):
    rank = labels.condition_rank(F.col("c"))
    assert values(spark, rank, "c string", ("snow",), ("clear",), ("fog",), (None,)) == [5, 1, 99, 99]


def test_sensitivity(spark):
    label = labels.sensitivity_label(F.col("c"), F.col("l"), F.col("m"))
    rows = [
        ("snow", 25.0, 0.0), ("snow", 24.99, 0.0), ("snow", 10.0, 0.0), ("snow", 9.99, 0.0),
        ("snow", None, 6.0), ("snow", None, None), ("clear", 99.0, 99.0),
    ]
    got = values(spark, label, "c string, l double, m double", *rows)
    assert [g.split("_")[0] for g in got] == [
        "high", "medium", "medium", "low", "high", "low", "baseline",
    ]


PROFILES = [
    ((15.0, 0.0, 0.0, 60_000.0, 100), labels.PROFILE_HIGH_VOLUME_LIFT),
    ((15.0, 9.0, 9.0, 20_000.0, 10), labels.PROFILE_LIFT),
    ((0.0, 2.0, 0.0, 30_000.0, 10), labels.PROFILE_HIGH_VOLUME_SLOW),
    ((0.0, 0.0, 2.0, 20_000.0, 10), labels.PROFILE_SLOW),
    ((-5.0, -2.0, 0.0, 50_000.0, 100), labels.PROFILE_HIGH_VOLUME_FAST),
    ((-5.0, -2.0, 0.0, 9_999.0, 10), labels.PROFILE_LOW_VOLUME_FAST),
    ((-5.0, -2.0, 0.0, 20_000.0, 10), labels.PROFILE_FAST),
    ((-5.0, 0.0, 0.0, 50_000.0, 100), labels.PROFILE_HIGH_VOLUME_LOWER),
    ((-5.0, 0.0, 0.0, 20_000.0, 10), labels.PROFILE_LOWER),
    ((None, None, None, None, None), labels.PROFILE_STABLE),
]


def test_profiles(spark):
    columns = [F.col(c) for c in "lmptz"]
    got = values(
        spark, labels.group_profile(*columns), "l double, m double, p double, t double, z long",
        *[row for row, _ in PROFILES],
    )
    assert got == [label for _, label in PROFILES]


def test_periods():
    year_end = Period.of(["2025-12"])
    assert (year_end.start, year_end.end) == (date(2025, 12, 1), date(2026, 1, 1))
    quarter = Period.of(["2025-03", "2025-01", "2025-02"])
    assert quarter.label == "2025-01_to_2025-03"
    assert quarter.last_day == date(2025, 3, 31)
    assert quarter.hours == 90 * 24
    assert year_end.label == "2025-12"
    with pytest.raises(ValueError):
        Period.of([])


def test_half_up_matches_decimal_on_quarters(spark):
    numbers = [i / 8 for i in range(-40, 41)]
    got = values(spark, numeric.round_half(F.col("x"), 2), "x double", *[(n,) for n in numbers])
    want = [float(Decimal(n).quantize(Decimal("0.01"), ROUND_HALF_UP)) for n in numbers]
    assert got == want


def test_sums_keep_twelve_decimals_and_any_order(spark):
    values = [1.00004] * 3 + [1 / 7] * 500 + [123456.789012] * 7
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.repartition(5).agg(numeric.exact_sum(F.col("x")), numeric.exact_avg(F.col("x"))).first()
    again = df.orderBy(F.desc("x")).agg(numeric.exact_sum(F.col("x")), numeric.exact_avg(F.col("x"))).first()
    assert tuple(got) == tuple(again)
    assert got[0] == pytest.approx(sum(values), abs=1e-8)
    three = df.filter("x BETWEEN 1 AND 2").agg(numeric.exact_avg(F.col("x"))).first()[0]
    assert three == 1.00004


def test_sums_pass_on_what_is_not_finite(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([("a", nan), ("a", 1.0), ("b", inf), ("b", 2.0), ("c", 3.5e15), ("c", 0.5), ("d", None)], "k string, x double")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(numeric.exact_sum(F.col("x")).alias("s")).collect()}
    assert got["a"] != got["a"] and got["b"] == inf and got["c"] == 3.5e15 + 0.5 and got["d"] is None


def test_weighted_means_of_fractions_and_nan(spark):
    df = spark.createDataFrame([(1.00004, 2.0), (3.0, 0.5), (float("nan"), 4.0), (None, 1.0)], "x double, w double")
    x, w = F.col("x"), F.col("w")
    got = df.agg(numeric.strict_weighted_mean(x, w).alias("m")).first()[0]
    assert got == pytest.approx((2.00008 + 1.5) / 2.5, abs=1e-12)
    loose = df.filter("x IS NULL OR x < 9").agg(numeric.weighted_mean(x, w)).first()[0]
    assert loose == pytest.approx((2.00008 + 1.5) / 3.5, abs=1e-12)
