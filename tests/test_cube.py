"""Answers from the cube are equal to those from the zone-hours, for any filter."""

import pytest

from fareweather.operators import cube, explore, hourly_weather
from fareweather.plans.queries import tables

FILTERS = [
    {},
    {"borough": "ASIA"},
    {"conditions": ["light_rain", "snow"], "days": explore.WEEKENDS},
    {"borough": "EUROPE", "conditions": ["clear"], "days": explore.WEEKDAYS},
    {"borough": "NOWHERE"},
]


@pytest.fixture(scope="module")
def hours(spark, small):
    rows = hourly_weather.enrich(tables(spark, small).published_hours)
    # Rows with missing figures, zones and dates, and without trips.
    odd = rows.limit(40).selectExpr(
        *[
            f"IF(hash(pickup_hour, pickup_location_id) % 3 = 0, NULL, {c}) AS {c}"
            if c in ("pickup_zone", "pickup_date", "avg_total_amount", "avg_speed_mph", "rain", "total_trips") else c
            for c in rows.columns
        ]
    )
    return rows.union(odd).persist()


@pytest.mark.parametrize("chosen", FILTERS, ids=str)
def test_equal_to_the_direct_answer(hours, chosen):
    found = cube.build(hours).filtered(**chosen)
    direct = explore.explore(hours, **chosen)
    assert cube.overview_kpis(found).first().asDict() == explore.overview_kpis(direct).first().asDict()
    none = hours.where("false")
    rows = sorted(map(tuple, cube.regroup_zones(found).collect()), key=str)
    want = explore.regroup_zones(direct, none)
    assert rows == sorted(map(tuple, want.select(*cube.regroup_zones(found).columns).collect()), key=str)


def test_any_layout_gives_the_same_states(hours):
    one, two = cube.build(hours.repartition(1)), cube.build(hours.repartition(11))
    for a, b in ((one.zones, two.zones), (one.days, two.days), (one.values, two.values)):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_filter_reads_the_cube_only(spark, small):
    t = tables(spark, small)
    files = cube.regroup_zones(t.published_cube.filtered("ASIA")).inputFiles()
    assert files and all("/cube_zones/" in name for name in files)
