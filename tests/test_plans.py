"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from fareweather.operators import cleaning, curation
from fareweather.plans.queries import QUERIES, tables
from fareweather.plans.standin import Tables
from fareweather.sources import readers, schemas
from fareweather.sources.periods import Period
from tests.helpers import trips


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "trips.parquet")
    trips(spark, {}).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return readers.scan_trips(spark, [path])


def test_filters_reach_the_scan(raw):
    text = plan(cleaning.clean_trips(raw, Period.of(["2025-01"])))
    pushed = text[text.index("PushedFilters") :].split("]")[0]
    for part in ("tpep_pickup_datetime", "trip_distance", "passenger_count", "PULocationID"):
        assert part in pushed


def test_counting_rules_reads_rule_columns_only(raw):
    text = plan(cleaning.rejections(raw, Period.of(["2025-01"])))
    assert "store_and_fwd_flag" not in text and "congestion_surcharge" not in text


def test_copies_are_merged_before_the_shuffle(raw):
    text = plan(cleaning.clean_trips(raw, Period.of(["2025-01"])))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_route_flow_moves_partial_sums_only(spark, small):
    t = Tables(spark, small)
    text = plan(t.flows)
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    by_route = "Exchange hashpartitioning(pickup_location_id"
    assert text.count(by_route) == 1
    assert "partial_count" in text[text.index(by_route) :]


def test_totals_share_one_pass_over_trips(spark, small):
    t = Tables(spark, small)
    totals = [
        curation.hourly_demand(t.published_state, t.zones, t.zone_range),
        curation.zone_summary(t.published_state, t.zones, t.zone_range),
        curation.daily_summary(t.published_state),
    ]
    for df in totals:
        text = plan(df)
        assert "trip_state" in text and "clean_trips" not in text and "events" not in text
    direct = t.trips.agg(F.count("*"), F.min("pickup_datetime"), F.max("pickup_datetime")).first()
    whole = totals[1].agg(F.sum("total_trips"), F.min("first_pickup_datetime"), F.max("last_pickup_datetime")).first()
    assert tuple(direct) == tuple(whole)


def test_impact_groups_once(spark, small):
    text = plan(Tables(spark, small).impact)
    # Trips, hours and conditions are shuffled once each; the baseline is a window.
    assert text.count("Exchange hashpartitioning(weather_condition") == 1
    assert "NestedLoop" not in text


CHECKED = [
    "weather_decode",
    "zone_shape_keys",
    "fact_trips",
    "agg_zone_summary",
    "hourly_weather_join",
    "daily_zone_metrics",
    "zone_elasticity",
    "od_flow",
    "overview_kpis",
    "weighted_median_lineitem",
    "map_values",
    "mean_baseline",
    "zone_features",
    "borough_silhouette",
]


@pytest.mark.parametrize("name", CHECKED)
def test_no_python_and_no_cross_join(spark, small, name):
    text = plan(QUERIES[name](tables(spark, small)))
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_schema_is_declared(raw):
    assert raw.schema.fieldNames() == schemas.RAW_TRIPS.fieldNames()


def test_two_folders_of_one_name_and_rewritten_input(spark, small, tmp_path):
    """Published tables of one chain never replace what another reads."""
    import shutil

    first = Tables(spark, small).published_hours
    count = first.count()
    other = tmp_path / "sf0.001"
    shutil.copytree(small, other, copy_function=shutil.copyfile)
    other.chmod(0o755)  # the given folder may be read-only, and a copy takes that on
    one, two = Tables(spark, str(other)), Tables(spark, str(other))
    assert one.published_hours.count() == two.published_hours.count() == first.count() == count
    seen = tables(spark, str(other))
    assert tables(spark, str(other)) is seen
    (other / "extra.parquet").write_bytes((other / "region.parquet").read_bytes())
    assert tables(spark, str(other)) is not seen
