"""The full chain on files, and its stages one by one."""

import json
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fareweather.config import ClusterSettings, ForestSettings
from fareweather.operators import cleaning, quality
from fareweather.plans import pipeline
from fareweather.plans.pipeline import STAGES, Chain
from fareweather.plans.standin import SETTINGS, Tables
from fareweather.sources import readers, versions, writers


@pytest.fixture(scope="module")
def finished(spark, middle, tmp_path_factory):
    """Raw files in their outside formats, then the whole chain."""
    base = tmp_path_factory.mktemp("chain")
    # The join check refuses hours without weather, so this chain has none.
    t = Tables(spark, middle, gaps=False)
    settings = replace(
        SETTINGS,
        forest=ForestSettings(trees=5, max_depth=6),
        clusters=ClusterSettings(starts=3),
    )
    chain = Chain(spark, str(base), settings)
    t.raw.write.parquet(chain.layout.trips[0])
    (base / "external").mkdir()
    t.zones.toPandas().to_csv(chain.layout.zone_lookup, index=False)
    hours = t.weather.orderBy("weather_datetime").toPandas()
    hourly = {"time": [d.strftime("%Y-%m-%dT%H:%M") for d in hours["weather_datetime"]]}
    for name in hours.columns[3:]:
        hourly[name] = [None if v != v else v for v in hours[name].tolist()]
    with open(chain.layout.weather_payload, "w") as file:
        json.dump({"hourly": hourly, "hourly_units": {}}, file)
    assert chain.run_all() == list(STAGES)
    return chain, t


def table(chain, layer, name):
    return chain.read(layer, name)


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(columns), b.select(columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_published_tables_match_the_plans(finished):
    chain, t = finished
    same(table(chain, "processed", "clean_trips"), t.clean)
    same(table(chain, "curated", "agg_hourly_demand_weather"), t.hourly_weather)
    same(table(chain, "curated", "weather_impact_summary"), t.impact)
    same(table(chain, "curated", "zone_weather_elasticity"), t.elasticity)
    same(table(chain, "curated", "od_flow_weather"), t.flows)
    same(table(chain, "curated", "agg_daily_summary"), t.daily)
    same(table(chain, "curated", "agg_zone_summary"), t.zone_totals)


def test_trip_ids_are_dense_and_stable(finished):
    chain, t = finished
    facts = table(chain, "curated", "fact_trips")
    same(facts.drop("trip_id"), t.facts)
    n, first, last, different = facts.agg(
        F.count("trip_id"), F.min("trip_id"), F.max("trip_id"), F.countDistinct("trip_id")
    ).first()
    assert (first, last, different) == (1, n, n)
    columns = ["trip_id", "vendor_id", "pickup_datetime", "dropoff_location_id", "tip_amount"]
    before = sorted(map(tuple, facts.select(columns).collect()))
    chain.curate()
    again = table(chain, "curated", "fact_trips").select(columns)
    assert sorted(map(tuple, again.collect())) == before


def test_ordered_tables(finished):
    chain, _ = finished
    assert [r[0] for r in table(chain, "curated", "dim_location").select("location_id").collect()] == list(range(1, 26))


def test_reports(finished):
    chain, t = finished
    cleaning = readers.read_report(chain.spark, chain.layout.report("processed", "cleaning_report"))
    counts = readers.report_rows(cleaning, "rows").first()
    assert (counts["raw_rows"], counts["cleaned_rows"]) == (10_200, t.clean.count())
    metrics = readers.read_report(chain.spark, chain.layout.report("ml", "demand_model_metrics"))
    assert readers.report_rows(metrics, "train_period").first()["train_rows"] == t.split[0].count()
    zones = readers.read_report(chain.spark, chain.layout.report("ml", "zone_cluster_summary"))
    assert zones.select("n_clusters").first()[0] == 2
    assert readers.report_rows(zones, "cluster_summary").count() == 2
    assert -1 <= readers.report_rows(zones, "silhouette").first()[0] <= 1
    weather = readers.read_report(chain.spark, chain.layout.report("external", "weather_report"))
    assert weather.select("end_date").first()[0] == "2024-01-31"


def test_model_outputs(finished):
    chain, t = finished
    results = table(chain, "ml", "demand_prediction_results")
    assert results.count() == t.split[1].count() > 0 and len(results.columns) == 17
    assert results.filter("predicted_total_trips < 0 OR absolute_error <> abs(prediction_error)").count() == 0
    assert table(chain, "ml", "zone_weather_clusters").count() == t.zone_features.count() > 20


def test_missing_input_stops_the_run(spark, tmp_path):
    with pytest.raises(readers.MissingInput):
        Chain(spark, str(tmp_path), SETTINGS).run_all()


def plans_of(spark, work):
    """Texts of the plans that a piece of work executes."""
    store = spark._jsparkSession.sharedState().statusStore()

    def known():
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        rows = store.executionsList()
        return {rows.apply(k).executionId(): rows.apply(k).physicalPlanDescription() for k in range(rows.size())}

    before = known()
    work()
    return [plan for key, plan in known().items() if key not in before]


def test_counts_of_the_writing_job_equal_a_second_pass(finished):
    chain, t = finished
    report = readers.read_report(chain.spark, chain.layout.report("processed", "cleaning_report"))
    clean = table(chain, "processed", "clean_trips")
    want = cleaning.cleaning_report(t.raw, clean, chain.period, chain.settings.limits).first().asDict()
    got = readers.report_rows(report, "rows").first().asDict()
    assert got == want
    summary = readers.report_rows(report, "summary").first().asDict()
    want = cleaning.cleaning_summary(clean).first().asDict()
    for name, value in want.items():
        assert summary[name] == (value.isoformat(timespec="milliseconds") if name.endswith("datetime") else value), name
    counts = readers.report_rows(readers.read_report(chain.spark, chain.layout.report("curated", "curated_report")), "row_counts")
    for name, rows in counts.select("table_name", "row_count").collect():
        assert rows == table(chain, "curated", name).count()


def test_cleaning_reads_the_raw_files_once(finished, monkeypatch):
    """One job writes and counts; beside it only footers are read."""
    chain, _ = finished
    scans = []
    plain = cleaning.rejections
    monkeypatch.setattr(cleaning, "rejections", lambda *a: scans.append(1) or plain(*a))
    monkeypatch.setattr(quality, "invalid_counts", lambda *a: scans.append(1))
    monkeypatch.setattr(cleaning, "cleaning_summary", lambda *a: scans.append(1))
    before = table(chain, "processed", "clean_trips").count()
    plans = plans_of(chain.spark, chain.clean)
    read = [plan for plan in plans if re.search(r"ReadSchema: struct<\w", plan)]
    assert len(read) == 1 and "WriteFiles" in read[0] and read[0].count("ReadSchema") == 1
    assert not scans and table(chain, "processed", "clean_trips").count() == before


def test_recount_when_a_task_was_counted_twice(finished, monkeypatch):
    """A map task that runs again adds to what is observed below the shuffle."""

    class Twice(pipeline.Observation):
        @property
        def get(self):
            return {name: 2 * n for name, n in super().get.items()}

    chain, t = finished
    scans, plain = [], cleaning.rejections
    monkeypatch.setattr(cleaning, "rejections", lambda *a: scans.append(1) or plain(*a))
    monkeypatch.setattr(pipeline, "Observation", Twice)
    chain.clean()
    report = readers.read_report(chain.spark, chain.layout.report("processed", "cleaning_report"))
    assert scans and readers.report_rows(report, "rows").first()["raw_rows"] == t.raw.count()


def test_facts_have_a_folder_a_date(finished):
    chain, _ = finished
    facts = table(chain, "curated", "fact_trips")
    day = facts.agg(F.min("pickup_date")).first()[0]
    one = facts.where(F.col("pickup_date") == F.lit(day))
    text = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in text
    files = facts.select("pickup_date", F.col("_metadata.file_path").alias("file")).distinct()
    assert files.groupBy("file").count().where("count > 1").isEmpty()


def test_a_failed_stage_leaves_the_old_version(finished, monkeypatch):
    chain, _ = finished
    before = table(chain, "curated", "agg_daily_summary")
    rows, path = before.count(), chain.layout.table("curated", "agg_daily_summary")
    name = versions.current(chain.spark, path)

    def broken(df, path, *rest, **more):
        df.limit(1).write.parquet(path)
        raise RuntimeError("lost")

    monkeypatch.setattr(writers, "write_ordered", broken)
    with pytest.raises(RuntimeError):
        chain.curate()
    assert versions.current(chain.spark, path) == name and before.count() == rows
    assert table(chain, "curated", "agg_daily_summary").count() == rows


def test_a_rerun_skips_what_is_finished(finished):
    chain, _ = finished
    again = Chain(chain.spark, chain.layout.base, chain.settings)
    for name in STAGES:
        if not again.finished(name):
            getattr(again, name)()
    assert again.run_all(resume=True) == []
    # Other settings, or another version of an input, run the stages that depend on it.
    other = Chain(chain.spark, chain.layout.base, replace(chain.settings, min_route_trips=7))
    assert not any(other.finished(name) for name in STAGES)
    again.publish_weather()
    assert [name for name in STAGES if not again.finished(name)] == ["join_weather", "build_marts"]


def test_versions_are_kept_and_dropped(spark, tmp_path):
    path = f"{tmp_path}/numbers"
    frames = []
    for n in (1, 2, 3):
        versions.publish(spark, path, lambda p: spark.range(n).write.parquet(p))
        frames.append(readers.read_table(spark, path))
    assert [f.count() for f in frames[1:]] == [2, 3]
    assert len([p for p in (tmp_path / "numbers").iterdir() if p.name.startswith("v-")]) == versions.KEEP
    spark.range(5).write.parquet(f"{tmp_path}/plain")
    assert readers.read_table(spark, f"{tmp_path}/plain").count() == 5 and versions.current(spark, f"{tmp_path}/plain") is None


def test_long_report_sections_are_an_error(spark):
    with pytest.raises(Exception, match="more than 10000 rows"):
        writers.run_report(spark, rows=spark.range(20_000)).collect()
    assert len(writers.run_report(spark, rows=spark.range(10_000)).first()["rows"]) == 10_000
