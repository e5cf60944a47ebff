"""The whole chain from raw files to models, each stage behind its check.

Stages hand over published Parquet tables: a lost executor or a failed stage
never costs more than the stage itself. A table is published as a version behind a
pointer, so a stage that fails leaves what others read as it was, and a stage that is
finished, with the same settings and inputs, can be skipped by a rerun. Counts, checks
and reports of a stage come from the jobs that write its tables, not from reading the
tables again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass
from functools import cached_property, wraps
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from fareweather.config import Settings
from fareweather.functions.local import local_rows
from fareweather.operators import (
    cleaning,
    curation,
    demand_model,
    explore,
    hourly_weather,
    marts,
    quality,
    zone_model,
)
from fareweather.sources import readers, versions, writers
from fareweather.sources.periods import Period


@dataclass(frozen=True)
class Layout:
    """Where inputs are expected and results go, below one base folder."""

    base: str
    period: Period
    fleet: str = "yellow"

    @property
    def trips(self) -> list[str]:
        return readers.trip_paths(f"{self.base}/raw", self.period, self.fleet)

    @property
    def zone_lookup(self) -> str:
        return f"{self.base}/external/taxi_zone_lookup.csv"

    @property
    def weather_payload(self) -> str:
        return f"{self.base}/external/weather_payload_{self.period.label}.json"

    def table(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}_{self.period.label}.parquet"

    def report(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}_{self.period.label}.json"

    def model(self, name: str) -> str:
        return f"{self.base}/ml/{name}_{self.period.label}"


def stage(work: Callable[[Chain], None]) -> Callable[[Chain], None]:
    """A step of the chain that notes what it read and published when it is through."""

    @wraps(work)
    def run(chain: Chain) -> None:
        chain.read_paths, chain.made_paths, chain.measured = {}, {}, {}
        work(chain)
        chain.note_finished(work.__name__)

    return run


class Chain:
    """Runs the stages over one layout; every stage can also run alone."""

    def __init__(self, spark: SparkSession, base: str, settings: Settings = Settings()):
        self.spark = spark
        self.settings = settings
        self.period = Period.of(settings.months)
        self.layout = Layout(base.rstrip("/"), self.period, settings.fleet)
        self.read_paths: dict[str, str | None] = {}
        self.made_paths: dict[str, str | None] = {}
        #: What the writing jobs of the running stage measured, by table.
        self.measured: dict[str, dict[str, Any]] = {}

    # --- published tables -----------------------------------------------------

    def read(self, layer: str, name: str) -> DataFrame:
        """The current version of a published table."""
        return readers.read_table(self.spark, self._input(self.layout.table(layer, name)), name)

    def _input(self, path: str) -> str:
        self.read_paths[path] = versions.stamp(self.spark, path)
        return path

    def _version(self, path: str, write: Callable[[str], Any]) -> str:
        """Publish a version of a path; returns where it lies."""
        versions.publish(self.spark, path, write)
        self.made_paths[path] = versions.current(self.spark, path)
        return versions.resolve(self.spark, path)

    def _publish(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        *sort: Column | str,
        partition_by: tuple[str, ...] = (),
        sort_within: tuple[str, ...] = (),
        **measures: Column,
    ) -> DataFrame:
        """Write a table and measure its rows in the same job."""
        seen = writers.Measured(**measures)

        def write(path: str) -> None:
            if sort:
                writers.write_ordered(df, path, *sort, measured=seen)
            else:
                writers.write_table(df, path, partition_by, sort_within, seen)

        place = self._version(self.layout.table(layer, name), write)
        self.measured[name] = seen.result
        return self.spark.read.parquet(place)

    def _counts(self, *names: str) -> dict[str, int]:
        """Rows of tables this stage wrote; all of them, or those named."""
        return {name: self.measured[name]["rows"] for name in names or self.measured}

    def _count_rows(self, counts: dict[str, int]) -> DataFrame:
        return local_rows(self.spark, {"table_name": "STRING", "row_count": "BIGINT"}, counts.items())

    def _report(self, layer: str, name: str, **sections) -> None:
        sections = {"months": list(self.settings.months), **sections}
        report = writers.run_report(self.spark, **sections)
        self._version(self.layout.report(layer, name), lambda path: writers.write_report(report, path))

    # --- finished stages ------------------------------------------------------

    def _note(self, name: str) -> str:
        return f"{self.layout.base}/_stages/{self.period.label}/{name}.json"

    @property
    def _settings_print(self) -> str:
        return hashlib.sha256(repr(self.settings).encode()).hexdigest()

    def note_finished(self, name: str) -> None:
        note = {"settings": self._settings_print, "inputs": self.read_paths, "outputs": self.made_paths}
        versions.write_text(self.spark, self._note(name), json.dumps(note))

    def finished(self, name: str) -> bool:
        """Did the stage end with these settings, and are its inputs still what it read
        and its outputs what it published?"""
        text = versions.read_text(self.spark, self._note(name))
        if text is None:
            return False
        note = json.loads(text)
        same = all(versions.stamp(self.spark, p) == s for p, s in note["inputs"].items())
        there = all(versions.current(self.spark, p) == v for p, v in note["outputs"].items())
        return note["settings"] == self._settings_print and same and there

    @cached_property
    def _zones(self) -> DataFrame:
        return readers.read_zone_lookup(self.spark, self.layout.zone_lookup)

    @property
    def zones(self) -> DataFrame:
        self._input(self.layout.zone_lookup)
        return self._zones

    def check_inputs(self) -> None:
        """Every month's trips and the zone lookup are present and not empty."""
        readers.scan_trips(self.spark, self.layout.trips)
        readers.read_zone_lookup(self.spark, self.layout.zone_lookup)

    @stage
    def publish_weather(self) -> None:
        decoded = readers.read_weather_payload(self.spark, self._input(self.layout.weather_payload))
        table = self._publish(decoded, "external", "weather_hourly", "weather_datetime")
        quality.check_weather(table)
        self._report(
            "external",
            "weather_report",
            start_date=self.period.start.isoformat(),
            end_date=self.period.last_day.isoformat(),
            output_file=self.layout.table("external", "weather_hourly"),
            columns=table.columns,
            coverage=hourly_weather.weather_coverage(table),
        )

    @stage
    def clean(self) -> None:
        """Clean trips; the raw files are read once, for the rows and all counts."""
        limits = self.settings.limits
        paths = [self._input(path) for path in self.layout.trips]
        raw, seen = readers.scan_trips(self.spark, paths), Observation()
        rejected = cleaning.rejection_measures(self.period, limits)
        watched = raw.observe(seen, F.count(F.lit(1)).alias("raw_rows"), *[c.alias(name) for name, c in rejected.items()])
        self._publish(
            cleaning.clean_trips(watched, self.period, limits),
            "processed",
            "clean_trips",
            partition_by=("pickup_date",),
            sort_within=("PULocationID", "tpep_pickup_datetime"),
            **quality.invalid_measures(),
            **cleaning.summary_measures(self.period),
        )
        found, counts = self.measured["clean_trips"], seen.get
        # Below a shuffle a task that runs again is counted again: the number of raw
        # rows, which the file footers know, tells whether that happened.
        if counts.get("raw_rows") != raw.count():
            counts = cleaning.rejections(raw, self.period, limits).first().asDict()
        quality.check_clean_counts({"total_rows": found["rows"]} | {name: found[name] for name in quality.invalid_measures()})
        self._report(
            "processed",
            "cleaning_report",
            fleet=self.settings.fleet,
            period_start=self.period.start.isoformat(),
            period_end_exclusive=self.period.end.isoformat(),
            output_file=self.layout.table("processed", "clean_trips"),
            limits=[f"{k}: {v}" for k, v in asdict(limits).items()],
            rows=cleaning.counted_report(self.spark, counts, found["rows"]),
            summary=cleaning.counted_summary(self.spark, found),
        )

    @stage
    def curate(self) -> None:
        zone_range = self.settings.limits.zones
        path = versions.resolve(self.spark, self._input(self.layout.table("processed", "clean_trips")))
        numbered = curation.numbered(self.spark, path)
        facts = curation.fact_trips(numbered, self.zones, zone_range, carry=("trip_id",))

        def write_facts(target: str) -> None:
            # The clean table already has its layout: a file holds one date, and facts
            # keep the order of the files, in a folder a date.
            watched = seen.watch(facts)
            watched.write.partitionBy("pickup_date").parquet(target)

        seen = writers.Measured()
        self._version(self.layout.table("curated", "fact_trips"), write_facts)
        self.measured["fact_trips"] = seen.result

        # One pass over the trips; all totals start from its sums.
        trips = curation.canonical_trips(self.read("processed", "clean_trips"))
        state = self._publish(curation.trip_state(trips), "processed", "trip_state")
        self._publish(curation.dim_location(self.zones), "curated", "dim_location", "location_id")
        self._publish(
            curation.hourly_demand(state, self.zones, zone_range),
            "curated",
            "agg_hourly_demand",
            "pickup_date",
            "pickup_hour",
            F.desc("total_trips"),
        )
        zone_totals = self._publish(
            curation.zone_summary(state, self.zones, zone_range),
            "curated",
            "agg_zone_summary",
            F.desc("total_trips"),
        )
        self._publish(curation.daily_summary(state), "curated", "agg_daily_summary", "pickup_date")
        counts = self._counts("dim_location", "fact_trips", "agg_hourly_demand", "agg_zone_summary", "agg_daily_summary")
        quality.check_row_counts(counts)
        self._report(
            "curated",
            "curated_report",
            outputs={name: self.layout.table("curated", name) for name in counts},
            row_counts=self._count_rows(counts),
            top_pickup_zones=explore.top_pickup_zones(zone_totals),
        )

    @stage
    def join_weather(self) -> None:
        hourly = self.read("curated", "agg_hourly_demand")
        weather = self.read("external", "weather_hourly")
        joined = self._publish(
            hourly_weather.join_weather(hourly, weather, self.period),
            "curated",
            "agg_hourly_demand_weather",
            "pickup_date",
            "pickup_hour",
            F.desc("total_trips"),
            without=F.count_if(F.col("temperature_2m").isNull()),
        )
        found = self.measured["agg_hourly_demand_weather"]
        quality.check_join_counts(found["rows"], found["without"])
        self._report(
            "curated",
            "weather_join_report",
            # The inputs were written by other stages; their footers know the rows.
            row_counts=quality.table_counts({"hourly_demand": hourly, "weather": weather}).unionByName(
                self._count_rows({"joined": found["rows"]})
            ),
            coverage=hourly_weather.weather_coverage(joined),
            weather_effect_summary=hourly_weather.precipitation_effect(joined),
        )

    @stage
    def build_marts(self) -> None:
        settings = self.settings
        enriched = hourly_weather.enrich(
            self.read("curated", "agg_hourly_demand_weather"), settings.conditions
        )
        flows = marts.od_flow(
            curation.canonical_trips(self.read("processed", "clean_trips")),
            self.read("external", "weather_hourly"),
            self.zones,
            self.period,
            settings.min_route_trips,
            settings.limits.zones,
            settings.conditions,
        )
        lift = F.desc_nulls_last("demand_lift_pct")
        tables = {
            "daily_zone_metrics": self._publish(
                marts.daily_zone_metrics(enriched),
                "curated",
                "daily_zone_metrics",
                "pickup_date",
                F.asc_nulls_last("pickup_borough"),
                F.asc_nulls_last("pickup_zone"),
                "weather_condition",
            ),
            "hourly_demand_summary_weather": self._publish(
                marts.hourly_summary(enriched),
                "curated",
                "hourly_demand_summary_weather",
                "pickup_hour",
                F.asc_nulls_last("pickup_borough"),
                "weather_condition",
            ),
            "weather_impact_summary": self._publish(
                marts.in_condition_order(marts.weather_impact(enriched)),
                "curated",
                "weather_impact_summary",
            ),
            "zone_weather_elasticity": self._publish(
                marts.zone_elasticity(enriched, settings.sensitivity),
                "curated",
                "zone_weather_elasticity",
                lift,
                F.desc_nulls_last("duration_delta_minutes"),
            ),
            "od_flow_weather": self._publish(
                flows, "curated", "od_flow_weather", F.desc("trip_count")
            ),
        }
        counts = self._counts(*tables)
        quality.check_row_counts(counts)
        self._report(
            "curated",
            "analysis_mart_report",
            outputs={name: self.layout.table("curated", name) for name in tables},
            row_counts=self._count_rows(counts),
            weather_impact_summary=marts.by_lift(tables["weather_impact_summary"]),
            top_weather_sensitive_zones=explore.top_sensitive_zones(
                tables["zone_weather_elasticity"]
            ),
        )

    @stage
    def train_demand(self) -> None:
        rows = demand_model.training_rows(
            self.read("curated", "agg_hourly_demand_weather"), self.settings.conditions
        )
        # The encoder, the fit, both predictions and the reports read the rows again.
        rows = self._publish(rows, "ml", "demand_training_rows")
        train, test = demand_model.time_split(rows, self.settings.split_date)
        demand_model.require_both(train, test)
        model = demand_model.fit_forest(train, self.settings.forest)
        self._version(self.layout.model("demand_prediction_model"), lambda path: writers.write_model(model, path))
        scored = demand_model.predict(model, test)
        results = self._publish(
            demand_model.published(scored), "ml", "demand_prediction_results"
        )
        importance = self._publish(
            demand_model.feature_importance(self.spark, model), "ml", "demand_feature_importance"
        )
        quality.check_predictions(results, importance)
        span = [F.min("pickup_date").alias("min_date"), F.max("pickup_date").alias("max_date")]
        self._report(
            "ml",
            "demand_model_metrics",
            model="RandomForestRegressor",
            target=demand_model.TARGET,
            features=list(demand_model.FEATURES),
            train_period=train.agg(F.count(F.lit(1)).alias("train_rows"), *span),
            test_period=test.agg(F.count(F.lit(1)).alias("test_rows"), *span),
            metrics=demand_model.error_metrics(scored),
            baseline_metrics=demand_model.mean_baseline(train, test),
        )

    @stage
    def train_zones(self) -> None:
        settings = self.settings
        elasticity = self.read("curated", "zone_weather_elasticity")
        zones = zone_model.zone_features(elasticity, settings.min_zone_trips)
        zones = self._publish(zones, "ml", "zone_features")
        quality.not_empty(zones, "zone features")
        ready = zone_model.model_input(zones, settings.clusters)
        model = zone_model.fit_clusters(ready, settings.clusters)
        self._version(self.layout.model("zone_clustering_model"), lambda path: writers.write_model(model, path))
        chosen = zone_model.assign_clusters(model, zones, ready)
        clusters = self._publish(
            zone_model.ordered_clusters(
                zone_model.with_profile(chosen, limits=settings.profiles)
            ),
            "ml",
            "zone_weather_clusters",
        )
        quality.check_clusters(clusters)
        summary = zone_model.group_summary(clusters, limits=settings.profiles)
        self._report(
            "ml",
            "zone_cluster_summary",
            model="KMeans",
            random_state=settings.clusters.seed,
            n_init=settings.clusters.starts,
            n_clusters=model.getK(),
            features=list(zone_model.FEATURES),
            samples=self._count_rows(self._counts("zone_weather_clusters")),
            silhouette=zone_model.silhouette(ready, clusters.select("zone_id", "cluster_id")),
            cluster_summary=zone_model.rounded_summary(summary),
            top_zones_by_cluster=zone_model.top_zones_by_cluster(clusters),
        )

    def run_all(self, resume: bool = False) -> list[str]:
        """All stages in order; with ``resume`` those that are finished are skipped.

        Returns the names of the stages that ran.
        """
        self.check_inputs()
        ran = []
        for name in STAGES:
            if not (resume and self.finished(name)):
                getattr(self, name)()
                ran.append(name)
        return ran


#: The stages in the order of their inputs.
STAGES = ("publish_weather", "clean", "curate", "join_weather", "build_marts", "train_demand", "train_zones")
