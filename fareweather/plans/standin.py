"""The driver's tables seen as trips, zone lookup and hourly weather.

Each event becomes a trip, each nation a zone and each hour with an event an hour
of weather. Everything is derived by Spark from whole tables, in one scan each,
so all queries built on it grow with the data.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareweather.config import CleaningLimits, Settings
from fareweather.operators import (
    cleaning,
    cube,
    curation,
    demand_model,
    hourly_weather,
    marts,
    zone_model,
)
from fareweather.session import shared_folder
from fareweather.sources import readers, schemas, writers
from fareweather.sources.periods import Period

#: Parameters that suit the derived tables: one month, 26 zones, small groups.
SETTINGS = Settings(
    months=("2024-01",),
    limits=CleaningLimits(zones=(1, 26)),
    min_route_trips=5,
    min_zone_trips=20,
    split_date="2024-01-21",
)


def trips_from_events(events: DataFrame) -> DataFrame:
    """Trips with every kind of flaw the cleaning has to find.

    Every 50th event comes twice, every 101st lies 40 days earlier and every
    211th has no time; the other flaws follow from the event's own values.
    """
    # props is a fixed '{"k": n}'. As output of the generator it is taken apart
    # once per event and not again in every filter that is pushed down.
    k = F.expr("""CAST(trim(BOTH '{"k: }' FROM props) AS BIGINT)""")
    copies = F.when(F.col("event_id") % 50 == 0, 2).otherwise(1)
    base = events.select(
        "event_id",
        "user_id",
        "value",
        F.expr(
            """CASE WHEN event_id % 211 = 0 THEN NULL
                    WHEN event_id % 101 = 0 THEN ts - INTERVAL '40' DAY
                    ELSE ts END"""
        ).alias("pu"),
        F.expr("CAST(floor(value * 60) AS BIGINT)").alias("secs"),
        F.explode(F.array_repeat(k, copies)).alias("k"),
    )
    return base.selectExpr(
        "event_id % 3 + 1 AS VendorID",
        "pu AS tpep_pickup_datetime",
        "pu + secs * INTERVAL '1' SECOND AS tpep_dropoff_datetime",
        "CASE WHEN k % 10 <> 9 THEN CAST(k % 9 AS DOUBLE) END AS passenger_count",
        "k / 7D AS trip_distance",
        "CAST(k % 6 + 1 AS DOUBLE) AS RatecodeID",
        "CASE WHEN k % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag",
        "user_id % 28 AS PULocationID",
        "event_id % 27 AS DOLocationID",
        "k % 5 AS payment_type",
        "value - 2D AS fare_amount",
        "CAST(k % 3 AS DOUBLE) AS extra",
        "0.5D AS mta_tax",
        "CAST(k % 21 - 1 AS DOUBLE) AS tip_amount",
        "CASE WHEN k % 7 = 0 THEN 6.5D ELSE 0D END AS tolls_amount",
        "1D AS improvement_surcharge",
        "value + CAST(k % 21 - 3 AS DOUBLE) AS total_amount",
        "2.5D AS congestion_surcharge",
        "0D AS Airport_fee",
    )


def zones_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """A zone of each nation; zone 26 is valid but missing from the lookup."""
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .selectExpr(
            "CAST(n_nationkey + 1 AS BIGINT) AS LocationID",
            "r_name AS Borough",
            "n_name AS Zone",
            """CASE n_nationkey % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone'
               ELSE 'Airports' END AS service_zone""",
        )
    )


def weather_from_events(events: DataFrame, gaps: bool = False) -> DataFrame:
    """Weather for every hour in which an event happened. With ``gaps``, for tests of
    hours without weather alone, every 89th hour of the month has none."""
    # date_trunc would answer with a zoned timestamp, so the hour is rebuilt
    # from the date.
    hour = F.timestamp_add("HOUR", F.hour("ts"), F.col("ts").cast("date").cast("timestamp_ntz"))
    hours = events.filter("ts IS NOT NULL").select(hour.alias("at")).distinct()
    numbered = hours.selectExpr(
        "at",
        "CAST(hour(at) AS BIGINT) AS h",
        "CAST(datediff(CAST(at AS DATE), DATE'2024-01-01') AS BIGINT) AS d",
    )
    if gaps:
        numbered = numbered.where("(d * 24 + h) % 89 <> 0")
    wet = numbered.selectExpr(
        "at",
        "d",
        "h",
        "d * 24 + h AS id",
        "CASE WHEN (d * 7 + h * 3) % 11 < 6 THEN 0D ELSE CAST((d * 5 + h) % 29 AS DOUBLE) END AS wet",
    )
    return wet.selectExpr(
        "at AS weather_datetime",
        "CAST(CAST(at AS DATE) AS STRING) AS pickup_date",
        "CAST(h AS INT) AS pickup_hour",
        "CAST((d * 3 + h * 5) % 31 - 6 AS DOUBLE) AS temperature_2m",
        "wet / 2D AS precipitation",
        "CASE WHEN id % 97 <> 0 THEN wet / 4D END AS rain",
        "CASE WHEN d % 10 = 0 AND h < 6 THEN 0.5D ELSE 0D END AS snowfall",
        "(d + h) % 4 AS weather_code",
        "CAST((d + h * 2) % 40 AS DOUBLE) / 2D AS wind_speed_10m",
    )


class Tables:
    """The chain of tables over one data folder, each built on first use.

    Tables up to the marts are plans over the given files. Interactive and model
    queries start from published tables, as they do in the full chain: those are
    written once to the shared folder on first use.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: Settings = SETTINGS, gaps: bool = False):
        self.spark = spark
        self.gaps = gaps
        self.folder = folder.rstrip("/")
        self.run = uuid.uuid4().hex
        self.settings = settings
        self.period = Period.of(settings.months)
        self.zone_range = settings.limits.zones

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw(self) -> DataFrame:
        return trips_from_events(self.given("events"))

    @cached_property
    def zones(self) -> DataFrame:
        return zones_from_nations(self.given("nation"), self.given("region"))

    @cached_property
    def weather(self) -> DataFrame:
        return weather_from_events(self.given("events"), self.gaps)

    @cached_property
    def clean(self) -> DataFrame:
        return cleaning.clean_trips(self.raw, self.period, self.settings.limits)

    @cached_property
    def trips(self) -> DataFrame:
        return curation.canonical_trips(self.clean)

    @cached_property
    def state(self) -> DataFrame:
        return curation.trip_state(self.trips)

    @cached_property
    def facts(self) -> DataFrame:
        return curation.fact_trips(self.clean, self.zones, self.zone_range)

    @cached_property
    def hourly(self) -> DataFrame:
        return curation.hourly_demand(self.state, self.zones, self.zone_range)

    @cached_property
    def zone_totals(self) -> DataFrame:
        return curation.zone_summary(self.state, self.zones, self.zone_range)

    @cached_property
    def daily(self) -> DataFrame:
        return curation.daily_summary(self.state)

    @cached_property
    def hourly_weather(self) -> DataFrame:
        return hourly_weather.join_weather(self.hourly, self.weather, self.period)

    @cached_property
    def enriched(self) -> DataFrame:
        return hourly_weather.enrich(self.hourly_weather, self.settings.conditions)

    @cached_property
    def impact(self) -> DataFrame:
        return marts.weather_impact(self.enriched)

    @cached_property
    def elasticity(self) -> DataFrame:
        return marts.zone_elasticity(self.enriched, self.settings.sensitivity)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return marts.daily_zone_metrics(self.enriched)

    @cached_property
    def hourly_metrics(self) -> DataFrame:
        return marts.hourly_summary(self.enriched)

    @cached_property
    def flows(self) -> DataFrame:
        return marts.od_flow(
            self.trips,
            self.weather,
            self.zones,
            self.period,
            self.settings.min_route_trips,
            self.zone_range,
            self.settings.conditions,
        )

    # --- sources in their outside format, derived from the given tables ------

    @cached_property
    def weather_payloads(self) -> DataFrame:
        """One JSON payload of parallel arrays per day."""
        stamp = F.concat(
            "pickup_date", F.lit("T"), F.lpad(F.col("pickup_hour").cast("string"), 2, "0"), F.lit(":00")
        )
        hours = F.array_sort(F.collect_list(F.struct(stamp.alias("time"), *schemas.WEATHER_MEASURES)))
        daily = self.weather.groupBy("pickup_date").agg(hours.alias("hours"))
        names = ["time", *schemas.WEATHER_MEASURES]
        arrays = F.struct(*[F.col(f"hours.{name}").alias(name) for name in names])
        return daily.select(F.to_json(F.struct(arrays.alias("hourly"))).alias("payload"))

    @cached_property
    def shape_documents(self) -> DataFrame:
        """GeoJSON documents of 100 customers each, keyed in various ways."""
        names = F.array(*[F.lit(n) for n in (*readers.ZONE_KEY_NAMES, "other")])
        key = F.col("c_custkey")
        text, kind = key.cast("string"), key % 10
        quoted = {0: "{}", 2: "A{}", 4: "", 5: "0", 7: "{}d", 8: "false", 9: " "}
        value = F.when(kind == 1, F.concat(text, F.lit(".0"))).when(kind == 3, F.concat(text, F.lit(".75")))
        value = value.when(kind == 6, "0.00")
        for k, form in quoted.items():
            value = value.when(kind == k, F.concat(F.lit('"'), F.replace(F.lit(form), F.lit("{}"), text), F.lit('"')))
        name = F.element_at(names, (key % 8 + 1).cast("int"))
        own = F.concat(F.lit('"name":"'), F.col("c_name"), F.lit('","'), name, F.lit('":'), value)
        spare = F.concat(F.lit(',"objectid":'), (key * 10).cast("string"))
        with_spare = kind.isin(4, 6) & (key % 8 != 6)
        properties = F.concat(own, F.when(with_spare, spare).otherwise(""))
        feature = F.concat(F.lit('{"properties":{'), properties, F.lit("}}"))
        document = F.concat(F.lit('{"features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}"))
        return (
            self.given("customer")
            .groupBy(F.floor(key / 100).alias("sheet"))
            .agg(document.alias("document"))
        )

    def _publish(self, name: str, df: DataFrame) -> str:
        """Write a table of the chain to the shared folder, below this object's own id."""
        return writers.write_table(df, self._path(name))

    def _path(self, name: str) -> str:
        app = self.spark.sparkContext.applicationId
        return f"{shared_folder(self.spark)}/{app}/{self.run}/{name}"

    @cached_property
    def trip_files(self) -> list[str]:
        """Raw trips as two monthly files; the second stores numbers in other types."""
        at = F.col("tpep_pickup_datetime")
        first = F.coalesce(at < F.lit("2024-01-16").cast("timestamp_ntz"), F.lit(True))
        kinds = {"VendorID": "int", "passenger_count": "bigint", "PULocationID": "int", "extra": "float"}
        second = self.raw.where(~first).withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})
        return [self._publish("trips_first", self.raw.where(first)), self._publish("trips_second", second)]

    @cached_property
    def zone_file(self) -> str:
        """The zone lookup as a CSV file with a header."""
        self.zones.write.mode("overwrite").option("header", True).csv(self._path("zones.csv"))
        return self._path("zones.csv")

    @cached_property
    def report_file(self) -> str:
        """The run report as the chain writes it: a JSON file."""
        clean = self.spark.read.parquet(self.published_clean)
        report = writers.run_report(
            self.spark,
            months=list(self.settings.months),
            rows=cleaning.cleaning_report(self.raw, clean, self.period, self.settings.limits),
        )
        return writers.write_report(report, self._path("report.json"))

    @cached_property
    def published_counts(self) -> dict[str, int]:
        """Rows of the tables of the chain, counted by the jobs that write them."""
        trips = curation.canonical_trips(self.spark.read.parquet(self.published_clean))
        facts = curation.fact_trips(self.spark.read.parquet(self.published_clean), self.zones, self.zone_range)
        enriched = hourly_weather.enrich(self.published_hours, self.settings.conditions)
        wanted = {
            "fact_trips": facts,
            "agg_hourly_demand": curation.hourly_demand(self.published_state, self.zones, self.zone_range),
            "agg_zone_summary": curation.zone_summary(self.published_state, self.zones, self.zone_range),
            "agg_daily_summary": curation.daily_summary(self.published_state),
            "agg_hourly_demand_weather": self.published_hours,
            "daily_zone_metrics": marts.daily_zone_metrics(enriched),
            "hourly_demand_summary_weather": marts.hourly_summary(enriched),
            "weather_impact_summary": marts.weather_impact(enriched),
            "zone_weather_elasticity": marts.zone_elasticity(enriched),
            "od_flow_weather": marts.od_flow(
                trips, self.weather, self.zones, self.period, self.settings.min_route_trips, self.zone_range
            ),
        }
        counts = {}
        for name, df in wanted.items():
            measured = writers.Measured()
            writers.write_table(df, self._path(f"counted/{name}"), measured=measured)
            counts[name] = measured.result["rows"]
        return counts

    @cached_property
    def published_clean(self) -> str:
        return self._publish("clean_trips", self.clean)

    @cached_property
    def published_state(self) -> DataFrame:
        """Sums of the published trips by hour and zone, as all totals read them."""
        trips = curation.canonical_trips(self.spark.read.parquet(self.published_clean))
        return self.spark.read.parquet(self._publish("trip_state", curation.trip_state(trips)))

    @cached_property
    def published_hours(self) -> DataFrame:
        """Zone-hours with weather as interactive queries read them."""
        return self.spark.read.parquet(self._publish("hourly_weather", self.hourly_weather))

    @cached_property
    def published_cube(self) -> cube.Cube:
        """The cube of zone-hours as interactive queries read it."""
        enriched = hourly_weather.enrich(self.published_hours, self.settings.conditions)
        write = lambda name, df: self.spark.read.parquet(self._publish(f"cube_{name}", df))
        return cube.build(enriched).each(write)

    @cached_property
    def published_training(self) -> DataFrame:
        """Training rows as the models read them: from a written table."""
        return self.spark.read.parquet(self._publish("training_rows", self.training))

    @cached_property
    def published_features(self) -> DataFrame:
        return self.spark.read.parquet(self._publish("zone_features", self.zone_features))

    # --- models ---------------------------------------------------------------

    @cached_property
    def training(self) -> DataFrame:
        return demand_model.training_rows(self.hourly_weather, self.settings.conditions)

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return demand_model.time_split(self.published_training, self.settings.split_date)

    @cached_property
    def mean_predictions(self) -> DataFrame:
        return demand_model.mean_predictions(*self.split)

    @cached_property
    def forest(self):
        """The fitted forest; fitted once and shared by its queries."""
        return demand_model.fit_forest(self.split[0], self.settings.forest)

    @cached_property
    def predictions(self) -> DataFrame:
        return demand_model.predict(self.forest, self.split[1])

    @cached_property
    def zone_features(self) -> DataFrame:
        return zone_model.zone_features(self.elasticity, self.settings.min_zone_trips)

    @cached_property
    def model_input(self) -> DataFrame:
        return zone_model.model_input(self.published_features, self.settings.clusters)

    @cached_property
    def cluster_model(self):
        """The fitted clusters; fitted once and shared by their queries."""
        return zone_model.fit_clusters(self.model_input, self.settings.clusters)

    @cached_property
    def clusters(self) -> DataFrame:
        chosen = zone_model.assign_clusters(
            self.cluster_model, self.published_features, self.model_input
        )
        return zone_model.with_profile(chosen, limits=self.settings.profiles)

    @cached_property
    def borough_groups(self) -> DataFrame:
        """Zones grouped and profiled by borough, as fixed clusters."""
        zones = zone_model.numeric_features(self.published_features)
        return zone_model.with_profile(zones, "pickup_borough", self.settings.profiles)
