"""Every operator as a named query over a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareweather.config import HEAVY_RAIN, LIGHT_RAIN, MODERATE_RAIN
from fareweather.functions.labels import classify_condition, condition_rank
from fareweather.functions.local import local_rows
from fareweather.functions.numeric import round_half
from fareweather.functions.timing import calendar_columns
from fareweather.operators import (
    cleaning,
    cube,
    curation,
    demand_model,
    explore,
    hourly_weather,
    marts,
    quality,
    zone_model,
)
from fareweather.plans.standin import Tables
from fareweather.sources import readers, schemas, writers

Query = Callable[[Tables], DataFrame]

_BOROUGH = "ASIA"
_WET = (LIGHT_RAIN, MODERATE_RAIN, HEAVY_RAIN)
_HOUR_KEY = ("pickup_date", "pickup_hour", "pickup_location_id")


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Values that depend on the order of double additions, cut to be comparable."""
    return df.withColumns({c: round_half(F.col(c), digits) for c in columns})


# --- sources and scalar columns ----------------------------------------------


def trip_duration(t: Tables) -> DataFrame:
    minutes = cleaning.trip_minutes().alias("trip_duration_minutes")
    return t.raw.select("tpep_pickup_datetime", "tpep_dropoff_datetime", minutes)


def trip_calendar(t: Tables) -> DataFrame:
    stamp = "tpep_pickup_datetime"
    return t.raw.select(stamp).withColumns(calendar_columns(F.col(stamp)))


def trip_ratios(t: Tables) -> DataFrame:
    minutes = cleaning.trip_minutes().alias("trip_duration_minutes")
    raw = t.raw.select("fare_amount", "tip_amount", "trip_distance", minutes)
    return cleaning.with_ratios(raw)


def conditions(t: Tables) -> DataFrame:
    label = classify_condition(
        F.col("snowfall"), F.col("rain"), F.col("precipitation"), t.settings.conditions
    )
    return t.weather.select(
        "weather_datetime", "snowfall", "rain", "precipitation", label.alias("weather_condition")
    ).withColumn("condition_rank", condition_rank(F.col("weather_condition")).cast("bigint"))


def weather_decode(t: Tables) -> DataFrame:
    payloads = t.weather_payloads.select(
        F.from_json("payload", schemas.WEATHER_PAYLOAD).alias("payload")
    )
    return readers.decode_hourly(payloads.select("payload.*"))


def zone_shape_keys(t: Tables) -> DataFrame:
    shapes = t.shape_documents.select(F.from_json("document", schemas.ZONE_SHAPES).alias("shape"))
    keys = readers.zone_shape_keys(shapes.select("shape.*"))
    return keys.select(F.col("properties")["name"].cast("string").alias("name"), "map_id")


def trip_id(t: Tables) -> DataFrame:
    """Proof that the numbers of the published trips are 1..n."""
    number = F.col("trip_id")
    return curation.numbered(t.spark, t.published_clean).agg(
        F.count(number).alias("trips"),
        F.min(number).alias("first_id"),
        F.max(number).alias("last_id"),
        F.sum(number.cast("decimal(20,0)")).cast("double").alias("id_sum"),
    )


def run_report(t: Tables) -> DataFrame:
    clean = t.spark.read.parquet(t.published_clean)
    return writers.run_report(
        t.spark,
        months=list(t.settings.months),
        period_start=t.period.start.isoformat(),
        period_end_exclusive=t.period.end.isoformat(),
        rows=cleaning.cleaning_report(t.raw, clean, t.period, t.settings.limits),
        summary=cleaning.cleaning_summary(clean),
    )


# --- marts and exploration ---------------------------------------------------


def filtered(t: Tables) -> DataFrame:
    return explore.explore(hourly_weather.enrich(t.published_hours), _BOROUGH, _WET, explore.WEEKDAYS)


def _averages(df: DataFrame) -> DataFrame:
    return df.agg(
        *[
            explore.weighted_average(df, source, "total_trips").alias(f"avg_{name}")
            for name, source in explore.KPI_MEASURES.items()
        ]
    )


def lineitem_median(t: Tables) -> DataFrame:
    return explore.weighted_median(t.given("lineitem"), "l_extendedprice", "l_quantity")


def lineitem_average(t: Tables) -> DataFrame:
    items = t.given("lineitem")
    price = explore.weighted_average(items, "l_extendedprice", "l_quantity")
    return _rounded(items.agg(price.alias("weighted_average")), "weighted_average", digits=4)


def zone_map(t: Tables) -> DataFrame:
    zones = explore.regroup_zones(t.published_hours, t.zone_totals)
    placed = explore.map_values(
        zones, "pickup_location_id", "total_trips", by_borough=True, total=True, log=True,
        keep_missing=True,
    )
    return _rounded(
        placed.select("map_id", "pickup_borough", "display_value", "map_color_value"),
        "map_color_value",
    )


def impact_map(t: Tables) -> DataFrame:
    rows = t.elasticity.filter(F.col("weather_condition") == HEAVY_RAIN)
    placed = explore.map_values(rows, "zone_id", "demand_lift_pct", by_borough=True)
    return _rounded(
        placed.select("map_id", "pickup_borough", "demand_lift_pct", "display_value", "map_color_value"),
        "display_value",
        "map_color_value",
    )


def time_split(t: Tables) -> DataFrame:
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("split"),
            F.count(F.lit(1)).alias("split_rows"),
            F.min("pickup_date").alias("min_date"),
            F.max("pickup_date").alias("max_date"),
        )

    train, test = t.split
    return side(train, "train").unionByName(side(test, "test"))


def ordinal_encode(t: Tables) -> DataFrame:
    train, test = t.split
    codes = demand_model.fit_codes(train)
    ordinals = [f"{c}_ordinal" for c in demand_model.CATEGORIES]
    return demand_model.encode(codes, test).select(*_HOUR_KEY, *ordinals)


def mean_mape(t: Tables) -> DataFrame:
    value = demand_model.mape(F.col("total_trips"), F.col("exact_prediction"))
    return _rounded(t.mean_predictions.agg(value.alias("mape_percent")), "mape_percent")


def table_counts(t: Tables) -> DataFrame:
    """Rows of the published tables, as the jobs that wrote them have counted."""
    return local_rows(t.spark, {"table_name": "STRING", "row_count": "BIGINT"}, t.published_counts.items())


def report_file_rows(t: Tables) -> DataFrame:
    """A section of a report that was written as a file and is read back."""
    return readers.report_rows(readers.read_report(t.spark, t.report_file), "rows")


def prediction_aliases(t: Tables) -> DataFrame:
    """Predictions of another writer, whose columns have other names."""
    names = {"total_trips": "y_actual", "predicted_total_trips": "y_pred", "absolute_error": "abs_error"}
    other = t.mean_predictions.withColumnsRenamed(names)
    return explore.daily_predictions(explore.named_predictions(other))


def cluster_top_zones(t: Tables) -> DataFrame:
    return zone_model.top_zones_by_cluster(t.clusters)


def borough_top_zones(t: Tables) -> DataFrame:
    return zone_model.top_zones_by_cluster(t.borough_groups, 3, "pickup_borough")


def borough_profiles(t: Tables) -> DataFrame:
    zones = zone_model.numeric_features(t.published_features)
    summary = zone_model.group_summary(zones, "pickup_borough", t.settings.profiles)
    return zone_model.rounded_summary(summary)


def clipped(t: Tables) -> DataFrame:
    zones = zone_model.clip_features(
        zone_model.numeric_features(t.published_features), *t.settings.clusters.clip
    )
    return _rounded(zones.select("zone_id", *zone_model.FEATURES), *zone_model.FEATURES)


def standardized(t: Tables) -> DataFrame:
    zones = zone_model.standardize_features(zone_model.numeric_features(t.published_features))
    return _rounded(zones.select("zone_id", *zone_model.FEATURES), *zone_model.FEATURES)


def borough_silhouette(t: Tables) -> DataFrame:
    """The exact silhouette of the boroughs as clusters, over two features as they are."""
    zones = zone_model.numeric_features(t.published_features)
    named = {f: F.col(f) if f in BOROUGH_FEATURES else F.lit(0.0) for f in zone_model.FEATURES}
    chosen = zones.select("zone_id", F.col("pickup_borough").alias("cluster_id"))
    return _rounded(zone_model.silhouette(zones.withColumns(named), chosen), "silhouette_score")


def run_report_rows(t: Tables) -> DataFrame:
    """The accounting section of the run report, read back as rows."""
    return run_report(t).select("period_start", F.inline("rows"))


def forest_checks(t: Tables) -> DataFrame:
    """What holds for any fitted forest: counts of rows and of broken rules."""
    error = F.col("total_trips") - F.col("predicted_total_trips")
    importance = explore.top_features(demand_model.feature_importance(t.spark, t.forest), n=100)
    shares = importance.agg(F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("importance_sum"))
    rows = demand_model.published(t.predictions).agg(
        F.count("*").alias("prediction_rows"),
        F.count_if(F.col("predicted_total_trips") < 0).alias("negative"),
        F.count_if(F.abs(error - F.col("prediction_error")) > 1e-9).alias("wrong_errors"),
    )
    return rows.withColumns({name: shares.select(name).scalar() for name in shares.columns})


#: Features that the silhouette of the boroughs looks at.
BOROUGH_FEATURES = ("avg_demand_lift_pct", "avg_duration_delta_minutes")

QUERIES: dict[str, Query] = {
    # sources
    "scan_trips": lambda t: readers.scan_trips(t.spark, t.trip_files),
    "dim_location": lambda t: curation.dim_location(readers.read_zone_lookup(t.spark, t.zone_file)),
    "weather_decode": weather_decode,
    "zone_shape_keys": zone_shape_keys,
    "run_report": run_report,
    # cleaning
    "trip_duration": trip_duration,
    "trip_calendar": trip_calendar,
    "trip_ratios": trip_ratios,
    "clean_trips": lambda t: t.clean,
    "cleaning_report": lambda t: cleaning.cleaning_report(
        t.raw, t.clean, t.period, t.settings.limits
    ),
    "cleaning_summary": lambda t: cleaning.cleaning_summary(t.clean),
    "quality_clean": lambda t: quality.invalid_counts(t.clean),
    "audit_clean": lambda t: quality.audit_clean(t.clean),
    # star schema
    "fact_trips": lambda t: t.facts,
    "trip_id": trip_id,
    "agg_hourly_demand": lambda t: t.hourly,
    "agg_zone_summary": lambda t: t.zone_totals,
    "agg_daily_summary": lambda t: t.daily,
    "audit_daily": lambda t: quality.audit_daily(t.daily),
    "top_zones": lambda t: explore.top_pickup_zones(t.zone_totals),
    "table_counts": table_counts,
    # weather
    "classify_condition": conditions,
    "hourly_weather_join": lambda t: t.hourly_weather,
    "hourly_enriched": lambda t: t.enriched.select(
        *_HOUR_KEY, "weather_condition", "avg_minutes_per_mile"
    ),
    "weather_coverage": lambda t: hourly_weather.weather_coverage(t.hourly_weather),
    "precipitation_effect": lambda t: hourly_weather.precipitation_effect(t.hourly_weather),
    # marts
    "daily_zone_metrics": lambda t: t.daily_metrics,
    "hourly_summary_weather": lambda t: t.hourly_metrics,
    "weather_impact": lambda t: marts.in_condition_order(t.impact),
    "zone_elasticity": lambda t: t.elasticity,
    "od_flow": lambda t: t.flows,
    "top_sensitive_zones": lambda t: explore.top_sensitive_zones(t.elasticity),
    # exploration
    "filtered_hourly": filtered,
    "filter_options": lambda t: explore.filter_options(t.elasticity),
    "overview_kpis": lambda t: explore.overview_kpis(t.published_hours),
    "weighted_average": lambda t: _averages(t.published_hours),
    "weighted_median": lambda t: explore.weighted_median(
        t.published_hours, "avg_total_amount", "total_trips"
    ),
    "weighted_average_lineitem": lineitem_average,
    "weighted_median_lineitem": lineitem_median,
    "rainy_day_share": lambda t: explore.rainy_day_share(t.published_hours),
    "daily_trend": lambda t: explore.daily_trend(t.published_hours),
    "hourly_pattern": lambda t: explore.hourly_pattern(t.published_hours),
    "hourly_pattern_by_daytype": lambda t: explore.hourly_pattern_by_day_type(t.published_hours),
    "regroup_zones": lambda t: explore.zones_or_fallback(filtered(t), t.zone_totals),
    "regroup_zones_fallback": lambda t: explore.zones_or_fallback(
        explore.with_value(t.published_hours, "pickup_borough", "NOWHERE"), t.zone_totals
    ),
    "cube_overview": lambda t: cube.overview_kpis(t.published_cube),
    "cube_regroup": lambda t: cube.regroup_zones(
        t.published_cube.filtered(_BOROUGH, _WET, explore.WEEKDAYS)
    ),
    "map_values": zone_map,
    "map_impact": impact_map,
    "map_domain": lambda t: explore.map_domain(zone_map(t)),
    "best_conditions": lambda t: explore.best_conditions(t.impact),
    "top_lift_zones": lambda t: explore.top_elastic_zones(t.elasticity, "demand_lift_pct"),
    "top_fare_zones": lambda t: explore.top_elastic_zones(t.elasticity, "fare_delta_amount"),
    "top_duration_zones": lambda t: explore.top_elastic_zones(
        t.elasticity, "duration_delta_minutes"
    ),
    "top_routes": lambda t: explore.top_routes(t.flows),
    # demand model
    "train_rows": lambda t: t.training,
    "time_split": time_split,
    "ordinal_encode": ordinal_encode,
    "mean_baseline": lambda t: _rounded(
        demand_model.mean_baseline(*t.split), "baseline_mean_mae", "baseline_mean_rmse"
    ),
    "mape": mean_mape,
    "daily_prediction_long": lambda t: explore.daily_predictions(t.mean_predictions),
    "error_histogram": lambda t: explore.error_histogram(t.mean_predictions),
    "prediction_sample": lambda t: explore.prediction_sample(t.mean_predictions),
    "demand_predictions": lambda t: demand_model.published(t.predictions),
    "demand_metrics": lambda t: demand_model.error_metrics(t.predictions),
    "feature_importance": lambda t: explore.top_features(
        demand_model.feature_importance(t.spark, t.forest)
    ),
    # zone model
    "zone_features": lambda t: t.zone_features,
    "clip_features": clipped,
    "standardize_features": standardized,
    "cluster_profile": borough_profiles,
    "candidate_zones": lambda t: explore.candidate_zones(t.borough_groups),
    "group_top_zones": borough_top_zones,
    "zone_clusters": lambda t: zone_model.ordered_clusters(t.clusters),
    "cluster_summary": lambda t: zone_model.rounded_summary(
        zone_model.group_summary(t.clusters, limits=t.settings.profiles)
    ),
    "cluster_distribution": lambda t: explore.cluster_distribution(t.clusters),
    "cluster_top_zones": cluster_top_zones,
    "borough_silhouette": borough_silhouette,
    "group_distribution": lambda t: explore.cluster_distribution(t.borough_groups),
    "mean_prediction_metrics": lambda t: _rounded(
        demand_model.error_metrics(t.mean_predictions), "mae", "rmse", "r2", "mape_percent"
    ),
    "run_report_rows": run_report_rows,
    "report_file_rows": report_file_rows,
    "prediction_aliases": prediction_aliases,
    "forest_checks": forest_checks,
    "silhouette": lambda t: zone_model.silhouette(
        t.model_input, t.clusters.select("zone_id", "cluster_id")
    ),
}

_known: dict[tuple, Tables] = {}


def _stamp(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the folder's files, so that new data is seen."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while files.hasNext():
        file = files.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


def tables(spark: SparkSession, folder: str) -> Tables:
    """One chain of tables per session and state of a folder."""
    key = (spark.sparkContext.applicationId, folder, _stamp(spark, folder))
    if key not in _known:
        _known[key] = Tables(spark, folder)
    return _known[key]
