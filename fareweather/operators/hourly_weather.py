"""Hourly demand beside the weather of the same hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fareweather.config import ConditionThresholds
from fareweather.functions.labels import classify_condition
from fareweather.functions.numeric import avg2, sum2
from fareweather.operators.lookups import bounded, unique_by
from fareweather.sources.periods import Period
from fareweather.sources.schemas import WEATHER_MEASURES

_KEY = ("pickup_date", "pickup_hour")


def weather_side(weather: DataFrame, period: Period | None) -> DataFrame:
    """The weather as a join side with one row per date and hour.

    With a period the side is cut to its hours, which proves its size.
    """
    side = weather.withColumns(
        {
            "pickup_date": F.col("pickup_date").cast("date"),
            "pickup_hour": F.col("pickup_hour").cast("bigint"),
        }
    ).filter(F.col("pickup_hour").between(0, 23))
    if period is None:
        return unique_by(side, *_KEY, label="hourly weather")
    day = F.col("pickup_date")
    side = side.filter((day >= F.lit(period.start)) & (day < F.lit(period.end)))
    return bounded(unique_by(side, *_KEY, label="hourly weather"), period.hours)


def join_weather(
    hourly: DataFrame, weather: DataFrame, period: Period | None = None
) -> DataFrame:
    """Left join on date and hour; hours without weather keep nulls."""
    wet = F.coalesce(F.col("precipitation"), F.lit(0.0)) > 0
    rainy = F.coalesce(F.col("rain"), F.lit(0.0)) > 0
    side = weather_side(weather, period).select(*_KEY, "weather_datetime", *WEATHER_MEASURES)
    joined = hourly.join(side, list(_KEY), "left")
    return joined.withColumns({"is_precipitation_hour": wet, "is_rain_hour": rainy})


def enrich(
    hourly_weather: DataFrame, limits: ConditionThresholds = ConditionThresholds()
) -> DataFrame:
    """Add the condition and the minutes per mile; missing weather is clear."""
    miles = F.col("avg_trip_distance")
    pace = F.when(miles > 0, F.col("avg_trip_duration_minutes") / miles)
    condition = classify_condition(
        F.col("snowfall"), F.col("rain"), F.col("precipitation"), limits
    )
    return hourly_weather.withColumns(
        {"weather_condition": condition, "avg_minutes_per_mile": pace}
    )


def classified_weather(
    weather: DataFrame,
    period: Period | None = None,
    limits: ConditionThresholds = ConditionThresholds(),
) -> DataFrame:
    """Date, hour and condition only, as a join side for trips."""
    condition = classify_condition(
        F.col("snowfall"), F.col("rain"), F.col("precipitation"), limits
    )
    slim = weather.select(*_KEY, condition.alias("weather_condition"))
    return weather_side(slim, period)


def weather_coverage(hourly_weather: DataFrame) -> DataFrame:
    return hourly_weather.agg(
        F.count(F.lit(1)).alias("joined_rows"),
        F.count_if(F.col("temperature_2m").isNull()).alias("missing_weather_rows"),
        F.min("weather_datetime").alias("min_weather_datetime"),
        F.max("weather_datetime").alias("max_weather_datetime"),
    )


def precipitation_effect(hourly_weather: DataFrame) -> DataFrame:
    """Dry against wet zone-hours; the averages are not weighted by trips."""
    return hourly_weather.groupBy("is_precipitation_hour").agg(
        F.count(F.lit(1)).alias("total_zone_hours"),
        F.sum("total_trips").alias("total_trips"),
        avg2("avg_trip_duration_minutes").alias("avg_trip_duration_minutes"),
        sum2("total_revenue").alias("total_revenue"),
        avg2("avg_tip_percentage").alias("avg_tip_percentage"),
    )
