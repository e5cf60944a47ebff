"""Zone-hours as a cube of exact states, so that a filter adds states up.

The interactive questions filter zone-hours by borough, condition and day type and then
ask for totals, means and medians. Three small tables, each keyed by these three, hold
what all of them need: by zone the sums behind totals and weighted means, by date the
sums behind daily figures, and by value the weight behind medians. The states are
integers, so the answer for any filter is equal to the bit to the one from the
zone-hours themselves, which are read once, when the cube is made.

The tables grow with zones, dates and distinct values (averages are kept to the cent),
not with hours or trips.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from fareweather.functions.numeric import state_avg, state_sum, sum_state, weighted_state, weighted_state_mean
from fareweather.operators import explore, order_statistics

CELL = ("pickup_borough", "weather_condition", "is_weekend")
_ZONE = explore.ZONE


@dataclass(frozen=True)
class Cube:
    """``zones``, ``days`` and ``values`` by cell; any subset of cells is a cube."""

    zones: DataFrame
    days: DataFrame
    values: DataFrame

    def each(self, work: Callable[[str, DataFrame], DataFrame]) -> Cube:
        """Another cube of the same tables, as written and read again, for example."""
        return Cube(*[work(name, getattr(self, name)) for name in ("zones", "days", "values")])

    def filtered(self, borough: str = explore.ALL, conditions: Iterable[str] = (), days: str = "") -> Cube:
        """The cells that the filters of :func:`explore.explore` keep."""
        conditions = list(conditions)
        return self.each(lambda _, df: explore.explore(df, borough, conditions, days))


def build(hourly: DataFrame) -> Cube:
    """The cube of zone-hours with their condition."""
    trips = F.coalesce(F.col("total_trips").cast("bigint"), F.lit(0))
    hourly = hourly.withColumn("total_trips", trips)
    metrics = [name for name in explore.ZONE_METRICS if name in hourly.columns]
    states = [state for name in metrics for state in weighted_state(name, "total_trips")]
    zones = hourly.groupBy(*dict.fromkeys([*_ZONE, *CELL])).agg(
        F.count(F.lit(1)).alias("hours"), F.sum("total_trips").alias("total_trips"), *sum_state("total_revenue"), *states
    )
    days = hourly.groupBy("pickup_date", *CELL).agg(
        F.sum("total_trips").alias("total_trips"), *sum_state("total_revenue"), *sum_state("rain")
    )
    named = ", ".join(f"struct('{name}' AS measure, CAST({column} AS DOUBLE) AS value)" for name, column in explore.KPI_MEASURES.items())
    values = (
        hourly.where("total_trips > 0")
        .selectExpr(*CELL, "total_trips", f"inline(array({named}))")
        .where("value IS NOT NULL")
        .groupBy(*CELL, "measure", "value")
        .agg(F.sum("total_trips").alias("total_trips"))
    )
    return Cube(zones, days, values)


def regroup_zones(cube: Cube) -> DataFrame:
    """As :func:`explore.regroup_zones` of the cube's zone-hours."""
    names = [name for name in explore.ZONE_METRICS if f"{name}_by_count" in cube.zones.columns]
    return cube.zones.dropna(subset=list(_ZONE)).groupBy(*_ZONE).agg(
        F.sum("total_trips").alias("total_trips"),
        F.coalesce(state_sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
        *[weighted_state_mean(name).alias(name) for name in names],
    )


def overview_kpis(cube: Cube) -> DataFrame:
    """As :func:`explore.overview_kpis` of the cube's zone-hours."""
    trips = F.coalesce(F.sum("total_trips"), F.lit(0))
    days = F.countDistinct("pickup_date")
    totals = cube.days.agg(
        trips.alias("total_trips"),
        days.alias("pickup_days"),
        F.coalesce(F.try_divide(trips.cast("double"), days), F.lit(0.0)).alias("avg_trips_per_day"),
        F.coalesce(state_sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
    )
    names = explore.KPI_MEASURES
    means = cube.zones.agg(*[F.coalesce(weighted_state_mean(c), F.lit(0.0)).alias(f"avg_{name}") for name, c in names.items()])
    daily = cube.days.where("pickup_date IS NOT NULL").groupBy("pickup_date").agg(state_avg("rain").alias("rain"))
    columns = [f"IF(measure = '{name}', value, NULL) AS {name}" for name in names]
    medians = order_statistics.weighted_medians(
        cube.values.selectExpr("total_trips", *columns), {name: name for name in names}, "total_trips"
    )
    return totals.withColumns(
        {f"avg_{name}": means.select(f"avg_{name}").scalar() for name in names}
        | {"rainy_day_share": explore.share_of_rainy_days(daily).scalar()}
        | {f"median_{name}": F.lit(medians.get(name, 0.0)) for name in names}
    )
