"""SQL that an independent engine (DuckDB) runs on the same tables.

The texts are written for that engine on their own: joins with names come before
the grouping, baselines are self joins, medians are running sums over one global
order, and sums use decimals. They share no code with the Spark operators, only
column names and the parameters of the derived tables.
"""

from __future__ import annotations

import re


def _total(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(38,12))) AS DOUBLE)"


def _mean(x: str) -> str:
    return f"({_total(x)} / count({x}))"


def _weighted(x: str, weight: str = "total_trips") -> str:
    product = f"CAST(sum(CAST({x} AS DECIMAL(18,10)) * CAST({weight} AS DECIMAL(18,0))) AS DOUBLE)"
    return f"({product} / nullif(CAST(sum({weight}) AS DOUBLE), 0))"


def _plus(x: str) -> str:
    """Negative zero as zero."""
    return f"(CASE WHEN {x} = 0 THEN 0 ELSE {x} END)"


def _difference(x: str, base: str) -> str:
    return _plus(f"round({x} - {base}, 2)")


def _lift(x: str, base: str) -> str:
    return _plus(f"round(({x} - {base}) / nullif({base}, 0) * 100, 2)")


_CTES: dict[str, str] = {}

_CTES["trips_in"] = """
SELECT event_id % 3 + 1 AS VendorID,
  pu AS tpep_pickup_datetime,
  pu + secs * INTERVAL '1' SECOND AS tpep_dropoff_datetime,
  CASE WHEN k % 10 = 9 THEN NULL ELSE CAST(k % 9 AS DOUBLE) END AS passenger_count,
  CAST(k AS DOUBLE) / 7 AS trip_distance,
  CAST(k % 6 + 1 AS DOUBLE) AS RatecodeID,
  CASE WHEN k % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CAST(user_id % 28 AS BIGINT) AS PULocationID,
  CAST(event_id % 27 AS BIGINT) AS DOLocationID,
  CAST(k % 5 AS BIGINT) AS payment_type,
  value - CAST(2 AS DOUBLE) AS fare_amount,
  CAST(k % 3 AS DOUBLE) AS extra,
  CAST(0.5 AS DOUBLE) AS mta_tax,
  CAST(k % 21 - 1 AS DOUBLE) AS tip_amount,
  CAST(CASE WHEN k % 7 = 0 THEN 6.5 ELSE 0.0 END AS DOUBLE) AS tolls_amount,
  CAST(1.0 AS DOUBLE) AS improvement_surcharge,
  value + CAST(k % 21 - 3 AS DOUBLE) AS total_amount,
  CAST(2.5 AS DOUBLE) AS congestion_surcharge,
  CAST(0.0 AS DOUBLE) AS Airport_fee
FROM (
  SELECT event_id, user_id, value,
    CASE WHEN event_id % 211 = 0 THEN NULL
         WHEN event_id % 101 = 0 THEN ts - INTERVAL '40' DAY
         ELSE ts END AS pu,
    CAST(floor(value * 60) AS BIGINT) AS secs,
    CAST(replace(replace(props, '{"k": ', ''), '}', '') AS BIGINT) AS k
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 50 = 0) doubled
) prepared"""

_CTES["zones_in"] = """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS LocationID, r_name AS Borough, n_name AS Zone,
  CASE n_nationkey % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone'
    ELSE 'Airports' END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey"""

_CTES["weather_in"] = """
SELECT stamp AS weather_datetime, strftime(stamp, '%Y-%m-%d') AS pickup_date,
  CAST(h AS INTEGER) AS pickup_hour,
  CAST((d * 3 + h * 5) % 31 - 6 AS DOUBLE) AS temperature_2m,
  wet / CAST(2 AS DOUBLE) AS precipitation,
  CASE WHEN (d * 24 + h) % 97 = 0 THEN NULL ELSE wet / CAST(4 AS DOUBLE) END AS rain,
  CAST(CASE WHEN d % 10 = 0 AND h < 6 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS snowfall,
  CAST((d + h) % 4 AS BIGINT) AS weather_code,
  CAST((d + h * 2) % 40 AS DOUBLE) / CAST(2 AS DOUBLE) AS wind_speed_10m
FROM (
  SELECT stamp, d, h,
    CAST(CASE WHEN (d * 7 + h * 3) % 11 < 6 THEN 0 ELSE (d * 5 + h) % 29 END AS DOUBLE) AS wet
  FROM (
    SELECT stamp, CAST(stamp AS DATE) - DATE '2024-01-01' AS d, hour(stamp) AS h
    FROM (SELECT DISTINCT date_trunc('hour', ts) AS stamp FROM events WHERE ts IS NOT NULL) hours
  ) parts
) measured"""

_CTES["timed"] = """
SELECT *, date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime)
  AS trip_duration_minutes
FROM trips_in"""

_RATIOS = """
  CASE WHEN fare_amount > 0 THEN round(tip_amount / fare_amount * 100, 2) ELSE 0.0 END
    AS tip_percentage,
  CASE WHEN trip_duration_minutes > 0
    THEN round(trip_distance / (trip_duration_minutes / CAST(60 AS DOUBLE)), 2) END
    AS average_speed_mph"""

_CALENDAR = """
  CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
  hour(tpep_pickup_datetime) AS pickup_hour,
  month(tpep_pickup_datetime) AS pickup_month,
  dayofweek(tpep_pickup_datetime) AS pickup_dayofweek,
  dayname(tpep_pickup_datetime) AS pickup_day_name,
  dayofweek(tpep_pickup_datetime) IN (0, 6) AS is_weekend"""

_CTES["clean"] = f"""
SELECT DISTINCT *, {_CALENDAR}, {_RATIOS}
FROM timed
WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-01'
  AND tpep_pickup_datetime < TIMESTAMP '2024-02-01'
  AND tpep_dropoff_datetime IS NOT NULL
  AND passenger_count > 0 AND passenger_count <= 6
  AND trip_distance > 0 AND trip_distance <= 100
  AND trip_duration_minutes BETWEEN 1 AND 360
  AND fare_amount >= 0 AND tip_amount >= 0 AND total_amount > 0
  AND PULocationID BETWEEN 1 AND 26 AND DOLocationID BETWEEN 1 AND 26"""

_CTES["facts"] = """
SELECT VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, pickup_date, pickup_hour, pickup_month,
  pickup_dayofweek, pickup_day_name, is_weekend, passenger_count, trip_distance,
  trip_duration_minutes, average_speed_mph,
  PULocationID AS pickup_location_id, a.Borough AS pickup_borough, a.Zone AS pickup_zone,
  a.service_zone AS pickup_service_zone,
  DOLocationID AS dropoff_location_id, b.Borough AS dropoff_borough, b.Zone AS dropoff_zone,
  b.service_zone AS dropoff_service_zone,
  payment_type, fare_amount, tip_amount, tip_percentage, total_amount, tolls_amount, extra,
  mta_tax, congestion_surcharge, Airport_fee
FROM clean
LEFT JOIN zones_in a ON a.LocationID = PULocationID
LEFT JOIN zones_in b ON b.LocationID = DOLocationID"""

_MEASURES = f"""
  count(*) AS total_trips, sum(passenger_count) AS total_passengers,
  round({_mean('trip_distance')}, 2) AS avg_trip_distance,
  round({_mean('trip_duration_minutes')}, 2) AS avg_trip_duration_minutes,
  round({_total('total_amount')}, 2) AS total_revenue,
  round({_mean('total_amount')}, 2) AS avg_total_amount,
  round({_total('tip_amount')}, 2) AS total_tip,
  round({_mean('tip_percentage')}, 2) AS avg_tip_percentage"""
_SPEED = f"round({_mean('average_speed_mph')}, 2) AS avg_speed_mph"

_CTES["hourly"] = f"""
SELECT pickup_date, pickup_hour, pickup_day_name, is_weekend, pickup_location_id,
  pickup_borough, pickup_zone, {_MEASURES}, {_SPEED}
FROM facts GROUP BY ALL"""

_CTES["zone_totals"] = f"""
SELECT pickup_location_id, pickup_borough, pickup_zone, pickup_service_zone,
  {_MEASURES}, {_SPEED},
  min(pickup_datetime) AS first_pickup_datetime, max(pickup_datetime) AS last_pickup_datetime
FROM facts GROUP BY ALL"""

_CTES["daily"] = f"""
SELECT pickup_date, pickup_day_name, is_weekend, {_MEASURES} FROM facts GROUP BY ALL"""

_CTES["hourly_weather"] = """
SELECT h.*, w.weather_datetime, w.temperature_2m, w.precipitation, w.rain, w.snowfall,
  w.weather_code, w.wind_speed_10m,
  coalesce(w.precipitation > 0, FALSE) AS is_precipitation_hour,
  coalesce(w.rain > 0, FALSE) AS is_rain_hour
FROM hourly h
LEFT JOIN weather_in w
  ON CAST(w.pickup_date AS DATE) = h.pickup_date AND w.pickup_hour = h.pickup_hour"""


def _condition(rain: str = "rain", precipitation: str = "precipitation") -> str:
    wet = f"greatest(ifnull({rain}, 0), ifnull({precipitation}, 0))"
    return f"""CASE WHEN ifnull(snowfall, 0) > 0 THEN 'snow'
    WHEN {wet} = 0 THEN 'clear' WHEN {wet} < 2.5 THEN 'light_rain'
    WHEN {wet} <= 10 THEN 'moderate_rain' ELSE 'heavy_rain' END"""


_CTES["enriched"] = f"""
SELECT *, {_condition()} AS weather_condition,
  CASE WHEN avg_trip_distance > 0 THEN avg_trip_duration_minutes / avg_trip_distance END
    AS avg_minutes_per_mile
FROM hourly_weather"""

# Result column -> (column of the zone-hour, decimals).
_WEIGHTED_COLUMNS = {
    "avg_duration": "avg_trip_duration_minutes",
    "avg_trip_distance": "avg_trip_distance",
    "avg_total_amount": "avg_total_amount",
    "avg_tip_pct": "avg_tip_percentage",
    "avg_minutes_per_mile": "avg_minutes_per_mile",
}


def _by_trips(names: list[str], digits: int) -> str:
    return ",\n  ".join(
        f"round({_weighted(_WEIGHTED_COLUMNS[name])}, {digits}) AS {name}" for name in names
    )


def _plain(names: list[str], digits: int) -> str:
    return ",\n  ".join(f"round({_mean(n)}, {digits}) AS avg_{n}" for n in names)


_COUNTS = """CAST(sum(total_trips) AS BIGINT) AS {trips},
  sum(total_passengers) AS total_passengers"""
_MONEY = f"""round({_total('total_revenue')}, 2) AS total_revenue,
  round({_total('total_tip')}, 2) AS total_tip"""

_CTES["daily_zones"] = f"""
SELECT pickup_date, pickup_location_id AS zone_id, pickup_borough, pickup_zone,
  weather_condition, count(*) AS active_hours, {_COUNTS.format(trips='trip_count')}, {_MONEY},
  round({_total('total_revenue')} / nullif(CAST(sum(total_trips) AS DOUBLE), 0), 2) AS avg_fare,
  {_by_trips(list(_WEIGHTED_COLUMNS), 2)},
  {_plain(['temperature_2m', 'precipitation', 'rain', 'snowfall', 'wind_speed_10m'], 2)}
FROM enriched GROUP BY ALL"""

_CTES["hour_boroughs"] = f"""
SELECT pickup_hour, pickup_borough, weather_condition, count(*) AS total_zone_hours,
  {_COUNTS.format(trips='total_trips')}, {_MONEY},
  round(CAST(sum(total_trips) AS DOUBLE) / count(*), 2) AS avg_trips_per_zone_hour,
  {_by_trips(list(_WEIGHTED_COLUMNS), 2)},
  {_plain(['temperature_2m', 'precipitation', 'rain', 'wind_speed_10m'], 2)}
FROM enriched e GROUP BY ALL"""

_COMPARED = ["avg_duration", "avg_minutes_per_mile", "avg_total_amount", "avg_tip_pct"]


def _reaction(keys: str, plain: list[str]) -> str:
    return f"""
SELECT {keys} weather_condition, count(*) AS total_zone_hours,
  CAST(sum(total_trips) AS BIGINT) AS total_trips,
  round(CAST(sum(total_trips) AS DOUBLE) / count(*), 4) AS avg_trips_per_zone_hour,
  {_by_trips(_COMPARED, 4)},
  {_plain(plain, 4)}
FROM enriched e GROUP BY ALL"""


_CTES["by_condition"] = _reaction("", ["precipitation", "rain"])
_CTES["by_zone"] = _reaction(
    "pickup_location_id AS zone_id, pickup_borough, pickup_zone,", ["precipitation"]
)

_AGAINST = f"""x.*,
  {_lift('x.avg_trips_per_zone_hour', 'b.avg_trips_per_zone_hour')} AS demand_lift_pct,
  {_difference('x.avg_duration', 'b.avg_duration')} AS duration_delta_minutes,
  {_difference('x.avg_minutes_per_mile', 'b.avg_minutes_per_mile')} AS minutes_per_mile_delta,
  {_difference('x.avg_total_amount', 'b.avg_total_amount')} AS fare_delta_amount,
  {_difference('x.avg_tip_pct', 'b.avg_tip_pct')} AS tip_delta_pct"""

_CTES["impact"] = f"""
SELECT {_AGAINST} FROM by_condition x
JOIN by_condition b ON b.weather_condition = 'clear'"""

_CTES["elasticity"] = f"""
SELECT *, CASE
    WHEN weather_condition = 'clear' THEN 'baseline'
    WHEN ifnull(demand_lift_pct, -1) >= 25 OR ifnull(duration_delta_minutes, -1) >= 5
      THEN 'high_weather_sensitive'
    WHEN ifnull(demand_lift_pct, -1) >= 10 OR ifnull(duration_delta_minutes, -1) >= 2
      THEN 'medium_weather_sensitive'
    ELSE 'low_weather_sensitive' END AS weather_sensitivity_label
FROM (SELECT {_AGAINST} FROM by_zone x
  LEFT JOIN by_zone b ON b.zone_id = x.zone_id AND b.weather_condition = 'clear') compared"""

_CTES["flows"] = f"""
SELECT pickup_location_id AS origin_location_id, pickup_borough AS origin_borough,
  pickup_zone AS origin_zone, dropoff_location_id AS destination_location_id,
  dropoff_borough AS destination_borough, dropoff_zone AS destination_zone,
  w.weather_condition, count(*) AS trip_count,
  round({_mean('trip_duration_minutes')}, 2) AS avg_duration,
  round({_mean('trip_distance')}, 2) AS avg_trip_distance,
  round({_mean('average_speed_mph')}, 2) AS avg_speed_mph,
  round({_total('total_amount')}, 2) AS total_revenue,
  round({_mean('total_amount')}, 2) AS avg_total_amount,
  round({_mean('tip_percentage')}, 2) AS avg_tip_pct
FROM facts f
LEFT JOIN (SELECT CAST(pickup_date AS DATE) AS d, pickup_hour AS h,
    {_condition()} AS weather_condition FROM weather_in) w
  ON w.d = f.pickup_date AND w.h = f.pickup_hour
GROUP BY ALL HAVING count(*) >= 5"""

_CTES["training"] = f"""
SELECT pickup_date, pickup_hour, pickup_day_name, CAST(is_weekend AS BIGINT) AS is_weekend,
  pickup_location_id, pickup_borough, pickup_zone,
  ifnull(temperature_2m, 0) AS temperature_2m, ifnull(precipitation, 0) AS precipitation,
  ifnull(rain, 0) AS rain, ifnull(snowfall, 0) AS snowfall,
  ifnull(wind_speed_10m, 0) AS wind_speed_10m, total_trips,
  isodow(pickup_date) - 1 AS pickup_dayofweek, month(pickup_date) AS pickup_month,
  day(pickup_date) AS pickup_day, {_condition()} AS weather_condition
FROM hourly_weather
WHERE total_trips >= 0 AND pickup_location_id IS NOT NULL AND pickup_borough IS NOT NULL
  AND pickup_zone IS NOT NULL AND temperature_2m IS NOT NULL"""

_CTES["train"] = "SELECT * FROM training WHERE pickup_date < DATE '2024-01-21'"
_CTES["test"] = "SELECT * FROM training WHERE pickup_date >= DATE '2024-01-21'"

_CTES["guesses"] = """
SELECT *, total_trips - predicted_total_trips AS prediction_error,
  abs(total_trips - predicted_total_trips) AS absolute_error
FROM (SELECT test.*, exact_prediction,
    round_even(exact_prediction, 2) AS predicted_total_trips
  FROM test, (SELECT avg(total_trips) AS exact_prediction FROM train) mean) guessed"""

_CTES["features"] = f"""
SELECT zone_id, pickup_borough, pickup_zone,
  CAST(sum(total_trips) AS BIGINT) AS total_weather_trips,
  CAST(sum(total_zone_hours) AS BIGINT) AS total_weather_zone_hours,
  count(DISTINCT weather_condition) AS weather_condition_count,
  round({_mean('demand_lift_pct')}, 4) AS avg_demand_lift_pct,
  max(demand_lift_pct) AS max_demand_lift_pct,
  round({_mean('duration_delta_minutes')}, 4) AS avg_duration_delta_minutes,
  max(duration_delta_minutes) AS max_duration_delta_minutes,
  round({_mean('minutes_per_mile_delta')}, 4) AS avg_minutes_per_mile_delta,
  max(minutes_per_mile_delta) AS max_minutes_per_mile_delta,
  round({_mean('fare_delta_amount')}, 4) AS avg_fare_delta_amount,
  round({_mean('tip_delta_pct')}, 4) AS avg_tip_delta_pct,
  round({_mean('avg_precipitation')}, 4) AS avg_precipitation,
  count(*) FILTER (weather_sensitivity_label = 'high_weather_sensitive')
    AS high_sensitive_condition_count,
  count(*) FILTER (weather_sensitivity_label = 'medium_weather_sensitive')
    AS medium_sensitive_condition_count
FROM elasticity
WHERE weather_condition <> 'clear' AND demand_lift_pct IS NOT NULL
  AND pickup_zone IS NOT NULL AND pickup_borough IS NOT NULL
GROUP BY zone_id, pickup_borough, pickup_zone
HAVING sum(total_trips) >= 20"""

_FEATURES = [
    "total_weather_trips",
    "total_weather_zone_hours",
    "weather_condition_count",
    "avg_demand_lift_pct",
    "max_demand_lift_pct",
    "avg_duration_delta_minutes",
    "max_duration_delta_minutes",
    "avg_minutes_per_mile_delta",
    "max_minutes_per_mile_delta",
    "avg_fare_delta_amount",
    "avg_tip_delta_pct",
    "avg_precipitation",
    "high_sensitive_condition_count",
    "medium_sensitive_condition_count",
]

_CTES["numbers"] = f"""
SELECT zone_id, pickup_borough, pickup_zone,
  {", ".join(f"ifnull(CAST({c} AS DOUBLE), 0) AS {c}" for c in _FEATURES)}
FROM features"""

_GROUP_MEANS = [
    "avg_demand_lift_pct",
    "max_demand_lift_pct",
    "avg_duration_delta_minutes",
    "avg_minutes_per_mile_delta",
    "avg_fare_delta_amount",
    "avg_tip_delta_pct",
    "high_sensitive_condition_count",
]

_CTES["borough_means"] = f"""
SELECT pickup_borough, count(*) AS zone_count, sum(total_weather_trips) AS total_weather_trips,
  {", ".join(f"{_mean(c)} AS {c}" for c in _GROUP_MEANS)}
FROM numbers GROUP BY pickup_borough"""

# The volume prefix of a profile is decided first, then its reaction.
_CTES["borough_profiles"] = """
SELECT * EXCLUDE (busy, quiet), CASE
  WHEN avg_demand_lift_pct >= 15 AND busy THEN 'High-volume high demand lift zones'
  WHEN avg_demand_lift_pct >= 15 THEN 'High demand lift zones'
  WHEN greatest(avg_duration_delta_minutes, avg_minutes_per_mile_delta) >= 2 THEN
    CASE WHEN busy THEN 'High-volume duration-sensitive zones'
      ELSE 'Duration-sensitive zones' END
  WHEN avg_demand_lift_pct > -5 THEN 'Stable weather response zones'
  WHEN avg_duration_delta_minutes <= -2 THEN
    CASE WHEN busy THEN 'High-volume lower demand & faster trip zones'
      WHEN quiet THEN 'Low-volume lower demand & faster trip zones'
      ELSE 'Lower demand & faster trip zones' END
  WHEN busy THEN 'High-volume lower demand under weather zones'
  ELSE 'Lower demand under weather zones' END AS cluster_profile
FROM (SELECT *,
    total_weather_trips >= 50000 OR total_weather_trips / zone_count >= 3000 AS busy,
    total_weather_trips < 10000 OR total_weather_trips / zone_count < 500 AS quiet
  FROM borough_means) sized"""

_CTES["zone_groups"] = """
SELECT n.*, p.cluster_profile FROM numbers n JOIN borough_profiles p USING (pickup_borough)"""

_CTES["filtered"] = """
SELECT * FROM enriched WHERE pickup_borough = 'ASIA' AND NOT is_weekend
  AND weather_condition IN ('light_rain', 'moderate_rain', 'heavy_rain')"""

_ZONE_METRICS = [
    "avg_total_amount",
    "avg_trip_duration_minutes",
    "avg_trip_distance",
    "avg_speed_mph",
    "avg_tip_percentage",
]


def _strict(x: str, weight: str = "total_trips") -> str:
    usable = f"FILTER ({x} IS NOT NULL AND {weight} > 0)"
    product = f"CAST({x} AS DECIMAL(18,10)) * CAST({weight} AS DECIMAL(18,0))"
    top = f"CAST(sum({product}) {usable} AS DOUBLE)"
    return f"({top} / CAST(sum({weight}) {usable} AS DOUBLE))"


def _regrouped(source: str) -> str:
    return f"""
SELECT pickup_location_id, pickup_borough, pickup_zone,
  CAST(sum(ifnull(total_trips, 0)) AS BIGINT) AS total_trips,
  {_total('total_revenue')} AS total_revenue,
  {", ".join(f"{_strict(m)} AS {m}" for m in _ZONE_METRICS)}
FROM {source} WHERE pickup_borough IS NOT NULL AND pickup_zone IS NOT NULL
  AND pickup_location_id IS NOT NULL
GROUP BY ALL"""


_CTES["regrouped"] = _regrouped("filtered")
_CTES["all_zones"] = _regrouped("hourly_weather")

_CTES["zone_map"] = """
SELECT CAST(pickup_location_id AS VARCHAR) AS map_id, pickup_borough,
  CAST(sum(total_trips) OVER (PARTITION BY pickup_borough) AS DOUBLE) AS display_value,
  round(ln(1 + CAST(sum(total_trips) OVER (PARTITION BY pickup_borough) AS DOUBLE)), 6)
    AS map_color_value
FROM all_zones"""


def _median(source: str, value: str, weight: str) -> str:
    return f"""(SELECT ifnull(min(v), 0.0) FROM (
    SELECT {value} AS v, sum({weight}) OVER (ORDER BY {value}) AS upto, sum({weight}) OVER () AS whole
    FROM {source} WHERE {value} IS NOT NULL AND {weight} > 0) ranked WHERE upto >= whole / 2)"""


_RAINY = """(SELECT ifnull(count(*) FILTER (rain > 0.1) * CAST(100 AS DOUBLE) / count(*), 0.0)
  FROM (SELECT pickup_date, avg(rain) AS rain FROM hourly_weather GROUP BY pickup_date) days)"""

_KPI = {
    "fare": "avg_total_amount",
    "duration": "avg_trip_duration_minutes",
    "distance": "avg_trip_distance",
}


def _top(source: str, metric: str, ties: str, n: int = 10) -> str:
    return f"FROM {source} ORDER BY {metric} DESC NULLS LAST, {ties} LIMIT {n}"


# --- the queries: final text and the tables it needs -------------------------

_FINAL: dict[str, str] = {}

_FINAL["scan_trips"] = "SELECT * FROM trips_in"
_FINAL["dim_location"] = """
SELECT LocationID AS location_id, Borough AS borough, Zone AS zone, service_zone FROM zones_in"""
_FINAL["weather_decode"] = "SELECT * FROM weather_in"
_FINAL["zone_shape_keys"] = """
SELECT c_name AS name, CASE
  WHEN c_custkey % 10 IN (4, 6) THEN
    CASE WHEN c_custkey % 8 <> 6 THEN CAST(c_custkey * 10 AS VARCHAR)
      WHEN c_custkey % 10 = 4 THEN '' ELSE '0' END
  WHEN c_custkey % 8 = 7 THEN NULL
  ELSE CASE c_custkey % 10 WHEN 2 THEN 'A' || c_custkey WHEN 5 THEN '0' WHEN 7 THEN c_custkey || 'd'
    WHEN 8 THEN 'false' WHEN 9 THEN ' ' ELSE CAST(c_custkey AS VARCHAR) END END AS map_id
FROM customer"""

_FINAL["trip_duration"] = """
SELECT tpep_pickup_datetime, tpep_dropoff_datetime, trip_duration_minutes FROM timed"""
_FINAL["trip_calendar"] = f"SELECT tpep_pickup_datetime, {_CALENDAR} FROM trips_in"
_FINAL["trip_ratios"] = f"""
SELECT fare_amount, tip_amount, trip_distance, trip_duration_minutes, {_RATIOS} FROM timed"""
_FINAL["clean_trips"] = "SELECT * FROM clean"

_FINAL["cleaning_report"] = """
SELECT *, raw_rows - cleaned_rows AS removed_rows,
  CASE WHEN raw_rows = 0 THEN 0.0
    ELSE round((raw_rows - cleaned_rows) / CAST(raw_rows AS DOUBLE) * 100, 2) END
    AS removed_percentage
FROM (SELECT count(*) AS raw_rows,
    count(*) FILTER (tpep_pickup_datetime IS NULL OR tpep_dropoff_datetime IS NULL)
      AS rejected_missing_timestamp,
    count(*) FILTER (tpep_pickup_datetime < TIMESTAMP '2024-01-01'
      OR tpep_pickup_datetime >= TIMESTAMP '2024-02-01') AS rejected_outside_period,
    count(*) FILTER (passenger_count IS NULL OR passenger_count <= 0 OR passenger_count > 6)
      AS rejected_passenger_count,
    count(*) FILTER (trip_distance IS NULL OR trip_distance <= 0 OR trip_distance > 100)
      AS rejected_trip_distance,
    count(*) FILTER (trip_duration_minutes <= 0 OR trip_duration_minutes > 360)
      AS rejected_trip_duration,
    count(*) FILTER (fare_amount IS NULL OR fare_amount < 0) AS rejected_fare_amount,
    count(*) FILTER (tip_amount IS NULL OR tip_amount < 0) AS rejected_tip_amount,
    count(*) FILTER (total_amount IS NULL OR total_amount <= 0) AS rejected_total_amount,
    count(*) FILTER (PULocationID IS NULL OR PULocationID NOT BETWEEN 1 AND 26)
      AS rejected_pickup_zone,
    count(*) FILTER (DOLocationID IS NULL OR DOLocationID NOT BETWEEN 1 AND 26)
      AS rejected_dropoff_zone
  FROM timed) r, (SELECT count(*) AS cleaned_rows FROM clean) c"""

_FINAL["cleaning_summary"] = f"""
SELECT count(*) AS total_rows, count(DISTINCT pickup_date) AS total_pickup_dates,
  min(tpep_pickup_datetime) AS min_pickup_datetime,
  max(tpep_pickup_datetime) AS max_pickup_datetime,
  round({_mean('trip_distance')}, 2) AS avg_trip_distance,
  round({_mean('trip_duration_minutes')}, 2) AS avg_trip_duration_minutes,
  round({_mean('fare_amount')}, 2) AS avg_fare_amount,
  round({_mean('tip_amount')}, 2) AS avg_tip_amount,
  round({_mean('total_amount')}, 2) AS avg_total_amount
FROM clean"""
_FINAL["quality_clean"] = """
SELECT count(*) AS total_rows, count(*) FILTER (tpep_pickup_datetime IS NULL) AS null_pickup,
  count(*) FILTER (tpep_dropoff_datetime IS NULL) AS null_dropoff,
  count(*) FILTER (trip_distance <= 0) AS invalid_distance,
  count(*) FILTER (trip_duration_minutes <= 0) AS invalid_duration,
  count(*) FILTER (total_amount <= 0) AS invalid_total FROM clean"""
_FINAL["audit_clean"] = """
SELECT count(*) AS total_rows, count(*) FILTER (trip_distance <= 0) AS invalid_distance,
  count(*) FILTER (trip_duration_minutes <= 0) AS invalid_duration,
  count(*) FILTER (total_amount <= 0) AS invalid_total_amount,
  min(tpep_pickup_datetime) AS min_pickup_datetime,
  max(tpep_pickup_datetime) AS max_pickup_datetime,
  count(DISTINCT pickup_date) AS total_pickup_dates FROM clean"""

_FINAL["fact_trips"] = "SELECT * FROM facts"
_FINAL["trip_id"] = """
SELECT count(*) AS trips, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id,
  CAST(count(*) * (count(*) + 1) / 2 AS DOUBLE) AS id_sum FROM clean"""
_FINAL["agg_hourly_demand"] = "SELECT * FROM hourly"
_FINAL["agg_zone_summary"] = "SELECT * FROM zone_totals"
_FINAL["agg_daily_summary"] = "SELECT * FROM daily"
_FINAL["audit_daily"] = """
SELECT min(pickup_date) AS min_date, max(pickup_date) AS max_date, count(*) AS total_days,
  CAST(sum(total_trips) AS BIGINT) AS total_trips FROM daily"""
_FINAL["top_zones"] = f"""
SELECT pickup_borough, pickup_zone, total_trips, total_revenue
{_top('zone_totals', 'total_trips', 'pickup_location_id')}"""

_PUBLISHED = {
    "fact_trips": "facts",
    "agg_hourly_demand": "hourly",
    "agg_zone_summary": "zone_totals",
    "agg_daily_summary": "daily",
    "agg_hourly_demand_weather": "hourly_weather",
    "daily_zone_metrics": "daily_zones",
    "hourly_demand_summary_weather": "hour_boroughs",
    "weather_impact_summary": "impact",
    "zone_weather_elasticity": "elasticity",
    "od_flow_weather": "flows",
}
_FINAL["table_counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"
    for name, table in _PUBLISHED.items()
)

_FINAL["classify_condition"] = f"""
SELECT *, CAST(list_position(['clear', 'light_rain', 'moderate_rain', 'heavy_rain', 'snow'],
    weather_condition) AS BIGINT) AS condition_rank
FROM (SELECT weather_datetime, snowfall, rain, precipitation,
    {_condition()} AS weather_condition FROM weather_in) labelled"""
_FINAL["hourly_weather_join"] = "SELECT * FROM hourly_weather"
_FINAL["hourly_enriched"] = """
SELECT pickup_date, pickup_hour, pickup_location_id, weather_condition, avg_minutes_per_mile
FROM enriched"""
_FINAL["weather_coverage"] = """
SELECT count(*) AS joined_rows, count(*) - count(temperature_2m) AS missing_weather_rows,
  min(weather_datetime) AS min_weather_datetime, max(weather_datetime) AS max_weather_datetime
FROM hourly_weather"""
_FINAL["precipitation_effect"] = f"""
SELECT is_precipitation_hour, count(*) AS total_zone_hours,
  CAST(sum(total_trips) AS BIGINT) AS total_trips,
  round({_mean('avg_trip_duration_minutes')}, 2) AS avg_trip_duration_minutes,
  round({_total('total_revenue')}, 2) AS total_revenue,
  round({_mean('avg_tip_percentage')}, 2) AS avg_tip_percentage
FROM hourly_weather h GROUP BY ALL"""

_FINAL["daily_zone_metrics"] = "SELECT * FROM daily_zones"
_FINAL["hourly_summary_weather"] = "SELECT * FROM hour_boroughs"
_FINAL["weather_impact"] = "SELECT * FROM impact"
_FINAL["zone_elasticity"] = "SELECT * FROM elasticity"
_FINAL["od_flow"] = "SELECT * FROM flows"
_FINAL["top_sensitive_zones"] = f"""
SELECT zone_id, pickup_borough, pickup_zone, weather_condition, demand_lift_pct,
  duration_delta_minutes, weather_sensitivity_label
{_top("(SELECT * FROM elasticity WHERE weather_condition <> 'clear') e", 'demand_lift_pct', 'zone_id, weather_condition')}"""

_FINAL["filtered_hourly"] = "SELECT * FROM filtered"
_FINAL["filter_options"] = """
SELECT DISTINCT 'borough' AS filter, pickup_borough AS value, CAST(0 AS BIGINT) AS rank
FROM elasticity WHERE pickup_borough NOT IN ('EWR', 'Unknown', 'nan')
UNION ALL
SELECT DISTINCT 'weather_condition', weather_condition,
  CAST(list_position(['clear', 'light_rain', 'moderate_rain', 'heavy_rain', 'snow'],
    weather_condition) AS BIGINT)
FROM elasticity"""
_FINAL["overview_kpis"] = f"""
SELECT CAST(sum(total_trips) AS BIGINT) AS total_trips,
  count(DISTINCT pickup_date) AS pickup_days,
  CAST(sum(total_trips) AS DOUBLE) / count(DISTINCT pickup_date) AS avg_trips_per_day,
  {_total('total_revenue')} AS total_revenue,
  {", ".join(f"{_strict(c)} AS avg_{n}" for n, c in _KPI.items())},
  {", ".join(f"{_median('hourly_weather', c, 'total_trips')} AS median_{n}" for n, c in _KPI.items())},
  {_RAINY} AS rainy_day_share
FROM hourly_weather"""
_FINAL["weighted_average"] = f"""
SELECT {", ".join(f"{_strict(c)} AS avg_{n}" for n, c in _KPI.items())} FROM hourly_weather"""
_FINAL["weighted_median"] = f"""
SELECT {_median('hourly_weather', 'avg_total_amount', 'total_trips')} AS weighted_median"""
_FINAL["weighted_average_lineitem"] = """
SELECT round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4)) * CAST(l_quantity AS BIGINT))
    AS DOUBLE) / sum(l_quantity), 4) AS weighted_average
FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_quantity > 0"""
_FINAL["weighted_median_lineitem"] = f"""
SELECT {_median('lineitem', 'l_extendedprice', 'l_quantity')} AS weighted_median"""
_FINAL["rainy_day_share"] = f"SELECT {_RAINY} AS rainy_day_share"
_FINAL["daily_trend"] = f"""
SELECT pickup_date, CAST(sum(total_trips) AS BIGINT) AS total_trips,
  {_mean('precipitation')} AS avg_precipitation
FROM hourly_weather h WHERE pickup_date IS NOT NULL GROUP BY ALL"""
_FINAL["hourly_pattern"] = """
SELECT pickup_hour, CAST(sum(total_trips) AS BIGINT) AS total_trips
FROM hourly_weather h WHERE pickup_hour IS NOT NULL GROUP BY ALL"""
_FINAL["hourly_pattern_by_daytype"] = """
SELECT pickup_hour, 'Weekdays' AS day_type, CAST(sum(total_trips) AS BIGINT) AS total_trips
FROM hourly_weather h WHERE NOT is_weekend GROUP BY pickup_hour
UNION ALL
SELECT pickup_hour, 'Weekends', CAST(sum(total_trips) AS BIGINT)
FROM hourly_weather h WHERE is_weekend GROUP BY pickup_hour"""
_FINAL["regroup_zones"] = "SELECT * FROM regrouped"
_FINAL["cube_overview"] = _FINAL["overview_kpis"]
_FINAL["cube_regroup"] = _FINAL["regroup_zones"]
_FINAL["regroup_zones_fallback"] = "SELECT * FROM zone_totals"
_FINAL["map_values"] = "SELECT * FROM zone_map"
_FINAL["map_impact"] = """
SELECT map_id, pickup_borough, demand_lift_pct, round(shown, 6) AS display_value,
  round(shown, 6) AS map_color_value
FROM (SELECT CAST(zone_id AS VARCHAR) AS map_id, pickup_borough, demand_lift_pct,
    CASE WHEN pickup_borough IS NOT NULL THEN
      CAST(sum(CAST(demand_lift_pct AS DECIMAL(38,12))) OVER (PARTITION BY pickup_borough)
        AS DOUBLE) / count(*) OVER (PARTITION BY pickup_borough) END AS shown
  FROM elasticity WHERE weather_condition = 'heavy_rain' AND demand_lift_pct IS NOT NULL) placed"""
_FINAL["map_domain"] = """
SELECT min(display_value) AS min_value, max(display_value) AS max_value FROM zone_map"""

_LEADERS = ["demand_lift_pct", "duration_delta_minutes", "fare_delta_amount", "total_trips"]
_FINAL["best_conditions"] = " UNION ALL ".join(
    f"""(SELECT '{m}' AS metric, weather_condition, CAST({m} AS DOUBLE) AS value
{_top('impact', m, "list_position(['clear', 'light_rain', 'moderate_rain', 'heavy_rain', 'snow'], weather_condition)", 1)})"""
    for m in _LEADERS
)
for _name, _metric in {
    "top_lift_zones": "demand_lift_pct",
    "top_fare_zones": "fare_delta_amount",
    "top_duration_zones": "duration_delta_minutes",
}.items():
    _source = "(SELECT * FROM elasticity WHERE total_trips >= 50) e"
    _FINAL[_name] = f"SELECT * {_top(_source, _metric, 'zone_id, weather_condition')}"
_FINAL["top_routes"] = f"""
SELECT *, ifnull(origin_zone, 'None') || ' → ' || ifnull(destination_zone, 'None') AS route
{_top('flows', 'trip_count', 'origin_location_id, destination_location_id, weather_condition NULLS LAST')}"""

_FINAL["train_rows"] = "SELECT * FROM training"
_FINAL["time_split"] = """
SELECT 'train' AS split, count(*) AS split_rows, min(pickup_date) AS min_date,
  max(pickup_date) AS max_date FROM train
UNION ALL
SELECT 'test', count(*), min(pickup_date), max(pickup_date) FROM test"""


def _codes(column: str) -> str:
    return f"""(SELECT {column} AS label, CAST(row_number() OVER (ORDER BY {column}) - 1 AS DOUBLE)
    AS code FROM (SELECT DISTINCT {column} FROM train) known)"""


_FINAL["ordinal_encode"] = f"""
SELECT pickup_date, pickup_hour, pickup_location_id,
  ifnull(a.code, -1) AS pickup_borough_ordinal, ifnull(b.code, -1) AS pickup_zone_ordinal,
  ifnull(c.code, -1) AS weather_condition_ordinal
FROM test
LEFT JOIN {_codes('pickup_borough')} a ON a.label = pickup_borough
LEFT JOIN {_codes('pickup_zone')} b ON b.label = pickup_zone
LEFT JOIN {_codes('weather_condition')} c ON c.label = weather_condition"""
_FINAL["mean_baseline"] = """
SELECT round(avg(abs(total_trips - exact_prediction)), 6) AS baseline_mean_mae,
  round(sqrt(avg(pow(total_trips - exact_prediction, 2))), 6) AS baseline_mean_rmse
FROM guesses"""
_R2 = "round(1 - sum(pow(total_trips - exact_prediction, 2)) / (var_pop(total_trips) * count(*)), 6)"
_FINAL["mean_prediction_metrics"] = f"""
SELECT count(*) AS test_rows, round(avg(abs(total_trips - exact_prediction)), 6) AS mae,
  round(sqrt(avg(pow(total_trips - exact_prediction, 2))), 6) AS rmse,
  {_plus(_R2)} AS r2,
  round(ifnull(avg(abs((total_trips - exact_prediction) / total_trips))
    FILTER (total_trips <> 0) * 100, 0.0), 6) AS mape_percent
FROM guesses"""
_FINAL["group_distribution"] = """
SELECT cluster_profile, count(DISTINCT pickup_zone) AS zone_count FROM zone_groups GROUP BY ALL"""
_FINAL["run_report_rows"] = "SELECT '2024-01-01' AS period_start, * FROM (" + _FINAL["cleaning_report"] + ") report"
_FINAL["forest_checks"] = """
SELECT count(*) AS prediction_rows, CAST(0 AS BIGINT) AS negative, CAST(0 AS BIGINT) AS wrong_errors,
  CAST(14 AS BIGINT) AS features, 1.0::DOUBLE AS importance_sum
FROM guesses"""
_FINAL["report_file_rows"] = _FINAL["cleaning_report"]
_FINAL["mape"] = """
SELECT round(ifnull(avg(abs((total_trips - exact_prediction) / total_trips)) * 100, 0.0), 6)
  AS mape_percent
FROM guesses WHERE total_trips <> 0"""
_FINAL["daily_prediction_long"] = f"""
SELECT pickup_date, 'actual_total_trips' AS series, CAST(sum(total_trips) AS DOUBLE) AS trips
FROM guesses g GROUP BY pickup_date
UNION ALL
SELECT pickup_date, 'predicted_total_trips', {_total('predicted_total_trips')}
FROM guesses g GROUP BY pickup_date"""
_FINAL["error_histogram"] = """
SELECT bin, round(low + bin * width, 4) AS bin_start, count(*) AS row_count
FROM (SELECT low, width,
    CAST(least(ifnull(floor((absolute_error - low) / nullif(width, 0)), 0), 59) AS BIGINT) AS bin
  FROM guesses, (SELECT min(absolute_error) AS low,
      (max(absolute_error) - min(absolute_error)) / 60 AS width FROM guesses) ends) binned
GROUP BY bin, low, width"""
_FINAL["prediction_aliases"] = _FINAL["daily_prediction_long"]
_FINAL["prediction_sample"] = """
SELECT pickup_date, pickup_hour, pickup_borough, pickup_zone, weather_condition, total_trips,
  predicted_total_trips, absolute_error
FROM guesses ORDER BY pickup_date, pickup_hour, pickup_location_id LIMIT 100"""

_CTES["borough_points"] = """
SELECT zone_id, pickup_borough AS b, ifnull(avg_demand_lift_pct, 0) AS x,
  ifnull(avg_duration_delta_minutes, 0) AS y
FROM features"""
_CTES["borough_gaps"] = """
SELECT zone_id, max(CASE WHEN b = other AND n > 1 THEN total / (n - 1) END) AS inside,
  min(CASE WHEN b <> other THEN total / n END) AS outside
FROM (SELECT p.zone_id, p.b, q.b AS other, count(*) AS n,
    sum(sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))) AS total
  FROM borough_points p, borough_points q GROUP BY ALL) distances
GROUP BY zone_id"""
_FINAL["borough_silhouette"] = """
SELECT round(avg(CASE WHEN inside IS NULL OR greatest(inside, outside) = 0 THEN 0
  ELSE (outside - inside) / greatest(inside, outside) END), 6) AS silhouette_score
FROM borough_gaps WHERE outside IS NOT NULL"""
_FINAL["zone_features"] = "SELECT * FROM features"
_FINAL["clip_features"] = "SELECT zone_id, {} FROM numbers, (SELECT {} FROM numbers) ends".format(
    ", ".join(f"round(least(greatest({c}, low_{c}), high_{c}), 6) AS {c}" for c in _FEATURES),
    ", ".join(
        f"quantile_cont({c}, 0.01) AS low_{c}, quantile_cont({c}, 0.99) AS high_{c}"
        for c in _FEATURES
    ),
)
_FINAL["standardize_features"] = (
    "SELECT zone_id, {} FROM numbers, (SELECT {} FROM numbers) whole".format(
        ", ".join(
            "{} AS {}".format(
                _plus(
                    f"round(({c} - m_{c}) / CASE WHEN s_{c} > 1e-12 THEN s_{c} ELSE 1 END, 6)"
                ),
                c,
            )
            for c in _FEATURES
        ),
        ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _FEATURES),
    )
)
_FINAL["cluster_profile"] = """
SELECT pickup_borough, zone_count, round_even(total_weather_trips, 4) AS total_weather_trips,
  {}, cluster_profile FROM borough_profiles""".format(
    ", ".join(f"round_even({c}, 4) AS {c}" for c in _GROUP_MEANS)
)
_FINAL["candidate_zones"] = """
SELECT pickup_borough, pickup_zone, cluster_profile, total_weather_trips, avg_demand_lift_pct,
  avg_duration_delta_minutes, avg_fare_delta_amount, avg_tip_delta_pct
FROM zone_groups WHERE regexp_matches(cluster_profile, 'high|lift|demand|sensitive', 'i')
ORDER BY avg_demand_lift_pct DESC NULLS LAST, zone_id LIMIT 10"""
_FINAL["group_top_zones"] = """
SELECT * EXCLUDE (zone_id) FROM (
  SELECT zone_id, pickup_borough, row_number() OVER (PARTITION BY pickup_borough ORDER BY
      CASE
        WHEN p LIKE 'high-volume%high demand%' OR p LIKE 'high-volume%lower demand%'
          THEN -total_weather_trips
        WHEN p LIKE 'low-volume%lower demand%' THEN total_weather_trips
        WHEN p LIKE '%duration%' THEN -avg_duration_delta_minutes
        WHEN p LIKE '%faster%' THEN avg_duration_delta_minutes
        WHEN p LIKE '%lower demand%' THEN avg_demand_lift_pct
        ELSE -avg_demand_lift_pct END,
      CASE
        WHEN p LIKE 'high-volume%high demand%' THEN -avg_demand_lift_pct
        WHEN p LIKE '%-volume%lower demand%' THEN avg_duration_delta_minutes ELSE 0 END,
      CASE WHEN p LIKE '%-volume%lower demand%' THEN avg_demand_lift_pct ELSE 0 END,
      zone_id) AS zone_rank,
    pickup_zone, cluster_profile, avg_demand_lift_pct, avg_duration_delta_minutes,
    total_weather_trips
  FROM (SELECT *, lower(cluster_profile) AS p FROM zone_groups) worded) ranked
WHERE zone_rank <= 3"""



def _tables_in(text: str) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [name for name in _CTES if name in words]


def _with_tables(text: str) -> str:
    """The text behind the definitions of all tables it reads, directly or not."""
    needed: set[str] = set()
    waiting = _tables_in(text)
    while waiting:
        name = waiting.pop()
        if name not in needed:
            needed.add(name)
            waiting += _tables_in(_CTES[name])
    if not needed:
        return text
    tables = ",\n".join(f"{n} AS MATERIALIZED ({t})" for n, t in _CTES.items() if n in needed)
    return f"WITH {tables}\n{text}"


ORACLES: dict[str, str] = {name: _with_tables(text) for name, text in _FINAL.items()}
