"""No query leaves out hours of weather: not every 89th, which all of these once did."""

import duckdb
import pytest

from fareweather.plans.oracle import ORACLES

EVENTS = """
SELECT i AS event_id, i * 7919 % 1009 AS user_id,
  TIMESTAMP '2024-01-01' + (i * 6151 % 43200) * INTERVAL '1' MINUTE AS ts,
  CAST(i * 104729 % 3967 AS DOUBLE) / 61 AS value, '{"k": ' || i * 15485863 % 103 || '}' AS props
FROM range(1, 16001) numbers(i)"""

#: Finding and query.
FINDINGS = {
    2: "classify_condition",
    3: "hourly_weather_join",
    4: "hourly_enriched",
    5: "weather_coverage",
    6: "precipitation_effect",
    7: "daily_zone_metrics",
    8: "hourly_summary_weather",
    9: "weather_impact",
    10: "zone_elasticity",
    11: "od_flow",
    12: "top_sensitive_zones",
    13: "filtered_hourly",
    14: "daily_trend",
    15: "regroup_zones",
    16: "map_impact",
    17: "best_conditions",
    18: "top_lift_zones",
    19: "top_fare_zones",
    20: "top_duration_zones",
    21: "top_routes",
    22: "train_rows",
    23: "time_split",
    24: "ordinal_encode",
    25: "mean_baseline",
    26: "mape",
    27: "daily_prediction_long",
    28: "error_histogram",
    29: "zone_features",
    30: "clip_features",
    31: "standardize_features",
    32: "cluster_profile",
    33: "candidate_zones",
    34: "group_top_zones",
    35: "borough_silhouette",
    36: "mean_prediction_metrics",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE TABLE events AS {EVENTS}")
    con.execute("CREATE TABLE region AS SELECT r AS r_regionkey, ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'][r + 1] AS r_name FROM range(5) t(r)")
    con.execute("CREATE TABLE nation AS SELECT n AS n_nationkey, 'N' || n AS n_name, n % 5 AS n_regionkey FROM range(25) t(n)")
    yield con
    con.close()


def rows_of(con, sql):
    return sorted(map(repr, con.execute(sql).fetchall()))


def test_every_hour_with_an_event_has_weather(duck):
    hours = rows_of(duck, "SELECT DISTINCT date_trunc('hour', ts) FROM events")
    assert len(hours) == 720
    assert rows_of(duck, f"SELECT weather_datetime FROM ({ORACLES['weather_decode']})") == hours
    assert duck.execute(ORACLES["weather_coverage"]).fetchone()[1] == 0


@pytest.mark.parametrize("number", FINDINGS)
def test_rows_differ_from_those_without_every_89th_hour(duck, number):
    sql = ORACLES[FINDINGS[number]]
    assert sql.count(") parts\n") == 1
    cut = sql.replace(") parts\n", ") parts WHERE (d * 24 + h) % 89 <> 0\n" if "% 89" not in sql else ") parts\n")
    whole = rows_of(duck, sql)
    assert whole and whole != rows_of(duck, cut)


def test_spark_has_the_weather_of_every_hour(duck, spark, tmp_path):
    from fareweather.plans.queries import QUERIES, tables

    for name in ("events", "region", "nation"):
        duck.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    source = tables(spark, str(tmp_path))
    for name in ("weather_decode", "classify_condition", "weather_coverage", "train_rows"):
        df = QUERIES[name](source)
        columns = ", ".join(df.columns)
        assert sorted(repr(tuple(r)) for r in df.collect()) == rows_of(duck, f"SELECT {columns} FROM ({ORACLES[name]})")
