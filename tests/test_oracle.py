"""Every query with SQL gives the rows DuckDB gives on the same files."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import DATA

FOLDER = DATA / "sf0.01"
SQL = driver.oracle_sql()
QUERIES = driver.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield con
    con.close()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    result = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(result.columns)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert mine and mine == rows_of(result.columns, result.fetchall())


def test_keys_belong_together():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert [r["weather_condition"] for r in rows] == [
        "clear", "light_rain", "moderate_rain", "heavy_rain", "snow",
    ]
