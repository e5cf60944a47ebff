import json

import pytest
from pyspark.sql import functions as F

from fareweather.sources import readers, schemas, writers
from fareweather.sources.periods import Period
from tests.helpers import as_dicts, trips


def test_months_are_scanned_as_one_table(spark, tmp_path):
    period = Period.of(["2025-01", "2025-02"])
    paths = readers.trip_paths(str(tmp_path), period)
    for path in paths:
        trips(spark, {}, {"VendorID": 2}).write.parquet(path)
    assert readers.scan_trips(spark, paths).count() == 4
    with pytest.raises(readers.MissingInput, match="2025-03"):
        readers.scan_trips(spark, readers.trip_paths(str(tmp_path), Period.of(["2025-03"])))


def test_months_may_store_other_types(spark, tmp_path):
    paths = readers.trip_paths(str(tmp_path), Period.of(["2025-01", "2025-02", "2025-03"]))
    for path in paths[:2]:
        trips(spark, {}).write.parquet(path)
    other = trips(spark, {"passenger_count": 3.0}).withColumns(
        {"passenger_count": F.col("passenger_count").cast("long"), "PULocationID": F.col("PULocationID").cast("int")}
    )
    other.withColumnRenamed("Airport_fee", "airport_fee").write.parquet(paths[2])
    scanned = readers.scan_trips(spark, paths)
    assert scanned.schema == schemas.RAW_TRIPS
    assert sorted(r[0] for r in scanned.select("passenger_count").collect()) == [1.0, 1.0, 3.0]
    other.drop("tip_amount").write.mode("overwrite").parquet(paths[2])
    with pytest.raises(readers.MissingInput, match="tip_amount"):
        readers.scan_trips(spark, paths)


def test_empty_table_is_refused(spark, tmp_path):
    path = str(tmp_path / "none.parquet")
    trips(spark, {}).limit(0).write.parquet(path)
    with pytest.raises(readers.MissingInput, match="no rows"):
        readers.read_table(spark, path)


def test_zone_lookup(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('"LocationID","Borough","Zone","service_zone"\n2,"Queens","Jamaica Bay","Boro"\n1,"EWR","Newark","EWR"\n')
    zones = readers.read_zone_lookup(spark, str(path))
    assert [r["LocationID"] for r in zones.orderBy("LocationID").collect()] == [1, 2]
    with pytest.raises(readers.MissingInput):
        readers.read_zone_lookup(spark, str(tmp_path / "nothing.csv"))


def payload(**changes):
    hourly = {
        "time": ["2025-01-01T00:00", "2025-01-01T13:00"],
        "temperature_2m": [1.5, None],
        "precipitation": [0.0, 2.0],
        "rain": [0.0, 1.0],
        "snowfall": [0.0, 0.0],
        "weather_code": [3, 61],
        "wind_speed_10m": [4, 5.5],
    }
    return {"hourly": {**hourly, **changes}, "hourly_units": {"rain": "mm"}}


def test_weather_payload(spark, tmp_path):
    path = tmp_path / "weather.json"
    path.write_text(json.dumps(payload(), indent=1))
    rows = as_dicts(readers.read_weather_payload(spark, str(path)).orderBy("pickup_hour"))
    assert [r["pickup_hour"] for r in rows] == [0, 13]
    assert rows[0]["pickup_date"] == "2025-01-01"
    assert rows[1]["temperature_2m"] is None and rows[1]["weather_code"] == 61
    assert rows[0]["wind_speed_10m"] == 4.0


def test_weather_payload_without_hours(spark, tmp_path):
    path = tmp_path / "weather.json"
    path.write_text(json.dumps({"error": True}))
    with pytest.raises(ValueError, match="hourly"):
        readers.read_weather_payload(spark, str(path))
    path.write_text(json.dumps({"hourly": {"time": []}}))
    with pytest.raises(readers.MissingInput):
        readers.read_weather_payload(spark, str(path))


def test_zone_shapes(spark, tmp_path):
    shapes = [
        {"LocationID": 7},
        {"location_id": "8.0"},
        {"LocationID": "", "OBJECTID": 9.5},
        {"LocationID": 0, "objectid": "10"},
        {"LocationId": "A1"},
        {"name": "nowhere"},
        {"LocationID": "0", "objectid": 5},
        {"LocationID": " ", "objectid": 5},
        {"LocationID": "false"},
        {"LocationID": 0.00, "location_id": False, "objectid": 3},
        {"LocationID": "12d"},
        {"LocationID": None, "location_i": True},
        {"LocationID": {}, "objectid": 0},
        {"LocationID": " -3.9 "},
    ]
    document = {
        "type": "FeatureCollection",
        "features": [
            {"properties": p, "geometry": {"type": "Point", "coordinates": [1, 2]}} for p in shapes
        ],
    }
    path = tmp_path / "shapes.geojson"
    path.write_text(json.dumps(document, indent=1))
    keys = [r["map_id"] for r in readers.read_zone_shapes(spark, str(path)).collect()]
    assert keys[:6] == ["7", "8", "9", "10", "A1", None]
    assert keys[6:] == ["0", " ", "false", "3", "12d", "True", "0", "-3"]
    assert readers.read_zone_shapes(spark, str(tmp_path / "none.geojson")) is None


def test_report_is_one_row_and_reads_back(spark, tmp_path):
    table = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n long")
    report = writers.run_report(
        spark, months=["2025-01"], settings={"k": 2}, rows=table, total=table.agg(F.sum("n").alias("n"))
    )
    path = str(tmp_path / "report.json")
    writers.write_report(report, path)
    back = readers.read_report(spark, path)
    assert back.count() == 1
    assert as_dicts(readers.report_rows(back, "rows").orderBy("name")) == [
        {"n": 1, "name": "a"},
        {"n": 2, "name": "b"},
    ]
    assert back.select("settings.k").first()[0] == 2


def test_partitioned_write_is_idempotent(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 3).alias("day"), F.col("id"))
    path = str(tmp_path / "table")
    for _ in range(2):
        writers.write_table(df, path, partition_by=["day"], sort_within=["id"])
    back = spark.read.parquet(path)
    assert back.count() == 1000
    assert back.filter("day = 1").inputFiles() and back.select("id").distinct().count() == 1000


def test_raw_schema_matches_the_table(spark, small):
    from fareweather.plans.standin import Tables

    assert Tables(spark, small).raw.columns == schemas.RAW_TRIPS.fieldNames()
