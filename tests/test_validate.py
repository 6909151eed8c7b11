import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorweave.operators import profile as p
from sensorweave.operators import validate as v
from sensorweave.operators.status import row_null_status

T10 = "2025-06-05T10:00:00"
VALID = [
    ("sensor_1", "2025-06-05T10:00:00", "temperature", 25.5, 90.0),
    ("sensor_2", "2025-06-05T11:00:00", "humidity", 60.1, 85.0),
    ("sensor_3", "2025-06-05T12:00:00", "temperature", 27.3, 88.5),
]


def entry(kind, n, values, batteries):
    names = ["avg_value", "min_value", "max_value", "avg_battery", "min_battery", "max_battery"]
    return {"reading_type": kind, "record_count": n, **dict(zip(names, [*values, *batteries]))}


HUMIDITY = entry("humidity", 1, (60.1, 60.1, 60.1), (85.0, 85.0, 85.0))


@pytest.mark.parametrize(
    "rows, temperature, humidity, bad",
    [
        (VALID, entry("temperature", 2, (26.4, 25.5, 27.3), (89.25, 88.5, 90.0)), HUMIDITY, 0.0),
        (VALID + VALID[:1], entry("temperature", 3, (26.1, 25.5, 27.3), (89.5, 88.5, 90.0)), HUMIDITY, 0.0),
        (
            [VALID[0], (*VALID[1][:3], 999.0, 85.0), VALID[2]],
            entry("temperature", 2, (26.4, 25.5, 27.3), (89.25, 88.5, 90.0)),
            entry("humidity", 1, (999.0, 999.0, 999.0), (85.0, 85.0, 85.0)),
            1.0,
        ),
    ],
    ids=["valid", "duplicates", "outlier"],
)
def test_profile_of_known_files(readings, rows, temperature, humidity, bad):
    (document,) = p.profile(readings(rows)).collect()
    document = document.asDict(recursive=True)
    assert document["reading_summary"] == [humidity, temperature]
    assert set(document["missing_data_ratio"].values()) == {0.0}
    assert document["distinct_counts"] == {"distinct_sensors": 3, "distinct_reading_types": 2}
    assert document["outlier_counts"] == {"value_out_of_range": bad, "battery_out_of_range": 0.0}


def test_profile_counts_sensors_once_and_keeps_the_null_type(readings):
    rows = [("a", T10, "t", 1.0, None), ("a", T10, "h", None, None), ("b", None, None, 101.0, None), (None, T10, "t", -1.0, None)]
    document = p.profile(readings(rows)).first().asDict(recursive=True)
    assert document["distinct_counts"] == {"distinct_sensors": 2, "distinct_reading_types": 2}
    assert [e["reading_type"] for e in document["reading_summary"]] == [None, "h", "t"]
    assert document["missing_data_ratio"] == {
        "sensor_id_missing_ratio": 0.25,
        "timestamp_missing_ratio": 0.25,
        "reading_type_missing_ratio": 0.25,
        "value_missing_ratio": 0.25,
        "battery_missing_ratio": 1.0,
    }
    assert document["outlier_counts"] == {"value_out_of_range": 2.0, "battery_out_of_range": None}


def test_profile_of_an_empty_file(spark, readings):
    files = spark.createDataFrame([("a.parquet",), ("empty.parquet",)], "file_name string")
    rows = {r["file_name"]: r.asDict(recursive=True) for r in p.profile(readings(VALID), files).collect()}
    empty = rows["empty.parquet"]
    assert empty["reading_summary"] == []
    assert set(empty["missing_data_ratio"].values()) == {None}
    assert empty["distinct_counts"] == {"distinct_sensors": 0, "distinct_reading_types": 0}
    assert rows["a.parquet"]["distinct_counts"]["distinct_sensors"] == 3


def test_status(readings):
    rows = [(None, T10, "t", 1.0, 1.0), ("s", None, "t", float("nan"), 1.0), ("s", T10, None, 1.0, None)]
    both = readings(rows, "bad.parquet").unionByName(readings(VALID, "good.parquet"))
    got = {r["file_name"]: (r["rows"], r["status"], r["error"]) for r in row_null_status(both).collect()}
    assert got["bad.parquet"] == (3, "dq_warning", "missing sensor:1, ts:1, value:1")
    assert got["good.parquet"] == (3, "success", None)


def at(clock):
    return f"2025-06-05T{clock}:00"


GAPS = [("s1", at("10:00")), ("s1", at("11:00")), ("s1", at("14:00")), ("s2", at("10:00")), ("s2", at("11:30")), ("s3", at("09:00"))]


def rows_at(times):
    return [(s, t, "temperature", 20.0, 90.0) for s, t in times]


def test_gaps(readings):
    df = readings(rows_at(GAPS))
    per_sensor = {r["sensor_id"]: r["missing_hours"] for r in v.hourly_gaps(df).collect()}
    assert per_sensor == {"s1": 2, "s2": 1}
    assert v.gap_totals(df).collect() == [("a.parquet", 2, 3)]
    hours = {(r["sensor_id"], r["expected_ts"].isoformat()) for r in v.missing_hours(df).collect()}
    assert hours == {("s1", at("12:00")), ("s1", at("13:00")), ("s2", at("11:00"))}


def test_no_gaps_is_zero(readings):
    df = readings(rows_at([("s1", at("10:00")), ("s1", at("11:00")), ("s2", "bad")]))
    assert v.gap_totals(df).collect() == [("a.parquet", 0, 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_gap_count_equals_the_anti_join(readings, seed):
    rng = random.Random(seed)
    start = datetime(2025, 6, 5)
    rows = []
    for _ in range(300):
        when = start + timedelta(hours=rng.randrange(72), minutes=rng.choice([0, 0, 0, 15, 30]))
        rows.append((rng.choice([None, "a", "b", "c", "d"]), when.strftime("%Y-%m-%dT%H:%M:%S")))
    df = readings(rows_at(rows))
    listed = v.missing_hours(df).groupBy("sensor_id").agg(F.count(F.lit(1)).alias("n")).collect()
    counted = v.hourly_gaps(df).where("missing_hours > 0").collect()
    assert {(r["sensor_id"], r["n"]) for r in listed} == {(r["sensor_id"], r["missing_hours"]) for r in counted}


def test_report(spark, readings, config):
    rows = rows_at(GAPS) + [("s9", at("10:00"), "temperature", 51.0, 1.0), ("s9", "06/05/2025 10:00 AM", "co2", 5000.0, 1.0)]
    rows += [("s9", at("10:00"), "temperature", None, 1.0), ("s9", at("10:00"), None, 1.0, 1.0)]
    footers = spark.createDataFrame(
        [("a.parquet", {"value": "double"}, None), ("empty.parquet", {"value": "float"}, None), ("bad.parquet", None, "broken")],
        "file_name string, types map<string,string>, error string",
    )
    got = {r["file_name"]: r.asDict() for r in v.quality_report(readings(rows), config, footers).collect()}
    full = got["a.parquet"]
    assert (full["total_records"], full["invalid_value_type"], full["invalid_timestamp"]) == (10, 0, 1)
    assert json.loads(full["outlier_%"]) == {"temperature": 12.5, "co2": 0.0}
    assert json.loads(full["missing_%"]) == {"temperature": 12.5, "co2": 0.0, "null": 0.0}
    assert (full["sensors_with_gaps"], full["total_missing_hours"], full["error"]) == (2, 3, None)
    empty = got["empty.parquet"]
    assert (empty["total_records"], empty["outlier_%"], empty["total_missing_hours"]) == (0, "{}", 0)
    assert got["bad.parquet"]["error"] == "broken" and got["bad.parquet"]["total_records"] is None
    alone = v.quality_report(readings(rows), config).drop("error").collect()
    assert [r.asDict() for r in alone] == [{k: x for k, x in full.items() if k != "error"}]
    assert [r["file_name"] for r in v.gate(v.quality_report(readings(rows), config), "total_missing_hours > 5").collect()] == []


def test_wrong_value_type_counts_every_row(spark, readings):
    df = readings(VALID)
    footers = spark.createDataFrame([("a.parquet", {"value": "float"})], "file_name string, types map<string,string>")
    assert v.record_checks(df, footers).first()["invalid_value_type"] == 3
    assert v.record_checks(df).first()["invalid_value_type"] == 0
    assert v.record_checks(df.withColumn("value", F.col("value").cast("float"))).first()["invalid_value_type"] == 3
