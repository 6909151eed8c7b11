"""Partitioned writes of many folders: by tasks, with the same outcome as Spark's own writer."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sensorweave.sinks import folders as many
from sensorweave.sinks import tables

ODD = ["a/b", "x=y", "50%", "ü ö", "a:b*?", "q'\"", "back\\slash", "{z}[1]^", "tab\t", "", None, "+", "%2F"]


def rows_of(spark, count, value="id"):
    names = F.array(*[F.lit(n) for n in ODD])
    sensor = F.when(F.col("id") < len(ODD), names[F.col("id").cast("int")]).otherwise(F.concat(F.lit("s"), "id"))
    return spark.range(count).select(
        F.when(F.col("id") % 3 > 0, F.lit("2025-06-05")).alias("date"),
        sensor.alias("sensor_id"),
        F.expr(value).alias("value"),
        F.expr("if(id % 2 = 0, concat('t', id), null)").alias("text"),
        F.expr("timestamp_micros(id * 1000001)").alias("moment"),
        F.expr("cast(timestamp_micros(id) as timestamp_ntz)").alias("timestamp"),
        F.expr("date_add(date'1500-01-01', cast(id as int))").alias("day"),
        F.expr("cast(id / 3 as decimal(20, 4))").alias("price"),
        F.expr("cast(id as float) / 7").alias("single"),
        F.expr("cast(id % 100 as tinyint)").alias("tiny"),
        F.expr("cast(concat('b', id) as binary)").alias("bytes"),
        F.expr("id % 5 = 0").alias("flag"),
    )


def places(path):
    return sorted({str(p.parent.relative_to(path)) for p in Path(path).rglob("*.parquet")})


def made_by(path):
    return {pq.ParquetFile(p).metadata.created_by.split()[0] for p in Path(path).rglob("*.parquet")}


def content(spark, path):
    found = spark.read.parquet(str(path))
    return found.schema, sorted(map(str, found.select(sorted(found.columns)).collect()))


@pytest.mark.parametrize("mode", ["append", "replace_partitions"])
def test_many_folders_are_those_of_sparks_writer(spark, tmp_path, mode):
    rows = rows_of(spark, 320).unionByName(rows_of(spark, 40, "-id"))
    own, sparks = tmp_path / "a [1]", tmp_path / "b"
    tables.write_analytics(rows, str(own), mode)
    rows.write.partitionBy("date", "sensor_id").parquet(str(sparks))
    assert made_by(own) == {"parquet-cpp-arrow"}  # Spark's writer starts processes for each file on a local disk
    assert places(own) == places(sparks) and len(places(own)) > 300
    assert not [p.name for p in own.iterdir() if not p.name.startswith("date=")]
    literal = str(own).replace("[", "\\[").replace("]", "\\]")
    assert content(spark, literal) == content(spark, sparks)


def test_folders_are_replaced_and_others_stay(spark, tmp_path):
    tables.write_analytics(rows_of(spark, 400), str(tmp_path), "append")
    tables.write_analytics(rows_of(spark, 400), str(tmp_path), "append")
    assert spark.read.parquet(str(tmp_path)).count() == 800
    rows_of(spark, 1).write.mode("append").partitionBy("date", "sensor_id").parquet(str(tmp_path))  # with hidden files
    tables.write_analytics(rows_of(spark, 300, "-id"), str(tmp_path), "replace_partitions")
    found = spark.read.parquet(str(tmp_path))
    assert found.where("value >= 300").count() == 200  # a hundred left alone, twice
    assert found.where("value <= 0").count() == 300 and found.count() == 500
    assert not list(tmp_path.glob("date=*/sensor_id=*/.*"))


def test_days_alone_are_sorted_by_sensor(spark, tmp_path):
    rows = rows_of(spark, 900).withColumn("date", F.concat(F.lit("d"), F.col("value") % 300))
    tables.write_analytics(rows, str(tmp_path), "replace_partitions", partition_by=("date",))
    assert made_by(tmp_path) == {"parquet-cpp-arrow"} and len(places(tmp_path)) == 300
    for path in tmp_path.rglob("*.parquet"):
        sensors = [s or "" for s in pq.ParquetFile(path).read()["sensor_id"].to_pylist()]
        assert sensors == sorted(sensors) and len(sensors) == 3


def test_large_folders_have_several_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(many, "GROUP_BYTES", 20_000)
    rows = spark.range(30_000).selectExpr("if(id < 20000, 'big', concat('s', id % 250)) AS sensor_id", "'d' AS date", "id")
    tables.write_analytics(rows, str(tmp_path), "replace_partitions")
    files = list(tmp_path.glob("date=d/sensor_id=big/*.parquet"))
    assert len(files) == 1 and pq.ParquetFile(files[0]).num_row_groups > 1
    assert spark.read.parquet(str(tmp_path)).agg(F.count("id"), F.count_distinct("id")).first()[:] == (30_000, 30_000)


def test_a_write_that_fails_replaces_nothing(spark, tmp_path):
    tables.write_analytics(rows_of(spark, 300), str(tmp_path), "replace_partitions")
    before = sorted(map(str, tmp_path.rglob("*")))
    bad = rows_of(spark, 300).withColumn("sensor_id", F.when(F.col("value") == 299, "a\u0000b").otherwise(F.col("sensor_id")))
    with pytest.raises(Exception, match="NUL"):
        tables.write_analytics(bad, str(tmp_path), "replace_partitions")
    assert sorted(map(str, tmp_path.rglob("*"))) == before


def test_files_may_be_put_in_place_twice(spark, tmp_path):
    staged = tmp_path / "staged"
    staged.mkdir()
    listed = [(str(staged / str(n)), f"date=d/sensor_id={n}", f"part-0-run.c{n}.parquet") for n in range(3)]
    for file, _, _ in listed:
        Path(file).write_text("rows")
    old = tmp_path / "table/date=d/sensor_id=1/old.parquet"
    old.parent.mkdir(parents=True)
    old.write_text("before")
    files = spark.createDataFrame(listed, many.FILE)
    for _ in range(2):
        many._put_in_place(files, str(tmp_path / "table"), "run", True)
    found = sorted(str(p.relative_to(tmp_path / "table")) for p in (tmp_path / "table").rglob("*.parquet"))
    assert found == [f"{folder}/{name}" for _, folder, name in listed]
    lost = spark.createDataFrame([(str(staged / "9"), "date=d/sensor_id=9", "part-0-run.c9.parquet")], many.FILE)
    with pytest.raises(Exception, match="No such file|does not exist|Failed"):
        many._put_in_place(lost, str(tmp_path / "table"), "run", True)


def test_other_types_are_left_to_sparks_writer(spark, tmp_path):
    rows = rows_of(spark, 300).withColumn("list", F.array("value"))
    tables.write_analytics(rows, str(tmp_path), "replace_partitions")
    assert made_by(tmp_path) == {"parquet-mr"}
    assert spark.read.parquet(str(tmp_path)).where("list[0] = value").count() == 300
