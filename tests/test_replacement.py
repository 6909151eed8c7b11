"""Files that change: what an earlier version left is gone from every table."""

import os
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_jobs import VALID, settings  # noqa: F401

from sensorweave.plans import jobs
from sensorweave.schema import LEDGER
from sensorweave.sinks import quarantine, tables
from sensorweave.sinks.manifest import Manifest
from sensorweave.sources import journal
from sensorweave.sources.files import list_files, read_ledger
from sensorweave.sources.store import drop_partitions, partition_value


def raw(settings, name, frame):
    frame.to_parquet(Path(settings.raw) / name, index=False)


def at(day, frame=VALID):
    return frame.assign(timestamp=frame["timestamp"].str.replace("2025-06-05", day))


@pytest.fixture
def two(settings, tmp_path):  # noqa: F811
    """Files a and b of one day, and c of the next."""
    for path in Path(settings.raw).iterdir():
        path.rename(tmp_path / f"unused-{path.name}")
    raw(settings, "a.parquet", VALID)
    raw(settings, "b.parquet", VALID.assign(sensor_id=["sensor_2", "sensor_3", "sensor_9"]))
    raw(settings, "c.parquet", at("2025-06-06"))
    return settings


def rows_of(spark, settings):
    found = spark.read.option("mergeSchema", "true").parquet(settings.analytics)
    return sorted((r["file_name"], str(r["date"]), r["sensor_id"]) for r in found.collect())


def folders(settings):
    return sorted(str(p.relative_to(settings.analytics)) for p in Path(settings.analytics).glob("date=*/sensor_id=*"))


def check(spark, settings, report, expected):
    """``expected``: (file, day) of each current row's file; all tables hold just these."""
    found = rows_of(spark, settings)
    assert sorted({(f.removesuffix("_transformed.parquet"), d) for f, d, _ in found}) == sorted(expected)
    transformed = {r["file_name"] for r in spark.read.parquet(settings.transformed).select("file_name").distinct().collect()}
    assert transformed == {f"{f}_transformed.parquet" for f, _ in expected}
    assert folders(settings) == sorted({f"date={d}/sensor_id={s}" for _, d, s in found})
    totals = {r["file_name"]: r["total_records"] for r in report.collect()}
    for f, _ in expected:
        assert totals[f"{f}_transformed.parquet"] == sum(name == f"{f}_transformed.parquet" for name, _, _ in found)
    return totals


def stamps(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet") if p.is_file()}


def test_replaced_files_leave_nothing(spark, two):
    """Files lose all their valid times, move to another day, lack a column, have no rows, and are good again."""
    for name in ("d", "e"):
        raw(two, f"{name}.parquet", at("2025-06-08", VALID.assign(sensor_id=f"sensor_{name}")))
    report = jobs.run_all(spark, two, key="checksum")
    days = {"a": "2025-06-05", "b": "2025-06-05", "c": "2025-06-06", "d": "2025-06-08", "e": "2025-06-08"}
    check(spark, two, report, list(days.items()))
    transformed, analytics = stamps(two.transformed), stamps(two.analytics)

    raw(two, "a.parquet", VALID.assign(timestamp=["bad", "worse", "none"]))
    raw(two, "b.parquet", at("2025-07-01"))
    raw(two, "d.parquet", VALID.drop(columns=["value"]))
    raw(two, "e.parquet", VALID.iloc[:0].astype({c: str for c in VALID.columns[:3]}))
    report = jobs.run_all(spark, two, key="checksum")
    totals = check(spark, two, report, [("b", "2025-07-01"), ("c", "2025-06-06")])
    assert totals["a_transformed.parquet"] == totals["e_transformed.parquet"] == 0 and "d_transformed.parquet" not in totals
    processed = {r["file_name"] for r in spark.read.parquet(two.processed).select("file_name").distinct().collect()}
    assert processed == {f"{name}_processed.parquet" for name in "abc"}
    assert [r["filename"] for r in quarantine.read_quarantine(spark, two.quarantine).collect()] == ["d.parquet"]
    # What has not changed was not written again.
    same = {p for p, t in stamps(two.transformed).items() if transformed.get(p) == t}
    assert {p.parent.name for p in same} == {"file_name=c_transformed.parquet"}
    same = {p for p, t in stamps(two.analytics).items() if analytics.get(p) == t}
    assert {p.parent.parent.name for p in same} == {"date=2025-06-06"}

    manifest = Manifest(spark, two.manifest, "analytics")
    held = {(r["file_name"], *r["partition"]) for r in manifest.partitions().collect()}
    assert held == set(rows_of(spark, two))
    manifest.journal.compact(spark)
    assert {(r["file_name"], *r["partition"]) for r in manifest.partitions().collect()} == held
    assert manifest.changed(manifest.versions()).isEmpty()

    raw(two, "d.parquet", at("2025-06-06"))
    raw(two, "c.parquet", at("2025-06-07", VALID.iloc[:1]))
    report = jobs.run_all(spark, two, key="checksum")
    check(spark, two, report, [("b", "2025-07-01"), ("c", "2025-06-07"), ("d", "2025-06-06")])
    assert quarantine.read_quarantine(spark, two.quarantine).isEmpty()


def test_a_run_that_breaks_off_is_made_good(spark, two, monkeypatch):
    """The load stops after writing, the file changes once more, and the next run still clears what was written."""
    jobs.run_all(spark, two, key="checksum")
    raw(two, "b.parquet", at("2025-07-01"))
    write = tables.write_analytics

    def breaks(*args, **kwargs):
        write(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_analytics", breaks)
        with pytest.raises(RuntimeError):
            jobs.run_all(spark, two, key="checksum")
    assert list(Path(two.analytics).glob("date=2025-07-01/sensor_id=*"))
    raw(two, "b.parquet", at("2025-07-02"))
    report = jobs.run_all(spark, two, key="checksum")
    check(spark, two, report, [("a", "2025-06-05"), ("b", "2025-07-02"), ("c", "2025-06-06")])


def test_partition_folders(spark, tmp_path):
    names = ["a/b", "x=y", "50%", "ü ö", "a:b*?", "q'\"", "back\\slash", "{z}[1]^", "tab\t", "plain", "", None, "+", "%2F"]
    rows = spark.createDataFrame([(n, k) for k, n in enumerate(names)], "sensor_id string, k int").withColumn("date", F.lit("d"))
    path = str(tmp_path / "table")
    for n in range(0, len(names), 4):
        rows.write.mode("overwrite").partitionBy("date", "sensor_id").parquet(path)
        gone = rows.where(F.col("k").between(n, n + 3))
        values = F.array(F.col("date"), partition_value(F.col("sensor_id")))
        drop_partitions(spark, path, ["date", "sensor_id"], gone.select(values.alias("values")))
        left = {r["k"] for r in spark.read.schema("k int").option("recursiveFileLookup", "true").parquet(path).collect()}
        # Null and empty text are one folder.
        assert left == {k for k in range(len(names)) if not n <= k <= n + 3} - ({10, 11} if n in (8,) else set())
    drop_partitions(spark, str(tmp_path / "none"), ["date"], spark.createDataFrame([(["d"],)], "values array<string>"))


ENTRY = "filename string, checksum string, rows long, status string, error string, processed_at string, duration_sec double, batch long"


def entries(spark, *rows):
    made = spark.createDataFrame([(n, "c", r, "success", None, "t", 0.0, b) for n, r, b in rows], ENTRY)
    return made.select("*", F.lit(1).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modified"), F.col("batch").alias("seen"))


def shown(log, spark):
    return sorted((r["filename"], r["rows"]) for r in log.read(spark).collect())


def test_ledger_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(journal, "MOST_FILES", 5)
    log = journal.Journal(str(tmp_path / "ledger"), LEDGER, ("filename",), ("batch", "seen"))
    assert log.read(spark).isEmpty() and log.epoch(spark) == 0
    for batch in range(20):
        log.append(entries(spark, ("same", batch, batch), (f"f{batch % 3}", batch, batch)).coalesce(1))
        files = [p for p in Path(log.path).rglob("*.parquet") if p.is_file()]
        # Never more than the snapshot and one epoch, however many runs there were.
        assert len(files) <= 5 + 1 + 4
        assert ("same", batch) in shown(log, spark)
    assert log.epoch(spark) >= 3
    assert shown(log, spark) == [("f0", 18), ("f1", 19), ("f2", 17), ("same", 19)]


@pytest.mark.parametrize("broken", ["_snapshot", "_point", "_clear"])
def test_compaction_that_breaks_off(spark, tmp_path, monkeypatch, broken):
    log = journal.Journal(str(tmp_path / "ledger"), LEDGER, ("filename",), ("batch", "seen"))
    log.append(entries(spark, ("a", 1, 1), ("b", 2, 1)))
    log.append(entries(spark, ("a", 5, 2)))
    step = getattr(journal.Journal, broken)

    def breaks(self, *args):
        if broken == "_snapshot":
            step(self, *args)  # the snapshot is there, but nothing points to it
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(journal.Journal, broken, breaks)
        with pytest.raises(RuntimeError):
            log.compact(spark)
    assert shown(log, spark) == [("a", 5), ("b", 2)]
    log.append(entries(spark, ("b", 7, 3)))
    assert shown(log, spark) == [("a", 5), ("b", 7)]
    log.compact(spark)
    log.compact(spark)
    assert shown(log, spark) == [("a", 5), ("b", 7)]
    assert len({p.parent.name for p in Path(log.path).rglob("*.parquet") if p.is_file()}) == 1


def test_unchanged_files_are_not_opened(spark, two):
    jobs.ingest(spark, two, key="checksum")
    path = Path(two.raw) / "a.parquet"
    seen, data = path.stat(), path.read_bytes()
    # Other bytes, but length and time as before: whoever opened the file would notice.
    path.write_bytes(data[:-1] + bytes([data[-1] ^ 1]))
    os.utime(path, ns=(seen.st_atime_ns, seen.st_mtime_ns))
    assert jobs.ingest(spark, two, key="checksum") is None
    path.write_bytes(data)
    # The same bytes at another time: opened once, and then noted.
    os.utime(path, (1_700_000_000, 1_700_000_000))
    before = {r["filename"]: r for r in read_ledger(spark, two.ledger).collect()}
    assert jobs.ingest(spark, two, key="checksum") is None
    after = {r["filename"]: r for r in read_ledger(spark, two.ledger).collect()}
    assert after["a.parquet"]["seen"] > before["a.parquet"]["seen"] and after["a.parquet"]["batch"] == before["a.parquet"]["batch"]
    assert after["b.parquet"] == before["b.parquet"]
    path.write_bytes(data[:-1] + bytes([data[-1] ^ 1]))
    os.utime(path, (1_700_000_000, 1_700_000_000))
    assert jobs.ingest(spark, two, key="checksum") is None
    path.write_bytes(data)


def test_quarantine_keeps_files_of_any_size(spark, tmp_path, monkeypatch):
    sizes = {"empty.parquet": 0, "one.parquet": 1, "block.parquet": 1000, "blocks.parquet": 16_000, "more.parquet": 70_001}
    source = tmp_path / "source"
    source.mkdir()
    for name, size in sizes.items():
        (source / name).write_bytes(os.urandom(size))
    files = list_files(spark, str(source)).select(
        "path", F.col("filename").alias("file_name"), "length", F.lit("m").alias("checksum"), F.lit("bad").alias("status"), F.lit("e").alias("error")
    )
    # Spark's listing passes over files without bytes.
    files = files.unionByName(spark.createDataFrame([(f"file:{source}/empty.parquet", "empty.parquet", 0, "m", "bad", "e")], files.schema))
    path = str(tmp_path / "quarantine")
    for _ in range(2):
        quarantine.write_quarantine(files, path, block=1000)
    parts = quarantine.read_parts(spark, path)
    counts = {r["filename"]: r["count"] for r in parts.groupBy("filename").count().collect()}
    assert counts == {"empty.parquet": 1, "one.parquet": 1, "block.parquet": 1, "blocks.parquet": 16, "more.parquet": 71}
    restored = {r["filename"]: r for r in quarantine.restore(parts, str(tmp_path / "back")).collect()}
    import hashlib

    for name, size in sizes.items():
        data = (source / name).read_bytes()
        assert (tmp_path / "back" / name).read_bytes() == data
        assert (restored[name]["bytes"], restored[name]["md5"]) == (size, hashlib.md5(data).hexdigest())
    about = {r["filename"]: r for r in quarantine.read_quarantine(spark, path).collect()}
    assert {n: r["length"] for n, r in about.items()} == sizes
    quarantine.release(spark, spark.createDataFrame([("one.parquet",), ("more.parquet",)], "file_name string"), path)
    assert {r["filename"] for r in quarantine.read_quarantine(spark, path).collect()} == sizes.keys() - {"one.parquet", "more.parquet"}
    assert quarantine.read_quarantine(spark, str(tmp_path / "none")) is None


def test_files_that_only_spark_refuses(spark, two):
    """Arrow reads all of them; each gets a status, and the others are stored."""
    table = pa.Table.from_pandas(VALID, preserve_index=False)
    folder = Path(two.raw)
    pq.write_table(table.append_column("h", pa.array([1.0, 2.0, 3.0], pa.float32()).cast(pa.float16())), folder / "half.parquet")
    pq.write_table(table.append_column("w", pa.array([1, 2, 3], pa.decimal128(38, 0)).cast(pa.decimal256(60, 0))), folder / "wide.parquet")
    big = pa.Table.from_pandas(pd.concat([VALID] * 2000), preserve_index=False)
    pq.write_table(big, folder / "late.parquet", compression="none", row_group_size=1000, use_dictionary=False)
    data = bytearray((folder / "late.parquet").read_bytes())
    page = pq.read_metadata(folder / "late.parquet").row_group(3).column(2).data_page_offset
    data[page : page + 40] = bytes(40)
    (folder / "late.parquet").write_bytes(bytes(data))
    nanos = pa.Table.from_pandas(VALID.assign(timestamp=pd.to_datetime(VALID["timestamp"])), preserve_index=False)
    pq.write_table(nanos, folder / "nanos.parquet")
    name = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(name)
    jobs.ingest(spark, two)
    assert spark.conf.get(name) == before
    found = {r["filename"]: r for r in read_ledger(spark, two.ledger).collect()}
    for good in ("a.parquet", "b.parquet", "c.parquet", "nanos.parquet"):
        assert (found[good]["status"], found[good]["rows"]) == ("success", 3), good
    for bad in ("half.parquet", "wide.parquet", "late.parquet"):
        assert found[bad]["status"] == "read_error" and found[bad]["error"], bad
    assert spark.read.parquet(two.processed).count() == 12
    kept = {r["filename"] for r in quarantine.read_quarantine(spark, two.quarantine).collect()}
    assert kept == {"half.parquet", "wide.parquet", "late.parquet"}
    parts = quarantine.read_parts(spark, two.quarantine).where("part = 0 AND filename = 'late.parquet'").first()
    assert bytes(parts["content"]) == bytes(data)
