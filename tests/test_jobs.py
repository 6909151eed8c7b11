import csv
import hashlib
import json
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sensorweave.plans import jobs
from sensorweave.schema import REPORT_COLUMNS, Settings
from sensorweave.sources.config import DEFAULTS, read_config
from sensorweave.sources.files import list_files, new_files, read_ledger
from sensorweave.sources.footers import inspect_files
from sensorweave.streaming.incremental import start_ingest

VALID = pd.DataFrame(
    {
        "sensor_id": ["sensor_1", "sensor_2", "sensor_3"],
        "timestamp": ["2025-06-05T10:00:00", "2025-06-05T11:00:00", "2025-06-05T12:00:00"],
        "reading_type": ["temperature", "humidity", "temperature"],
        "value": [25.5, 60.1, 27.3],
        "battery_level": [90.0, 85.0, 88.5],
    }
)


def corrupt_pages(path):
    """A file whose footer is fine and whose only data page is not."""
    data = bytearray(path.read_bytes())
    data[4:60] = bytes(56)
    path.write_bytes(bytes(data))


@pytest.fixture
def settings(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    VALID.to_parquet(raw / "2025-06-05_valid.parquet", index=False)
    VALID.drop(columns=["battery_level"]).to_parquet(raw / "2025-06-05_missing_col.parquet", index=False)
    outlier = VALID.copy()
    outlier.loc[1, "value"] = 999
    outlier.to_parquet(raw / "2025-06-05_outlier.parquet", index=False)
    pd.concat([VALID, VALID.iloc[[0]]]).to_parquet(raw / "2025-06-05_duplicates.parquet")
    nulls = VALID.copy()
    nulls.loc[0, "sensor_id"], nulls.loc[1, "timestamp"], nulls.loc[2, "value"] = None, None, None
    nulls.to_parquet(raw / "2025-06-05_nulls.parquet", index=False)
    VALID.astype({"value": str}).to_parquet(raw / "2025-06-05_text.parquet", index=False)
    VALID.astype({"value": "float32"}).to_parquet(raw / "2025-06-05_float.parquet", index=False)
    VALID.iloc[:0].astype({c: str for c in VALID.columns[:3]}).to_parquet(raw / "2025-06-05_empty.parquet", index=False)
    (raw / "2025-06-05_corrupt.parquet").write_bytes(b"this is not parquet")
    pq.write_table(pa.Table.from_pandas(VALID, preserve_index=False), raw / "2025-06-05_pages.parquet", compression="none")
    corrupt_pages(raw / "2025-06-05_pages.parquet")
    (raw / "notes.txt").write_text("ignored")
    config = tmp_path / "config.json"
    config.write_text(json.dumps(DEFAULTS))
    names = {n: str(tmp_path / n) for n in ["raw", "processed", "quarantine", "transformed", "analytics", "state", "metadata"]}
    return Settings(config=str(config), **names)


STATUS = {
    "2025-06-05_valid.parquet": ("success", 3, None),
    "2025-06-05_outlier.parquet": ("success", 3, None),
    "2025-06-05_duplicates.parquet": ("success", 4, None),
    "2025-06-05_float.parquet": ("success", 3, None),
    "2025-06-05_empty.parquet": ("success", 0, None),
    "2025-06-05_nulls.parquet": ("dq_warning", 3, "missing sensor:1, ts:1, value:1"),
    "2025-06-05_missing_col.parquet": ("schema_mismatch", 0, "missing:['battery_level']"),
    "2025-06-05_text.parquet": ("profiling_error", 0, "not numeric: value"),
    "2025-06-05_corrupt.parquet": ("schema_error", 0, ...),
    "2025-06-05_pages.parquet": ("read_error", 0, ...),
}
REJECTED = {n for n, (s, _, _) in STATUS.items() if s not in ("success", "dq_warning")}


def check_ledger(spark, settings):
    ledger = {r["filename"]: r for r in read_ledger(spark, settings.ledger).collect()}
    assert set(ledger) == set(STATUS)
    for name, (status, rows, error) in STATUS.items():
        row = ledger[name]
        assert (row["status"], row["rows"]) == (status, rows), name
        assert row["error"] if error is ... else row["error"] == error
        assert row["checksum"] == hashlib.md5((Path(settings.raw) / name).read_bytes()).hexdigest()
        assert row["processed_at"].endswith("Z") and row["duration_sec"] >= 0


def test_inspection(spark, settings):
    got = {r["file_name"]: r for r in inspect_files(list_files(spark, settings.raw)).collect()}
    assert set(got) == set(STATUS)
    assert got["2025-06-05_duplicates.parquet"]["extra"] == ["__index_level_0__"]
    assert got["2025-06-05_missing_col.parquet"]["missing"] == ["battery_level"]
    assert got["2025-06-05_float.parquet"]["types"]["value"] == "float"
    assert got["2025-06-05_corrupt.parquet"]["schema_error"]
    assert got["2025-06-05_pages.parquet"]["read_error"] and not got["2025-06-05_pages.parquet"]["schema_error"]
    assert got["2025-06-05_valid.parquet"]["read_error"] is None
    unchecked = inspect_files(list_files(spark, settings.raw), verify_pages=False)
    assert unchecked.where("read_error IS NOT NULL").isEmpty()


def test_ingest(spark, settings):
    result = jobs.ingest(spark, settings)
    check_ledger(spark, settings)

    rows = spark.read.parquet(settings.processed)
    assert rows.count() == 16
    assert rows.where("file_name = '2025-06-05_duplicates_processed.parquet'").count() == 4
    assert {"__index_level_0__", "row_index"} <= set(rows.columns)
    assert dict(rows.dtypes)["value"] == "double"

    quarantine = {r["filename"]: r for r in spark.read.parquet(settings.quarantine).collect()}
    assert set(quarantine) == REJECTED
    for name, row in quarantine.items():
        assert bytes(row["content"]) == (Path(settings.raw) / name).read_bytes()
        assert row["status"] == STATUS[name][0]

    profiles = {r["file_name"]: r for r in spark.read.json(settings.profiles).collect()}
    assert set(profiles) == set(STATUS) - REJECTED
    assert profiles["2025-06-05_outlier.parquet"]["outlier_counts"]["value_out_of_range"] == 1.0
    assert profiles["2025-06-05_empty.parquet"]["missing_data_ratio"]["value_missing_ratio"] is None

    log = spark.read.option("header", True).csv(settings.ingest_log)
    assert log.columns == ["filename", "checksum", "rows", "status", "error", "duration_sec", "timestamp"]
    assert log.count() == len(STATUS)
    assert result.quarantine.count() == len(REJECTED)

    assert jobs.ingest(spark, settings) is None
    VALID.to_parquet(Path(settings.raw) / "2025-06-06.parquet", index=False)
    later = jobs.ingest(spark, settings)
    assert later.processed.count() == 3
    assert spark.read.parquet(settings.processed).count() == 19
    assert read_ledger(spark, settings.ledger).count() == len(STATUS) + 1


def test_retry_and_checksum_options(spark, settings):
    jobs.ingest(spark, settings)
    files, ledger = list_files(spark, settings.raw), read_ledger(spark, settings.ledger)
    assert new_files(files, ledger).isEmpty()
    assert {r["filename"] for r in new_files(files, ledger, retry_failed=True).collect()} == REJECTED
    fixed = Path(settings.raw) / "2025-06-05_missing_col.parquet"
    VALID.to_parquet(fixed, index=False)
    jobs.ingest(spark, settings, key="checksum")
    row = read_ledger(spark, settings.ledger).where("filename = '2025-06-05_missing_col.parquet'").collect()
    assert [(r["status"], r["rows"]) for r in row] == [("success", 3)]


def test_repeating_a_batch_changes_nothing(spark, settings):
    files = list_files(spark, settings.raw)
    for _ in range(2):
        jobs.ingest_files(spark, files, settings)
    assert spark.read.parquet(settings.processed).count() == 16
    assert spark.read.parquet(settings.quarantine).count() == len(REJECTED)
    assert read_ledger(spark, settings.ledger).count() == len(STATUS)


def test_only_bad_files(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "x.parquet").write_bytes(b"no")
    names = {n: str(tmp_path / n) for n in ["raw", "processed", "quarantine", "state", "metadata"]}
    result = jobs.ingest(spark, Settings(**names))
    assert result.processed is None and result.quarantine.count() == 1


def test_run_all(spark, settings):
    report = {r["file_name"]: r for r in jobs.run_all(spark, settings).collect()}
    transformed = spark.read.parquet(settings.transformed)
    with_rows = {r["file_name"] for r in transformed.select("file_name").distinct().collect()}
    assert set(report) == with_rows | {"2025-06-05_empty_transformed.parquet"}  # every accepted file has a row
    assert report["2025-06-05_valid_transformed.parquet"]["total_records"] == 3

    by_file = {}
    for r in transformed.orderBy("row_index").collect():
        by_file.setdefault(r["file_name"].removesuffix("_transformed.parquet"), []).append(r)
    assert [r["value"] for r in by_file["2025-06-05_valid"]] == pytest.approx([26.51, 59.198, 28.346])
    assert len(by_file["2025-06-05_duplicates"]) == 3
    humid = by_file["2025-06-05_outlier"][1]
    assert humid["value"] == pytest.approx(98.3) and humid["anomalous_reading"] is False
    assert humid["timestamp_ist"] == "2025-06-05T16:30:00" and str(humid["date"]) == "2025-06-05"
    expected = {"timestamp_ist", "date", "daily_avg", "rolling_7d_avg", "anomalous_reading"}
    assert expected <= set(transformed.columns)

    (csv_file,) = Path(settings.report).glob("*.csv")
    with open(csv_file) as f:
        lines = list(csv.reader(f))
    assert lines[0] == REPORT_COLUMNS and len(lines) == len(report) + 1

    root = Path(settings.analytics)
    assert list(root.glob("date=2025-06-05/sensor_id=sensor_1/*.parquet"))
    count = spark.read.parquet(settings.analytics).count()
    assert count == transformed.count()
    jobs.run_all(spark, settings)
    assert spark.read.parquet(settings.analytics).count() == count


def test_stages_without_input(spark, tmp_path):
    names = {n: str(tmp_path / n) for n in ["raw", "processed", "transformed", "analytics", "state", "metadata"]}
    (tmp_path / "raw").mkdir()
    settings = Settings(**names)
    assert jobs.ingest(spark, settings) is None
    assert jobs.transform_files(spark, settings) is None
    assert jobs.validate_files(spark, settings) is None
    assert jobs.load_files(spark, settings) is False


def test_streaming_ingest(spark, settings):
    start_ingest(spark, settings, max_files=4).awaitTermination()
    check_ledger(spark, settings)
    assert spark.read.parquet(settings.processed).count() == 16
    VALID.to_parquet(Path(settings.raw) / "2025-06-06.parquet", index=False)
    start_ingest(spark, settings, max_files=4).awaitTermination()
    assert spark.read.parquet(settings.processed).count() == 19
    assert read_ledger(spark, settings.ledger).count() == len(STATUS) + 1


LOADED = "sensor_id string, timestamp string, reading_type string, value double, battery_level double, file_name string"


def test_load(spark, tmp_path):
    rows = [("s1", "2025-06-05T10:00:00", "temperature", 25.5, 90.0, "a"), ("s2", "2025-06-05T11:00:00", "humidity", 40.1, 80.0, "a"), ("s2", "bad", "humidity", 1.0, 80.0, "a")]
    path = str(tmp_path / "analytics")
    df = spark.createDataFrame(rows, LOADED)
    jobs.load(df, path)
    files = [f for s in ("s1", "s2") for f in Path(path).glob(f"date=2025-06-05/sensor_id={s}/*.parquet")]
    assert len(files) == 2
    assert list(Path(path).glob("date=__HIVE_DEFAULT_PARTITION__/sensor_id=s2/*.parquet"))
    stored = pq.ParquetFile(files[0])
    assert stored.metadata.row_group(0).column(0).compression == "SNAPPY"
    assert {"timestamp", "value", "reading_type", "battery_level"} <= set(stored.schema.names)
    assert dict(spark.read.parquet(path).dtypes)["timestamp"] == "timestamp_ntz"
    jobs.load(df, path)
    assert spark.read.parquet(path).count() == 6
    jobs.load(df, path, mode="replace_partitions")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        jobs.load(df, path, mode="merge")


def test_load_without_times(spark, tmp_path):
    df = spark.createDataFrame([("s1", "2025-06-05T10:00:00", "t", 1.0, 1.0, "a"), ("s1", None, "t", 2.0, 1.0, "b")], LOADED)
    jobs.load(df.drop("timestamp"), str(tmp_path / "x"))
    assert [p.name for p in (tmp_path / "x").glob("date=*")] == ["date=unknown"]
    without = spark.createDataFrame([("b",)], "file_name string")
    jobs.load(df, str(tmp_path / "y"), files_without_time=without)
    assert {p.name for p in (tmp_path / "y").glob("date=*")} == {"date=unknown", "date=2025-06-05"}


def test_config(spark, settings, tmp_path):
    assert read_config(spark, settings.config).count() == 5
    sparse = tmp_path / "sparse.json"
    sparse.write_text('{"a": {"min": 1}, "b": {"calibration": {"offset": 2}}}')
    rows = {r["reading_type"]: tuple(r)[1:] for r in read_config(spark, str(sparse)).collect()}
    assert rows == {"a": (1.0, None, 1.0, 0.0), "b": (None, None, 1.0, 2.0)}
    assert read_config(spark, str(tmp_path / "none.json"), required=False).isEmpty()
    with pytest.raises(Exception):
        read_config(spark, str(tmp_path / "none.json"))


def test_settings_follow_the_environment(monkeypatch):
    monkeypatch.setenv("RAW_DATA_PATH", "/somewhere")
    assert Settings().raw == "/somewhere" and Settings().analytics == "data/analytics"


ODD_NAMES = ["a b.parquet", "50%.parquet", "a#b.parquet", "a?b.parquet", "a%20b.parquet", "a+b.parquet", "x[1].parquet"]


def test_odd_names_columns_and_times(spark, settings):
    raw = Path(settings.raw)
    for name in ODD_NAMES:
        VALID.to_parquet(raw / name, index=False)
    VALID.assign(file_name="mine", row_index=7).to_parquet(raw / "extras.parquet", index=False)
    VALID.assign(Value=1.0).to_parquet(raw / "case.parquet", index=False)
    times = pd.to_datetime(VALID["timestamp"]) + pd.to_timedelta([0.1, 0.5, 0.9], unit="s")
    same = VALID.assign(sensor_id="s", reading_type="humidity", timestamp=times.dt.floor("D") + pd.to_timedelta([0.1, 0.5, 0.9], unit="s"))
    pq.write_table(pa.Table.from_pandas(same, preserve_index=False), raw / "nanos.parquet")
    assert "ns" in str(pq.read_schema(raw / "nanos.parquet").field("timestamp").type)

    report = jobs.run_all(spark, settings)
    ledger = {r["filename"]: (r["status"], r["rows"]) for r in read_ledger(spark, settings.ledger).collect()}
    for name in [*ODD_NAMES, "extras.parquet", "nanos.parquet"]:
        assert ledger[name] == ("success", 3), name
    assert ledger["case.parquet"][0] == "schema_mismatch"

    rows = {r["file_name"]: r for r in report.collect()}
    accepted = [n for n, (status, _) in ledger.items() if status in ("success", "dq_warning")]
    assert rows.keys() == {n.removesuffix(".parquet") + "_transformed.parquet" for n in accepted}
    assert rows["2025-06-05_float_transformed.parquet"]["invalid_value_type"] == 3
    assert rows["2025-06-05_empty_transformed.parquet"]["total_records"] == 0
    assert rows["nanos_transformed.parquet"]["total_records"] == 3  # readings within one second are not copies


def test_data_of_replaced_files_is_not_used(spark, settings):
    """By checksum: a file replaced by an empty one, and one that lacks a column now."""
    raw = Path(settings.raw)
    jobs.run_all(spark, settings)
    VALID.iloc[:0].astype({c: str for c in VALID.columns[:3]}).to_parquet(raw / "2025-06-05_valid.parquet", index=False)
    VALID.drop(columns=["value"]).to_parquet(raw / "2025-06-05_outlier.parquet", index=False)
    jobs.ingest(spark, settings, key="checksum")
    names = {r["file_name"] for r in jobs.transform_files(spark, settings).select("file_name").distinct().collect()}
    assert "2025-06-05_duplicates_transformed.parquet" in names
    assert not names & {"2025-06-05_valid_transformed.parquet", "2025-06-05_outlier_transformed.parquet"}


def test_type_called_null_beside_none(spark, readings, config):
    from sensorweave.operators.validate import quality_report

    rows = readings([("s", "2025-06-05T10:00:00", t, v, 1.0) for t, v in [("null", 1.0), ("null", None), (None, None)]])
    row = quality_report(rows, config).first()
    assert json.loads(row["missing_%"]) == {"null": 66.67} and row["total_records"] == 3


def test_null_types_under_every_layout(readings):
    from sensorweave.operators import clean
    from sensorweave.operators.layout import Limits, measure

    rows = [("s", f"2025-06-05T10:00:{n:02d}", None, v, 1.0) for n, v in enumerate([1.0] * 10 + [1e6])]
    gaps = [("s", "2025-06-05T10:00:00", None, 2.0, 1.0), ("s", "2025-06-05T11:00:00", None, None, 1.0)]
    for limits in (Limits(), Limits(group_rows=2), Limits(group_rows=2, broadcast_rows=0, salts=3)):
        frame = readings(rows)
        fixed = clean.correct_outliers(frame, measure(frame, limits)).collect()
        assert {r["value"] for r in fixed} == {1.0}
        frame = readings(gaps * 3)
        filled = clean.impute_mean(frame, measure(frame, limits), by_type=True).collect()
        assert {r["value"] for r in filled} == {2.0}


def test_partitions_are_bounded():
    from sensorweave.session import MOST_PARTITIONS, partitions_for

    assert partitions_for(10**9, 8) == 8 and partitions_for(10**14, 8) == MOST_PARTITIONS


def test_no_local_folder_on_a_cluster():
    from sensorweave.session import staging_root

    class Away:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        staging_root(Away)


def test_workers_need_no_copy_of_the_package(settings, tmp_path):
    """Ingest from another working folder, the package on the driver's path only."""
    import os
    import subprocess
    import sys

    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from sensorweave.session import build_session
from sensorweave.schema import Settings
from sensorweave.plans import jobs
spark = build_session("away", "local[2]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path / "staging")!r}}})
result = jobs.ingest(spark, Settings(**{settings.__dict__!r}))
print("ROWS", result.ledger.count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS 10" in done.stdout, done.stderr[-2000:]


def test_analytics_by_day_alone(spark, readings, tmp_path):
    rows = readings([(f"s{n}", f"2025-06-0{1 + n % 3}T10:00:00", "humidity", float(n), 1.0) for n in range(9)])
    path = str(tmp_path / "by_day")
    jobs.load(rows, path, partition_by=("date",))
    assert sorted(p.name for p in Path(path).glob("date=*")) == ["date=2025-06-01", "date=2025-06-02", "date=2025-06-03"]
    assert not list(Path(path).glob("date=*/sensor_id=*"))
    back = spark.read.parquet(path)
    assert back.count() == 9 and back.where("sensor_id = 's4'").first()["value"] == 4.0


def test_many_small_folders_are_written_by_many_tasks(spark, tmp_path):
    from sensorweave.sinks import tables

    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    rows = spark.range(450).selectExpr("'2025-06-05' AS date", "concat('s', id) AS sensor_id", "id AS value").coalesce(1)
    tables.write_analytics(rows, str(tmp_path), "replace_partitions")
    files = [p for p in tmp_path.rglob("*.parquet")]
    assert len(files) == 450
    assert len({p.name.split("-")[1] for p in files}) >= 3
    assert spark.read.parquet(str(tmp_path)).agg({"value": "sum"}).first()[0] == 449 * 450 // 2
    assert [spark.conf.get(n) for n in names] == before
