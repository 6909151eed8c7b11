"""Named queries that run whole jobs: the event table as daily files, taken in, changed, and taken in again."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.plans import jobs
from sensorweave.schema import Settings
from sensorweave.session import staging_root
from sensorweave.sinks import quarantine
from sensorweave.sources.config import DEFAULTS
from sensorweave.sources.events import read_events, with_damage, write_files
from sensorweave.sources.files import read_ledger
from sensorweave.streaming.incremental import start_ingest

BLOCK = 4096  # bytes of a quarantined block; small, as the daily files are
SHIFT = 40  # days by which replaced files move


def _settings(spark: SparkSession, name: str) -> Settings:
    """All folders below a scratch folder of their own, and the configuration as a JSON file."""
    root = f"{staging_root(spark)}/sensorweave/{name}-{uuid.uuid4().hex}"
    folders = ["raw", "processed", "quarantine", "transformed", "analytics", "state", "metadata"]
    config = f"{root}/config"
    spark.createDataFrame([(json.dumps(DEFAULTS),)], "value string").coalesce(1).write.text(config)
    return Settings(config=config, **{f: f"{root}/{f}" for f in folders})


def _ledger(spark: SparkSession, settings: Settings) -> DataFrame:
    """What the format reader says of a broken file differs from version to version, so it is left out."""
    error = F.when(F.col("status") != "schema_error", F.col("error"))
    ledger = read_ledger(spark, settings.ledger)
    return ledger.select("filename", "rows", "status", error.alias("error"), F.length("checksum").cast("long").alias("digits"))


def ingest_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Daily files, some of them damaged, taken in by one batch."""
    settings = _settings(spark, "ingest")
    write_files(read_events(spark, folder), settings.raw, with_damage)
    jobs.ingest(spark, settings)
    return _ledger(spark, settings)


def stream_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The same by a stream, in small batches; half of the files come after it was stopped and started again."""
    settings = _settings(spark, "stream")
    rows = read_events(spark, folder)
    odd = F.substring("file_name", 9, 2).cast("int") % 2 == 1
    for part in (rows.where(odd), rows.where(~odd)):
        write_files(part, settings.raw, with_damage)
        start_ingest(spark, settings, max_files=10).awaitTermination()
    return _ledger(spark, settings)


def quarantined_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected files, put together again from their blocks and compared with the ledger's checksums."""
    settings = _settings(spark, "quarantine")
    write_files(read_events(spark, folder), settings.raw, with_damage)
    result = jobs.ingest(spark, settings)
    quarantine.write_quarantine(result.quarantine, settings.quarantine, BLOCK)
    restored = quarantine.restore(quarantine.read_parts(spark, settings.quarantine))
    about = quarantine.read_quarantine(spark, settings.quarantine)
    ledger = read_ledger(spark, settings.ledger).select("filename", "checksum")
    met = about.join(restored.withColumnRenamed("md5", "own"), "filename").join(ledger, "filename")
    blocks = F.greatest(F.ceil(F.col("length") / BLOCK), F.lit(1))
    return met.select(
        "filename",
        "status",
        (F.col("bytes") == F.col("length")).alias("whole"),
        (F.col("parts") == blocks).alias("all_blocks"),
        ((F.col("own") == F.col("checksum")) & (F.col("md5") == F.col("checksum"))).alias("same_bytes"),
    )


def ingest_report(spark: SparkSession, folder: str) -> DataFrame:
    """The quality report of a whole run, with the types that the files themselves had."""
    settings = _settings(spark, "report")
    write_files(read_events(spark, folder), settings.raw, with_damage)
    report = jobs.run_all(spark, settings)
    return report.select(
        "file_name", "total_records", "invalid_value_type", "invalid_timestamp", "sensors_with_gaps", "total_missing_hours"
    )


def _moved(rows: DataFrame) -> DataFrame:
    """The rows of a file some days later, in the same file."""
    day = F.to_timestamp_ntz("timestamp")
    later = F.date_format(day + F.expr(f"INTERVAL '{SHIFT}' DAY"), "yyyy-MM-dd'T'HH:mm:ss")
    return rows.withColumn("timestamp", F.when(F.col("timestamp").rlike(r"^\d{4}-"), later).otherwise("moved"))


def reingest_current(spark: SparkSession, folder: str) -> DataFrame:
    """The analytics table after files were replaced: by other days, by bad times, by none, by rejected ones."""
    settings = _settings(spark, "reingest")
    rows = read_events(spark, folder, sensor="gateway")
    write_files(rows, settings.raw)
    jobs.run_all(spark, settings, key="checksum")

    digit = F.substring("file_name", 10, 1)
    changed = _moved(rows.where(digit == "3"))
    changed = changed.unionByName(rows.where(digit == "7").withColumn("timestamp", F.lit("gone")))
    changed = changed.unionByName(rows.where(digit.isin("5", "9"))).select(rows.columns)
    write_files(changed, settings.raw, lambda name: {"5": "empty", "9": "column"}.get(name[9:10]))
    report = jobs.run_all(spark, settings, key="checksum")
    stored = spark.read.option("mergeSchema", "true").parquet(settings.analytics)
    met = stored.join(report.select("file_name", F.col("total_records").alias("in_report")), "file_name")
    return met.select(
        "file_name",
        "sensor_id",
        F.col("date").cast("string").alias("date"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        "reading_type",
        "in_report",
    )


def load_unknown_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Transformed files of which some have no times: their rows are stored under an unknown day."""
    settings = _settings(spark, "unknown")
    rows = read_events(spark, folder, sensor="gateway")
    without = F.substring("file_name", 10, 1) == "4"
    rows.where(~without).write.partitionBy("file_name").parquet(settings.transformed)
    rows.where(without).drop("timestamp").write.mode("append").partitionBy("file_name").parquet(settings.transformed)
    jobs.load_files(spark, settings)
    stored = spark.read.option("mergeSchema", "true").parquet(settings.analytics)
    day = F.coalesce(F.col("date").cast("string"), F.lit("none"))
    return stored.groupBy("file_name", day.alias("day")).agg(F.count(F.lit(1)).alias("rows"), F.count("timestamp").alias("timed"))


JOB_QUERIES = [ingest_ledger, stream_ledger, quarantined_files, ingest_report, reingest_current, load_unknown_dates]
