"""Where job results are written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from sensorweave.functions.columns import clock
from sensorweave.schema import ACCEPTED, BATCH, REPORT_COLUMNS
from sensorweave.session import FOLDERS_PER_TASK, writes_sized_for
from sensorweave.sinks.folders import can_write, write_folders
from sensorweave.sources.files import ledger_journal
from sensorweave.sources.journal import Journal


def _partition_overwrite(writer: DataFrameWriter) -> DataFrameWriter:
    return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def write_by_file(df: DataFrame, path: str, suffix: str = "") -> None:
    """One directory per source file; a re-run replaces just the directories it produces.

    Scan tasks hold rows of one or a few files, so no shuffle is needed. ``row_index``
    is kept as a column, as it is the only record of the original row order.
    """
    _partition_overwrite(with_suffix(df, suffix).write).partitionBy(BATCH).parquet(path)


def with_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """``2025-06-05.parquet`` becomes ``2025-06-05_processed.parquet``, and that ``…_transformed.parquet``."""
    if not suffix:
        return df
    stem = F.regexp_replace(F.regexp_replace(BATCH, r"\.parquet$", ""), r"_processed$", "")
    return df.withColumn(BATCH, F.concat(stem, F.lit(f"_{suffix}.parquet")))


def append_ledger(entries: DataFrame, path: str) -> None:
    """Entries are only ever added; readers take the latest one per file name."""
    ledger_journal(path).append(entries)


def _accepted(path: str) -> Journal:
    return Journal(path, ACCEPTED, (BATCH,), ("batch",))


def append_accepted(accepted: DataFrame, path: str) -> None:
    """The column types of files that could be read, for later reports."""
    _accepted(path).append(accepted.select(BATCH, "types", F.unix_micros(F.current_timestamp()).alias("batch")))


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """Per accepted file the types of its last ingest, and a NULL ``error``."""
    return _accepted(path).read(spark).select(BATCH, "types", F.lit(None).cast("string").alias("error"))


def append_ingest_log(entries: DataFrame, path: str) -> None:
    log = entries.select(
        "filename", "checksum", "rows", "status", "error", "duration_sec", F.col("processed_at").alias("timestamp")
    )
    log.write.mode("append").option("header", True).csv(path)


def write_profiles(profiles: DataFrame, path: str) -> None:
    """One JSON document per file, in a directory named after the file."""
    named = profiles.withColumn("source", F.col(BATCH))
    _partition_overwrite(named.write).option("ignoreNullFields", False).partitionBy("source").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """The quality report as CSV, replaced on every run."""
    report.select(REPORT_COLUMNS).write.mode("overwrite").option("header", True).csv(path)


def prepare_for_load(df: DataFrame, files_without_time: DataFrame | None = None) -> DataFrame:
    """``timestamp`` as a timestamp (NULL if invalid) and ``date`` as the text of its day.

    Rows of a file without the column get ``date='unknown'``: all rows where ``df`` has
    no ``timestamp``, else those of the files listed in ``files_without_time``.
    """
    unknown = F.lit("unknown")
    if "timestamp" not in df.columns:
        return df.withColumn("date", unknown)
    day = F.date_format("timestamp", "yyyy-MM-dd")
    rows = df.withColumn("timestamp", clock(df))
    if files_without_time is None:
        return rows.withColumn("date", day)
    marked = files_without_time.select(BATCH).distinct().withColumn("_unknown", F.lit(True))
    return rows.join(marked, BATCH, "left").withColumn("date", F.when(F.col("_unknown"), unknown).otherwise(day)).drop("_unknown")


def write_analytics(
    df: DataFrame,
    path: str,
    mode: str = "append",
    compression: str = "snappy",
    max_records: int = 0,
    partition_by: Sequence[str] = ("date", "sensor_id"),
    folders: int | None = None,
) -> None:
    """Hive partitions by ``date`` and ``sensor_id``.

    With very many sensors, ``partition_by=("date",)`` keeps the number of folders down; files
    are then sorted by sensor, so that readers of a few sensors skip most of them.

    ``append`` adds files on every call; ``replace_partitions`` overwrites the partitions
    present in ``df``. The rebalancing shuffle brings a partition's rows together, while
    adaptive execution splits partitions that are too large for one task and merges
    small ones, as long as a task does not get too many. Give ``folders``, the number of
    partitions in ``df``, where it is known; else they are counted. Where there are many, tasks write and
    place them with Arrow, if it knows the store and stores the columns' types as Spark does.
    """
    if mode not in ("append", "replace_partitions"):
        raise ValueError(f"unknown mode: {mode}")
    if folders is None:
        folders = df.select(*partition_by).distinct().count()
    if folders > FOLDERS_PER_TASK and not max_records and can_write(df, partition_by, compression):
        order = () if "sensor_id" in partition_by else ("sensor_id",)
        if write_folders(df, path, partition_by, folders, mode == "replace_partitions", compression, order):
            return
    rows = df.hint("rebalance", *partition_by)
    if "sensor_id" not in partition_by:
        rows = rows.sortWithinPartitions(*partition_by, "sensor_id")
    writer = rows.write.option("compression", compression)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer = writer.mode("append") if mode == "append" else _partition_overwrite(writer)
    with writes_sized_for(df.sparkSession, folders):
        writer.partitionBy(*partition_by).parquet(path)
