"""The four composed jobs and the run over all of them."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.functions.columns import utc_now
from sensorweave.operators.calibrate import calibrate
from sensorweave.operators.clean import clean
from sensorweave.operators.features import derive_features
from sensorweave.operators.layout import DEFAULT_LIMITS, Layout, Limits, route
from sensorweave.operators.profile import DOCUMENT, profile_with_counts
from sensorweave.operators.status import content_status, footer_status
from sensorweave.operators.timestamps import normalize_timestamps
from sensorweave.operators.validate import quality_report
from sensorweave.schema import BATCH, Settings
from sensorweave.session import shuffles_sized_for, stage
from sensorweave.sinks import quarantine, tables
from sensorweave.sinks.manifest import Manifest
from sensorweave.sources.config import read_config
from sensorweave.sources.files import (
    ACCEPTED_STATUS,
    current_files,
    decoded_name,
    list_files,
    new_files,
    read_ledger,
    stored_bytes,
    unseen_files,
)
from sensorweave.sources.footers import inspect_files, read_checksums, read_footers
from sensorweave.sources.readings import read_complete, read_table
from sensorweave.sources.store import drop_partitions, partition_value


@dataclass(frozen=True)
class IngestResult:
    """``processed`` is ``None`` when no file could be read."""

    processed: DataFrame | None
    profiles: DataFrame | None
    ledger: DataFrame
    quarantine: DataFrame


def ingest_files(spark: SparkSession, files: DataFrame, settings: Settings) -> IngestResult:
    """Inspect, profile and store the given files in one batch; ``files`` should be staged.

    Data is written first and the ledger last, and all data is keyed by file name, so
    a batch that breaks off is simply repeated. What an earlier version of a file left in the
    processed table or in quarantine, and this one does not replace, is dropped.
    """
    start = time.monotonic()
    inspected = stage(footer_status(inspect_files(files, verify_pages=False)), "inspected")
    volume = inspected.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]
    found = read_complete(spark, inspected.where(F.col("status").isNull()))
    if not found.refused.isEmpty():
        unread = inspected.drop("read_error", "status", "error").join(found.refused, "path", "left")
        inspected = stage(footer_status(unread), "inspected")
    accepted = inspected.where(F.col("status").isNull())
    rejected = inspected.where(F.col("status").isNotNull())
    readings = found.rows

    processed = profiles = None
    entry = [F.col(BATCH).alias("filename"), "checksum", "rows", "status", "error"]
    outcome = rejected.withColumn("rows", F.lit(0).cast("bigint")).select(entry)
    if readings is not None and not accepted.isEmpty():
        tables.write_by_file(readings, settings.processed, "processed")
        with shuffles_sized_for(spark, volume):
            profiled = stage(profile_with_counts(readings, accepted.select(BATCH)), "profiles")
        profiles = profiled.select(DOCUMENT)
        tables.write_profiles(profiles, settings.profiles)
        sums = accepted.select(BATCH, "checksum")
        outcome = outcome.unionByName(content_status(profiled.join(sums, BATCH)).select(entry))
        processed = tables.with_suffix(readings, "processed")
        tables.append_accepted(accepted, settings.accepted)
    quarantine.write_quarantine(rejected, settings.quarantine)
    outcome = stage(outcome, "outcome")
    _drop_replaced(spark, outcome, settings)

    seconds = round(time.monotonic() - start, 2)
    batch = F.lit(time.time_ns() // 1000)
    entries = outcome.withColumns({"processed_at": utc_now(), "duration_sec": F.lit(seconds), "batch": batch, "seen": batch})
    entries = stage(entries.join(files.select("filename", "length", "modified"), "filename"), "entries")
    tables.append_ingest_log(entries, settings.ingest_log)
    tables.append_ledger(entries, settings.ledger)
    return IngestResult(processed, profiles, read_ledger(spark, settings.ledger), rejected)


def _drop_replaced(spark: SparkSession, outcome: DataFrame, settings: Settings) -> None:
    """Processed rows of files that bring none now, and quarantined bytes of files accepted now."""
    before = read_ledger(spark, settings.ledger).join(outcome.select("filename"), "filename", "left_semi")
    before = stage(before, "before")
    if before.isEmpty():
        return
    now = current_files(outcome)
    emptied = current_files(before).join(now, "filename", "left_anti")
    names = tables.with_suffix(emptied.withColumnRenamed("filename", BATCH), "processed")
    drop_partitions(spark, settings.processed, [BATCH], names.select(F.array(BATCH).alias("values")))
    kept = F.col("status").isin(*ACCEPTED_STATUS)
    released = before.where(~kept).join(outcome.where(kept), "filename", "left_semi")
    quarantine.release(spark, released.select(F.col("filename").alias(BATCH)), settings.quarantine)


def changed_files(files: DataFrame, settings: Settings, retry_failed: bool = False) -> DataFrame:
    """Files that are new or whose bytes have changed, with their ``checksum``.

    Only files whose length or time of change is not the one in the ledger are opened. Those of
    them that have the same bytes as before are noted in the ledger as seen, so that they need not
    be opened again.
    """
    spark = files.sparkSession
    ledger = read_ledger(spark, settings.ledger)
    unseen = stage(unseen_files(files, ledger, retry_failed), "unseen")
    if unseen.isEmpty():
        return unseen.withColumn("checksum", F.lit(None).cast("string"))
    hashed = stage(read_checksums(unseen), "hashed")
    changed = new_files(hashed, ledger, "checksum", retry_failed)
    same = ledger.drop("length", "modified", "seen").join(
        hashed.join(changed, "path", "left_anti").select("filename", "length", "modified"), "filename"
    )
    same = same.withColumn("seen", F.lit(time.time_ns() // 1000))
    if not ledger.isEmpty() and not same.isEmpty():
        tables.append_ledger(same, settings.ledger)
    return changed


def ingest(
    spark: SparkSession, settings: Settings | None = None, key: str = "name", retry_failed: bool = False
) -> IngestResult | None:
    """Ingest the raw files that are not in the ledger; ``None`` if there are none."""
    settings = settings or Settings()
    files = list_files(spark, settings.raw)
    if key == "checksum":
        files = changed_files(files, settings, retry_failed)
    else:
        files = new_files(files, read_ledger(spark, settings.ledger), key, retry_failed)
    files = stage(files, "new-files")
    if files.isEmpty():
        return None
    return ingest_files(spark, files, settings)


def transform(
    df: DataFrame, config: DataFrame, rolling: str = "rows", limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Clean, calibrate, normalise timestamps and derive features.

    The group sizes are counted once, on the input; later steps only remove rows. Rows of files of
    ordinary size are shuffled once, by file; large files go through a plan of their own.
    """
    parts = [_transform_part(rows, config, rolling, layout) for rows, layout in route(df, limits)]
    return reduce(DataFrame.unionByName, parts)


def _transform_part(df: DataFrame, config: DataFrame, rolling: str, layout: Layout) -> DataFrame:
    cleaned = clean(df, config, layout, keep_clock=True)
    timed = normalize_timestamps(calibrate(cleaned, config))
    return derive_features(timed, config, replace(layout, unkeyed=0), rolling)


def transform_files(spark: SparkSession, settings: Settings | None = None, rolling: str = "rows") -> DataFrame | None:
    """Transform the processed files and store the result; ``None`` if there are none.

    A file is transformed again if its ledger entry, the configuration or ``rolling`` has changed since;
    rows of an earlier version are replaced, also by none. Files that no ledger knows are always transformed.
    """
    settings = settings or Settings()
    manifest = Manifest(spark, settings.manifest, "transformed")
    processed = read_table(spark, settings.processed)
    if processed is None and manifest.partitions().isEmpty():
        return None
    config = read_config(spark, settings.config)
    wanted = _wanted(spark, processed, settings, _fingerprint(config, rolling))
    changed = stage(manifest.changed(wanted.drop("source")), "changed")
    if not changed.isEmpty():
        sources = stage(changed.join(wanted.select(BATCH, "source"), BATCH), "sources")
        meant = sources.select(BATCH, F.array(BATCH).alias("partition"))

        def write(touched: DataFrame) -> DataFrame | None:
            # Away with the earlier versions first: of the new ones, some may have no rows.
            drop_partitions(spark, settings.transformed, [BATCH], touched.select(F.col("partition").alias("values")))
            if processed is None or sources.isEmpty():
                return None
            rows = processed.join(sources.select(F.col("source").alias(BATCH)), BATCH, "left_semi")
            with shuffles_sized_for(spark, stored_bytes(spark, settings.processed)):
                tables.write_by_file(transform(rows, config, rolling), settings.transformed, "transformed")
            written = read_table(spark, settings.transformed)
            if written is None:
                return None
            counts = written.join(sources.select(BATCH), BATCH, "left_semi").groupBy(F.array(BATCH).alias("partition"), BATCH)
            return counts.agg(F.count(F.lit(1)).alias("rows"))

        manifest.replace(changed, meant, [BATCH], write, settings.transformed)
    transformed = read_table(spark, settings.transformed)
    return None if transformed is None else _current(transformed, settings, "transformed")


def _fingerprint(config: DataFrame, *options: str) -> str:
    """What a transformed file depends on besides its rows. The configuration has a row for each reading type."""
    rows = config.agg(F.bit_xor(F.xxhash64(*config.columns)).alias("x"), F.count(F.lit(1)).alias("n")).first()
    return "-".join([str(rows["x"]), str(rows["n"]), *options])


def _wanted(spark: SparkSession, processed: DataFrame | None, settings: Settings, options: str) -> DataFrame:
    """Per current file: its name as transformed, as processed (``source``), and the ``version`` to be stored."""
    ledger = read_ledger(spark, settings.ledger)
    if ledger.isEmpty() and processed is not None:
        names = processed.select(BATCH).distinct().withColumn("_batch", F.lit(time.time_ns()))
    else:
        names = ledger.join(current_files(ledger), "filename", "left_semi")
        names = tables.with_suffix(names.select(F.col("filename").alias(BATCH), F.col("batch").alias("_batch")), "processed")
    names = names.withColumns({"source": F.col(BATCH), "version": F.concat_ws("-", F.col("_batch"), F.lit(options))})
    return tables.with_suffix(names.drop("_batch"), "transformed")


def _current(rows: DataFrame, settings: Settings, suffix: str) -> DataFrame:
    """Without rows of files whose last ingest failed or brought none: those are left from an earlier one."""
    ledger = read_ledger(rows.sparkSession, settings.ledger)
    if ledger.isEmpty():
        return rows
    names = tables.with_suffix(current_files(ledger).withColumnRenamed("filename", BATCH), suffix)
    return rows.join(names, BATCH, "left_semi")


def validate(df: DataFrame, config: DataFrame, footers: DataFrame | None = None) -> DataFrame:
    return quality_report(df, config, footers)


def validate_files(spark: SparkSession, settings: Settings | None = None) -> DataFrame | None:
    """Report on all transformed files as CSV; ``None`` if there are none. A missing config is an empty one."""
    settings = settings or Settings()
    transformed = read_table(spark, settings.transformed)
    if transformed is None:
        return None
    config = read_config(spark, settings.config, required=False)
    transformed = _current(transformed, settings, "transformed")
    footers = tables.read_accepted(spark, settings.accepted)
    known = read_ledger(spark, settings.ledger).where(F.col("status").isin(*ACCEPTED_STATUS))
    footers = footers.join(known.select(F.col("filename").alias(BATCH)), BATCH, "left_semi")
    footers = None if footers.isEmpty() else tables.with_suffix(footers, "transformed")
    with shuffles_sized_for(spark, stored_bytes(spark, settings.transformed)):
        report = stage(validate(transformed, config, footers), "report")
    tables.write_report(report, settings.report)
    return report


def load(
    df: DataFrame,
    path: str,
    mode: str = "append",
    files_without_time: DataFrame | None = None,
    partition_by: Sequence[str] = ("date", "sensor_id"),
) -> None:
    """Store transformed rows as the analytics dataset, partitioned by day and sensor, or by day alone."""
    rows = tables.prepare_for_load(df, files_without_time).drop("row_index")
    tables.write_analytics(rows, path, mode, partition_by=partition_by)


def load_files(
    spark: SparkSession,
    settings: Settings | None = None,
    mode: str = "append",
    partition_by: Sequence[str] = ("date", "sensor_id"),
) -> bool:
    """Load the transformed files; False if there are none.

    ``append`` adds the rows of all files on every call. ``replace_partitions`` looks only at files that
    have changed since the last such call: it writes the partitions again that their old rows are in or
    their new ones go to, with the rows of all files that have a share, and deletes those left empty.
    """
    settings = settings or Settings()
    manifest = Manifest(spark, settings.manifest, "analytics")
    transformed = read_table(spark, settings.transformed)
    if transformed is not None:
        transformed = _current(transformed, settings, "transformed")
    elif mode == "append" or manifest.partitions().isEmpty():
        return False
    with shuffles_sized_for(spark, stored_bytes(spark, settings.transformed)):
        if mode == "replace_partitions":
            _load_changed(spark, transformed, settings, manifest, partition_by)
        else:
            load(transformed, settings.analytics, mode, _without_time(spark, settings), partition_by)
    return True


def _without_time(spark: SparkSession, settings: Settings) -> DataFrame | None:
    """Transformed files that lack the column ``timestamp``. Ingested ones have it, so those need not be opened."""
    files = list_files(spark, settings.transformed, recursive=True)
    folder = decoded_name(F.regexp_extract("path", rf"/{BATCH}=([^/]+)/[^/]+$", 1))
    names = tables.with_suffix(read_ledger(spark, settings.ledger).select(F.col("filename").alias(BATCH)), "transformed")
    foreign = stage(files.withColumn(BATCH, folder).join(names, BATCH, "left_anti"), "foreign")
    if foreign.isEmpty():
        return None
    footers = read_footers(foreign.drop(BATCH), checksum=False).join(foreign.select("path", F.col(BATCH).alias("_name")), "path")
    lacking = footers.where(F.array_contains("missing", "timestamp"))
    return stage(lacking.select(F.col("_name").alias(BATCH)).distinct(), "without-time")


def _load_changed(
    spark: SparkSession, transformed: DataFrame | None, settings: Settings, manifest: Manifest, partition_by: Sequence[str]
) -> None:
    columns = list(partition_by)
    stored = Manifest(spark, settings.manifest, "transformed").versions()
    if transformed is None:
        stored = stored.limit(0)
    elif stored.isEmpty():  # transformed by other means: no telling what has changed
        stored = transformed.select(BATCH).distinct().withColumn("version", F.lit(str(time.time_ns())))
    wanted = stored.withColumn("version", F.concat_ws("-", "version", F.lit("/".join(columns))))
    changed = stage(manifest.changed(wanted), "changed")
    if changed.isEmpty():
        return
    without_time = None if transformed is None else _without_time(spark, settings)

    def rows_of(files: DataFrame) -> DataFrame:
        rows = transformed.join(files.select(BATCH), BATCH, "left_semi")
        rows = tables.prepare_for_load(rows, without_time).drop("row_index")
        return rows.withColumn("_partition", F.array(*[partition_value(F.col(c)) for c in columns]))

    if transformed is None:
        meant = changed.limit(0).select(BATCH, F.array(BATCH).alias("partition"))
    else:
        meant = rows_of(changed).groupBy(BATCH, F.col("_partition").alias("partition")).agg(F.count(F.lit(1)).alias("rows"))

    def write(touched: DataFrame) -> None:
        if transformed is None:
            return
        sharing = manifest.partitions().join(touched, "partition", "left_semi").select(BATCH)
        files = stage(sharing.unionByName(changed.select(BATCH)).distinct(), "sharing")
        rows = rows_of(files).join(touched.select(F.col("partition").alias("_partition")), "_partition", "left_semi")
        rows, folders = rows.drop("_partition"), touched.count()
        tables.write_analytics(rows, settings.analytics, "replace_partitions", partition_by=columns, folders=folders)

    manifest.replace(changed, meant, columns, write, settings.analytics)


def run_all(
    spark: SparkSession, settings: Settings | None = None, key: str = "name", retry_failed: bool = False
) -> DataFrame | None:
    """Ingest, transform, validate, load. Returns the quality report, which never stops the load.

    Every stage works on what has changed, and files that share a day and a sensor do not overwrite
    each other. With ``key="checksum"`` files whose content has changed are taken in again, and all
    tables then have their new rows only.
    """
    settings = settings or Settings()
    ingest(spark, settings, key, retry_failed)
    transform_files(spark, settings)
    report = validate_files(spark, settings)
    load_files(spark, settings, mode="replace_partitions")
    return report
