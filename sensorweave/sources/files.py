"""Discovery of raw files and the incremental filter."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.schema import LEDGER

# Status of files whose rows are stored.
ACCEPTED_STATUS = ("success", "dq_warning")


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet", recursive: bool = False) -> DataFrame:
    """``path``, ``filename``, ``length`` and ``modified`` of the matching files. Contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
    )
    name = decoded_name(files.metadataColumn("_metadata")["file_name"])
    return files.select("path", name.alias("filename"), "length", F.col("modificationTime").alias("modified"))


def stored_bytes(spark: SparkSession, folder: str) -> int:
    sizes = list_files(spark, folder, recursive=True).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
    return sizes.first()["bytes"]


def decoded_name(encoded: Column) -> Column:
    """The plain name of a file. Spark's file metadata have it percent-encoded, whatever reads the file."""
    return F.url_decode(F.regexp_replace(encoded, r"\+", "%2B"))


def literal_path(path: str) -> str:
    """A path as readers take it, with the characters that would make it a pattern escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The latest entry per file name; empty if nothing has been ingested yet."""
    return ledger_journal(path).read(spark)


def ledger_journal(path: str):
    """An entry of a later batch counts; of one batch, the one that saw the file last."""
    from sensorweave.sources.journal import Journal

    return Journal(path, LEDGER, ("filename",), ("batch", "seen"))


def current_files(ledger: DataFrame) -> DataFrame:
    """Names of the files whose last ingest succeeded and brought rows; data of others is out of date."""
    return ledger.where(F.col("status").isin(*ACCEPTED_STATUS) & (F.col("rows") > 0)).select("filename")


def new_files(files: DataFrame, ledger: DataFrame, key: str = "name", retry_failed: bool = False) -> DataFrame:
    """Files not in the ledger.

    By default the name alone decides, whatever the file's status was. ``retry_failed``
    offers failed files again; ``key="checksum"`` (``files`` must have the column) also
    offers files whose content has changed.
    """
    done = ledger
    if retry_failed:
        done = done.where(F.col("status").isin(*ACCEPTED_STATUS))
    on = ["filename", "checksum"] if key == "checksum" else ["filename"]
    return files.join(done.select(on), on, "left_anti")


def unseen_files(files: DataFrame, ledger: DataFrame, retry_failed: bool = False) -> DataFrame:
    """Files whose name, length and time of change together are not in the ledger: all that may have changed.

    This takes the listing alone, no file is opened.
    """
    done = ledger
    if retry_failed:
        done = done.where(F.col("status").isin(*ACCEPTED_STATUS))
    on = ["filename", "length", "modified"]
    return files.join(done.select(on), on, "left_anti")
