"""Tables to which entries are only added, of which the latest for each key counts.

Entries are appended to the current epoch. When that has many files, the latest entries are written
as a snapshot, a new epoch is begun by a pointer, and only then are the old files deleted. So reading
costs the snapshot, which has a row per key, and a bounded number of appended files, however often was
written. The pointer is written last: if a compaction breaks off anywhere, what was there before still
counts. There may be any number of readers, but one writer at a time, as with the jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.sources.files import list_files
from sensorweave.sources.store import remove_folders

# Appended files of an epoch from which on it is worth a snapshot.
MOST_FILES = 64


@dataclass(frozen=True)
class Journal:
    """``keys`` tell entries apart, the greatest ``order`` is the latest; ``gone`` is an SQL condition for
    entries that count like none and are left out of snapshots."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order: tuple[str, ...]
    gone: str = "false"

    def epoch(self, spark: SparkSession) -> int:
        try:
            pointers = spark.read.schema("number long").option("recursiveFileLookup", "true").json(f"{self.path}/pointer")
            return pointers.agg(F.max("number").alias("n")).first()["n"] or 0
        except AnalysisException:
            return 0

    def append(self, entries: DataFrame, compact: bool = True) -> None:
        spark = entries.sparkSession
        epoch = self.epoch(spark)
        entries.select(self.schema.names).write.mode("append").parquet(f"{self.path}/entries/epoch={epoch}")
        if compact and list_files(spark, f"{self.path}/entries/epoch={epoch}").count() > MOST_FILES:
            self.compact(spark)

    def _read(self, spark: SparkSession, folder: str) -> DataFrame | None:
        try:
            return spark.read.schema(self.schema).parquet(f"{self.path}/{folder}")
        except AnalysisException:
            return None

    def read(self, spark: SparkSession) -> DataFrame:
        """The latest entry per key; empty if nothing was written yet."""
        epoch = self.epoch(spark)
        parts = [self._read(spark, f"snapshots/epoch={epoch}"), self._read(spark, f"entries/epoch={epoch}")]
        entries = None
        for part in parts:
            if part is not None:
                entries = part if entries is None else entries.unionByName(part)
        if entries is None:
            return spark.createDataFrame([], self.schema)
        return self.latest(entries).where(f"NOT ({self.gone})")

    def latest(self, entries: DataFrame) -> DataFrame:
        whole = F.max_by(F.struct(*self.schema.names), F.struct(*self.order)).alias("_entry")
        return entries.groupBy(*self.keys).agg(whole).select("_entry.*")

    def compact(self, spark: SparkSession) -> None:
        """Write the latest entries as a snapshot, point to it, and delete what it replaces."""
        epoch = self.epoch(spark)
        self._snapshot(spark, epoch + 1)
        self._point(spark, epoch + 1)
        self._clear(spark, epoch + 1)

    def _snapshot(self, spark: SparkSession, epoch: int) -> None:
        self.read(spark).write.mode("overwrite").parquet(f"{self.path}/snapshots/epoch={epoch}")

    def _point(self, spark: SparkSession, epoch: int) -> None:
        number = spark.range(1).select(F.lit(epoch).cast("long").alias("number"))
        number.coalesce(1).write.mode("overwrite").json(f"{self.path}/pointer/epoch={epoch}")

    def _clear(self, spark: SparkSession, epoch: int) -> None:
        """Delete the folders of earlier epochs, also those that an earlier compaction left."""
        number = F.regexp_extract("folder", r"epoch=(\d+)$", 1).cast("long")
        folder = F.regexp_extract("path", r"^(.*/epoch=\d+)/[^/]+$", 1)
        found = list_files(spark, self.path, pattern="*", recursive=True).select(folder.alias("folder")).where("folder <> ''")
        remove_folders(found.where(number < epoch).select(F.col("folder").alias("path")))
