"""Which partitions of a table each file holds, so that a later version of the file can replace them.

A partition may have rows of many files. When a file is replaced, the partitions that its old rows are
in and those that its new rows go to are written again, from the current rows of all files that have a
share in them, and those that get no rows are deleted.

What a version is going to write is recorded before the data, and what it holds after them. So a run
that breaks off leaves nothing that a later one does not know of, whatever became of the file meanwhile.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.schema import BATCH
from sensorweave.session import stage
from sensorweave.sources.journal import Journal
from sensorweave.sources.store import drop_partitions, partition_value

# One row per table, file and partition; without ``partition`` the version of the file that is stored.
MANIFEST = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField(BATCH, T.StringType()),
        T.StructField("partition", T.ArrayType(T.StringType())),
        T.StructField("version", T.StringType()),
        T.StructField("state", T.StringType()),  # meant, held, gone
        T.StructField("rows", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)


class Manifest:
    """The part of the journal at ``path`` that concerns one table, ``target``."""

    def __init__(self, spark: SparkSession, path: str, target: str):
        self.spark, self.target = spark, target
        self.journal = Journal(path, MANIFEST, ("target", BATCH, "partition"), ("batch",), "state = 'gone'")

    def entries(self) -> DataFrame:
        return self.journal.read(self.spark).where(F.col("target") == self.target)

    def partitions(self) -> DataFrame:
        """``file_name`` and ``partition`` of all that files hold, or were about to."""
        return self.entries().where("partition IS NOT NULL").select(BATCH, "partition")

    def versions(self) -> DataFrame:
        """``file_name`` and ``version`` of the files that are stored."""
        return self.entries().where("partition IS NULL AND state = 'held'").select(BATCH, "version")

    def changed(self, wanted: DataFrame) -> DataFrame:
        """Files whose stored version is not the one in ``wanted``, and those stored that it lacks (null version).

        ``wanted`` has ``file_name`` and ``version``.
        """
        entries = self.entries()
        renewed = wanted.select(BATCH, "version").join(self.versions(), [BATCH, "version"], "left_anti")
        known = entries.select(BATCH).distinct().join(wanted, BATCH, "left_anti")
        return renewed.unionByName(known.withColumn("version", F.lit(None).cast("string")))

    def replace(
        self,
        changed: DataFrame,
        meant: DataFrame,
        columns: Sequence[str],
        write: Callable[[DataFrame], DataFrame | None],
        path: str,
    ) -> None:
        """Replace what the ``changed`` files hold in the table at ``path``, which is partitioned by ``columns``.

        ``meant`` has ``file_name``, ``partition`` and, where known, ``rows`` of what they are going to hold.
        ``write`` gets the partitions concerned and must leave in each all its current rows; it may return
        what has become of ``meant``. Partitions that no file holds then are deleted. A file withdrawn
        (null version) gives up all it held. ``changed`` must be staged, as it is read several times.
        """
        meant = stage(meant, "manifest-meant")
        before = stage(self.partitions().join(changed.select(BATCH), BATCH, "left_semi"), "manifest-before")
        batch = time.time_ns() // 1000
        versions = meant.select(BATCH, "partition").join(changed, BATCH)
        self.journal.append(self._entries(versions, batch, "meant"), compact=False)
        touched = meant.select("partition").unionByName(before.select("partition")).distinct()
        touched = stage(touched, "manifest-touched")
        own = write(touched)
        own = meant if own is None else stage(own, "manifest-own")
        own = own.join(changed, BATCH)

        left = before.unionByName(meant.select(BATCH, "partition")).distinct()
        left = left.join(own.select(BATCH, "partition"), [BATCH, "partition"], "left_anti")
        others = self.partitions().join(changed.select(BATCH), BATCH, "left_anti").select("partition")
        emptied = touched.join(own.select("partition").unionByName(others), "partition", "left_anti")
        drop_partitions(self.spark, path, list(columns), emptied.select(F.col("partition").alias("values")))
        # Until the marks of the versions are there, too, the files count as changed.
        marks = changed.withColumn("state", F.when(F.col("version").isNull(), "gone").otherwise("held"))
        entries = [self._entries(own, batch + 1, "held"), self._entries(left, batch + 1, "gone"), self._entries(marks, batch + 1)]
        self.journal.append(entries[0].unionByName(entries[1]).unionByName(entries[2]))

    def _entries(self, rows: DataFrame, batch: int, state: str | None = None) -> DataFrame:
        entries = rows.withColumns({"target": F.lit(self.target), "batch": F.lit(batch)})
        if state:
            entries = entries.withColumn("state", F.lit(state))
        for field in MANIFEST:
            if field.name not in entries.columns:
                entries = entries.withColumn(field.name, F.lit(None).cast(field.dataType))
        return entries.select(MANIFEST.names)
