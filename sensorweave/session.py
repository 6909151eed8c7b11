"""Session settings and the shared staging folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app_name: str = "sensorweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Stored bytes per shuffle partition, and the most partitions: their map outputs are tracked by
# the driver, so beyond that a partition gets more work instead. 100 TB then make 5 GB each,
# which spills but needs no more memory.
BYTES_PER_PARTITION = 256 * 1024 * 1024
MOST_PARTITIONS = 20_000


def partitions_for(stored: int, least: int) -> int:
    return max(least, min(MOST_PARTITIONS, -(-stored // BYTES_PER_PARTITION)))


@contextmanager
def shuffles_sized_for(spark: SparkSession, stored: int) -> Iterator[None]:
    """Raise the number of shuffle partitions to what ``stored`` bytes of input ask for.

    Adaptive execution can merge partitions that turn out small, but never add any.
    The setting is put back at the end, also after a failure.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, partitions_for(stored, int(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# Folders that one task of a partitioned write creates about. A folder costs time however few rows it has.
FOLDERS_PER_TASK = 200


@contextmanager
def writes_sized_for(spark: SparkSession, folders: int, per_task: int = FOLDERS_PER_TASK) -> Iterator[None]:
    """Spread a partitioned write over tasks by the number of its folders, where these are many.

    Judged by bytes alone, adaptive execution would merge tens of thousands of folders with a few rows
    each into one task. It may still split what is large. Settings are put back afterwards.
    """
    wanted = -(-folders // per_task)
    if folders <= FOLDERS_PER_TASK:
        yield
        return
    coalescing, shuffles = "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"
    before = {name: spark.conf.get(name) for name in (coalescing, shuffles)}
    spark.conf.set(coalescing, "false")
    spark.conf.set(shuffles, max(int(before[shuffles]), min(MOST_PARTITIONS, wanted)))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def at_most_arrow_rows(spark: SparkSession, rows: int) -> None:
    """From now on rows go to Python at most so many at a time; a lower setting stays.

    For jobs whose results are read later, when the setting must still hold.
    """
    now = int(spark.conf.get(ARROW_ROWS))
    if not 0 < now <= rows:
        spark.conf.set(ARROW_ROWS, rows)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows go to Python at most so many at a time, where one holds much. The setting is put back at the end."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where none is set, a local master gets a temporary folder; a cluster has no folder
    that the driver could choose and all executors could see, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sensorweave-staging-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def sibling(spark: SparkSession, **conf: str) -> SparkSession:
    """A session over the same context with the settings of ``spark``, but for those given."""
    other = spark.newSession()
    for name, value in {**spark.conf.getAll, **conf}.items():
        if other.conf.isModifiable(name):
            other.conf.set(name, value)
    return other


def stage(df: DataFrame, name: str, reader: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, with the session ``reader`` if that is another one.

    This cuts the lineage, so a lost executor costs no recomputation, lets later
    readers scan only the columns they need, and tells Catalyst the true size, so
    that it broadcasts the table in joins only if it is below the threshold.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/sensorweave/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return (reader or spark).read.schema(df.schema).parquet(path)
