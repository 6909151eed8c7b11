"""Rejected files, kept whole: their bytes in numbered blocks, whatever their size.

A file is cut into stretches, each read by a task of its own, block by block. One block is in memory at
a time, and no list of files passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.schema import BATCH
from sensorweave.session import stage
from sensorweave.sources.store import drop_partitions, located, one_task_each, open_file

BLOCK = 4 * 1024 * 1024
STRETCH = 16  # blocks that one task reads

ABOUT = [
    T.StructField("filename", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("md5", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
]
PARTS = T.StructType(
    [
        *ABOUT,
        T.StructField("part", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def file_parts(files: DataFrame, block: int = BLOCK, stretch: int = STRETCH) -> DataFrame:
    """The blocks of files: the columns of ``ABOUT``, and ``part`` from 0, ``offset`` and ``content``.

    An empty file has one empty block.
    """
    last = F.greatest(F.ceil(F.col("length") / (block * stretch)) - 1, F.lit(0))
    ranges = files.select(*[f.name for f in ABOUT], F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("range"))

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                part, end = row["range"] * stretch, (row["range"] + 1) * stretch
                with open_file(row["path"]) as stream:
                    stream.seek(part * block)
                    while part < end:
                        content = stream.read(block)
                        if content or not part:
                            found = {"part": part, "offset": part * block, "content": content}
                            found |= {f.name: row[f.name] for f in ABOUT}
                            yield pa.RecordBatch.from_pylist([found], schema=shape)
                        if len(content) < block:
                            break
                        part += 1

    import pyarrow as pa

    kinds = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}
    shape = pa.schema([(f.name, kinds[f.dataType]) for f in PARTS])
    return one_task_each(ranges).mapInArrow(read, PARTS)


def write_quarantine(rejected: DataFrame, path: str, block: int = BLOCK) -> None:
    """Rejected files with status, error and their bytes, one folder for each file, replaced on every run.

    ``rejected`` has ``path``, ``file_name``, ``length``, ``checksum``, ``status`` and ``error``.
    """
    if rejected.isEmpty():
        return
    files = rejected.select(F.col(BATCH).alias("filename"), "path", "length", F.col("checksum").alias("md5"), "status", "error")
    parts = file_parts(files, block)
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("filename").parquet(path)


def release(spark: SparkSession, accepted: DataFrame, path: str) -> None:
    """Drop what is kept of files (``file_name``) that have been accepted since."""
    drop_partitions(spark, path, ["filename"], accepted.select(F.array(BATCH).alias("values")))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per file in quarantine, without its bytes; ``None`` with nothing there yet."""
    parts = read_parts(spark, path)
    return None if parts is None else parts.where("part = 0").select([f.name for f in ABOUT])


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(PARTS).parquet(path)
    except AnalysisException:
        return None


@contextmanager
def _few_rows_at_once(spark: SparkSession) -> Iterator[None]:
    """Blocks go to Python a few at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "8")
    try:
        yield
    finally:
        spark.conf.set(name, before)


RESTORED = "filename string, bytes long, parts long, md5 string"


def restore(parts: DataFrame, folder: str | None = None) -> DataFrame:
    """Put files together from their blocks: per file ``bytes``, ``parts`` and the ``md5`` of all of them.

    With ``folder`` they are also written there under their names; it must be an absolute path. A file is
    put together by one task, block by block, in order.
    """

    def join(batches):
        import pandas as pd

        name, digest, size, count, sink = None, None, 0, 0, None
        for batch in batches:
            for filename, content in zip(batch["filename"], batch["content"]):
                if filename != name:
                    if name is not None:
                        if sink:
                            sink.close()
                        yield pd.DataFrame([(name, size, count, digest.hexdigest())], columns=["filename", "bytes", "parts", "md5"])
                    name, digest, size, count, sink = filename, hashlib.md5(), 0, 0, None
                    if folder:
                        filesystem, inner = located(f"{folder}/{filename}")
                        filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                        sink = filesystem.open_output_stream(inner)
                digest.update(content)
                size, count = size + len(content), count + 1
                if sink:
                    sink.write(content)
        if name is not None:
            if sink:
                sink.close()
            yield pd.DataFrame([(name, size, count, digest.hexdigest())], columns=["filename", "bytes", "parts", "md5"])

    rows = parts.select("filename", "part", "content").repartition("filename").sortWithinPartitions("filename", "part")
    with _few_rows_at_once(parts.sparkSession):
        return stage(rows.drop("part").mapInPandas(join, RESTORED), "restored")
