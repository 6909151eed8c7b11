"""Exact deduplication by a stream with keyed state that never expires.

Digests of texts arrive as a stream. The state, kept on disk by RocksDB, holds per digest
the smallest identifier seen, where its content lies, and how many rows came. Equal digests
are hits; their texts are then compared in full. DataFrame functions only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.llm.words import SPACE
from sensorweave.session import stage, staging_root
from sensorweave.sources.files import stored_bytes

# Session settings while the stream runs. Changes are logged instead of copying whole stores,
# and no store reserves disk that it does not fill, as there is a store for every partition.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # All stores of an executor share this much memory, and those that are no longer used are closed soon.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}

# Micro-batches that the digest records are read in, about: later ones meet the state that earlier ones left.
BATCHES = 4


def normalized(text: Column) -> Column:
    """Every run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digests(docs: DataFrame, id_col: str, text_col: str, digest=sha256, with_text: bool = False) -> DataFrame:
    """Per row: identifier, locator (file and place among the rows read), digest of the normalised text."""
    locator = F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row"))
    own = normalized(F.col(text_col))
    shown = [own.alias("own")] if with_text else []
    return docs.select(F.col(id_col).alias("id"), locator.alias("locator"), digest(own).alias("digest"), *shown)


def _first() -> Column:
    """The row that stays: the smallest identifier, null last; among equal ones the first place."""
    return F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("locator.row").alias("row"), "locator"))


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def keyed_state(records: DataFrame, path: str) -> DataFrame:
    """Run the stream of ``digests`` rows through the state; one row per digest comes back.

    Each micro-batch writes the state of the digests that it touched; the latest counts. The
    folder has the checkpoint, too: a stream that broke off goes on there, and later rows can
    be added by calling this again with the same ``path``.
    """
    spark = records.sparkSession
    state = records.groupBy("digest").agg(_first().alias("first"), F.count(F.lit(1)).alias("rows"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{path}/state/batch_{batch:09d}")

    with _rocksdb(spark):
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", f"{path}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
    written = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/state")
    latest = written.groupBy("digest").agg(F.max_by(F.struct("first", "rows"), "batch").alias("now"))
    return latest.select("digest", "now.first", "now.rows")


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256, batches: int = BATCHES
) -> tuple[DataFrame, DataFrame]:
    """The digest records of all rows, and per group of equal texts which row stays and how many rows it has.

    Groups have ``text`` only where texts that differ share a digest, and null elsewhere. To
    find those, the texts of hits are grouped in full, copies being merged before the shuffle.
    """
    spark = docs.sparkSession
    source = f"{staging_root(spark)}/sensorweave/dedup-digests-{uuid.uuid4().hex}"
    digests(docs, id_col, text_col, digest).write.parquet(source)
    records = spark.read.parquet(source)
    path = f"{staging_root(spark)}/sensorweave/dedup-stream-{uuid.uuid4().hex}"
    if records.isEmpty():
        empty = records.groupBy("digest").agg(_first().alias("first"), F.count(F.lit(1)).alias("rows"))
        return records, empty.withColumn("text", F.lit(None).cast("string"))
    share = -(-stored_bytes(spark, source) // batches)
    stream = spark.readStream.schema(records.schema).option("maxBytesPerTrigger", str(share)).parquet(source)
    state = stage(keyed_state(stream, path), "dedup-state")

    texts = digests(docs, id_col, text_col, digest, with_text=True)
    hits = texts.join(state.where("rows > 1").select("digest"), "digest", "left_semi")
    compared = hits.groupBy("digest", "own").agg(F.count(F.lit(1)).alias("rows"))
    mixed = compared.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")
    mixed = stage(mixed, "dedup-mixed")
    plain = state.withColumn("text", F.lit(None).cast("string"))
    if not mixed.limit(1).count():
        return records, plain
    apart = texts.join(mixed, "digest", "left_semi").groupBy("digest", F.col("own").alias("text"))
    apart = apart.agg(_first().alias("first"), F.count(F.lit(1)).alias("rows"))
    plain = plain.join(mixed, "digest", "left_anti")
    return records, plain.unionByName(apart.select("digest", "first", "rows", "text"))


def _collisions(found: DataFrame) -> bool:
    """Whether texts that differ share a digest. Settled by the plan alone where none was found."""
    return bool(found.where("text IS NOT NULL").limit(1).count())


def dedupe(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256, batches: int = BATCHES
) -> DataFrame:
    """Per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null texts count as empty, and empty texts are equal. A null id sorts after all others.
    Of repeated rows with the smallest id, one is kept. Other columns do not matter.
    """
    records, found = groups(docs, id_col, text_col, digest, batches)
    same = F.col("locator.row") == F.col("first.row")
    if digest is sha256 and not _collisions(found):
        rows, shown = records.join(found, "digest"), F.col("digest")
    else:
        rows = digests(docs, id_col, text_col, digest, with_text=True).join(found, "digest")
        rows, shown = rows.where("text IS NULL OR text = own"), sha256(F.col("own"))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        F.col("rows").cast("long").alias("group_size"),
        same.alias("kept"),
        shown.alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with their columns as they are, whatever their names.

    Null texts count as empty. The row with the smallest id stays, null being the greatest; of repeated rows one.
    """
    _, found = groups(docs, id_col, text_col, batches=batches)
    collide = _collisions(found)
    tag = uuid.uuid4().hex  # no column of docs has such a name
    digest, keep, text, own = (f"_{name}_{tag}" for name in ("digest", "keep", "text", "own"))
    found = found.select(F.col("digest").alias(digest), F.col("first.id").alias(keep), F.col("text").alias(text))
    key = [digest]
    rows = docs.withColumn(digest, sha256(normalized(F.col(text_col))))
    if collide:
        key = [digest, own]
        rows = rows.withColumn(own, normalized(F.col(text_col))).join(found, digest)
        rows = rows.where(F.col(text).isNull() | (F.col(text) == F.col(own)))
    else:
        rows = rows.join(found.drop(text), digest)
    first = rows.where(F.col(id_col).eqNullSafe(F.col(keep))).dropDuplicates(key)
    return first.select(*[F.col(f"`{c}`") for c in docs.columns])
