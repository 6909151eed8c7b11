"""Ingest driven by Structured Streaming: each micro-batch is a set of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorweave.plans.jobs import ingest_files
from sensorweave.schema import Settings
from sensorweave.session import stage
from sensorweave.sources.files import decoded_name, new_files, read_ledger


def start_ingest(
    spark: SparkSession,
    settings: Settings | None = None,
    checkpoint: str | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Ingest everything that is there and stop; the checkpoint remembers what has been offered.

    Only file names flow through the stream. A batch repeated after a failure skips
    files that reached the ledger and rewrites the rest, which is keyed by file name.
    """
    settings = settings or Settings()
    stream = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .load(settings.raw)
        .select(
            "path",
            decoded_name(F.col("_metadata.file_name")).alias("filename"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )

    def ingest_batch(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        files = stage(new_files(batch, read_ledger(session, settings.ledger)), "new-files")
        if not files.isEmpty():
            ingest_files(session, files, settings)

    return (
        stream.writeStream.foreachBatch(ingest_batch)
        .option("checkpointLocation", checkpoint or f"{settings.state}/stream")
        .trigger(availableNow=True)
        .start()
    )
