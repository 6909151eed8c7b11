"""Shared reads of many reading files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.functions.columns import clock, is_clock, precise_text
from sensorweave.schema import BATCH, ORDER, RAW
from sensorweave.session import sibling, stage
from sensorweave.sources.files import decoded_name, list_files, literal_path


def read_readings(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None, nanos: bool = False
) -> DataFrame:
    """Rows of the given files with ``file_name`` and ``row_index``, the position in the file.

    Required columns come out with their standard types; extra columns pass as they are,
    but for those called like one of the two added here: they get ``_in_file`` appended.
    Timestamps in nanoseconds (``nanos``) need a ``reading_session``, in which the rows are used as well.
    A file that breaks off while it is read gives fewer rows, and stops nothing.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    reader = reader.option("ignoreCorruptFiles", "true")
    rows = reader.parquet(*[literal_path(p) for p in paths])
    about = rows.metadataColumn("_metadata")
    own = [F.col(f"`{c}`").alias(f"{c}_in_file" if c.lower() in (BATCH, ORDER) else c) for c in rows.columns]
    added = [decoded_name(about["file_name"]).alias(BATCH), about["row_index"].alias(ORDER)]
    return _standard(_from_nanos(rows.select(*own, *added)) if nanos else rows.select(*own, *added))


def _from_nanos(rows: DataFrame) -> DataFrame:
    """``timestamp`` from nanoseconds since 1970; what is below a microsecond is cut off."""
    return rows.withColumn("timestamp", F.timestamp_micros(F.expr("timestamp DIV 1000")))


def _standard(rows: DataFrame) -> DataFrame:
    columns = []
    for name in rows.columns:
        column = F.col(f"`{name}`")
        if name == "timestamp" and is_clock(rows.schema[name].dataType):
            column = precise_text(clock(rows)).alias(name)
        elif name in RAW.names and rows.schema[name].dataType != RAW[name].dataType:
            column = column.cast(RAW[name].dataType).alias(name)
        columns.append(column)
    return rows.select(columns)


def reading_session(spark: SparkSession) -> SparkSession:
    """A session of its own for reading files, in which nanoseconds come as whole numbers. The caller's stays as it is."""
    return sibling(spark, **{"spark.sql.legacy.parquet.nanosAsLong": "true"})


@dataclass(frozen=True)
class Readings:
    """``rows`` of the files that could be read in full (``None`` without any file), and ``path`` and
    ``read_error`` of the others."""

    rows: DataFrame | None
    refused: DataFrame


REFUSED = "path string, read_error string"


def _signatures(footers: DataFrame) -> DataFrame:
    pairs = F.transform(F.map_entries("types"), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return footers.withColumn("signature", F.concat_ws("|", F.array_sort(pairs)))


def _united(frames: list[DataFrame]) -> DataFrame:
    """Frames of different schemas by name; an extra column of different types becomes text."""
    types: dict[str, set] = {}
    for frame in frames:
        for field in frame.schema:
            types.setdefault(field.name, set()).add(field.dataType)
    mixed = {name for name, seen in types.items() if len(seen) > 1}
    result = None
    for frame in frames:
        frame = frame.withColumns({n: F.col(n).cast("string") for n in mixed if n in frame.columns})
        result = frame if result is None else result.unionByName(frame, allowMissingColumns=True)
    return result


def _read_once(spark: SparkSession, footers: DataFrame) -> Readings:
    """One Spark read per distinct file schema, staged; schemas that Spark refuses are refused as a whole.

    Only paths and schemas, a few bytes per file, reach the driver, as in any Spark file listing.
    """
    reader = reading_session(spark)
    signed = _signatures(footers)
    by_schema: dict[str, list[str]] = {}
    for row in signed.select("path", "signature").toLocalIterator():
        by_schema.setdefault(row["signature"], []).append(row["path"])
    frames, refused = [], []
    for signature, paths in sorted(by_schema.items()):
        try:
            frames.append(read_readings(reader, paths, nanos="timestamp:timestamp[ns" in signature))
        except PySparkException as error:
            refused.append((signature, " ".join(str(error).split())))
    rows = stage(_united(frames), "readings", reader=spark) if frames else None
    if not refused:
        return Readings(rows, spark.createDataFrame([], REFUSED))
    errors = spark.createDataFrame(refused, "signature string, read_error string")
    return Readings(rows, stage(signed.join(F.broadcast(errors), "signature").select("path", "read_error"), "refused"))


def _short(rows: DataFrame | None, footers: DataFrame, refused: DataFrame) -> DataFrame:
    """Files that gave fewer or more rows than their footers say, those refused already left out."""
    expected = footers.join(refused, "path", "left_anti")
    found = F.lit(0).cast("long").alias("_found")
    if rows is None:
        counted = expected.withColumn("_found", found)
    else:
        counts = rows.groupBy(BATCH).agg(F.count(F.lit(1)).alias("_found"))
        counted = expected.join(counts, BATCH, "left").withColumn("_found", F.coalesce("_found", found))
    return counted.where(F.col("_found") != F.col("rows"))


def read_complete(spark: SparkSession, footers: DataFrame) -> Readings:
    """Read the files of a (staged) footer table; a file counts only if all its rows arrive.

    Whatever Spark finds wrong with a file ends the reading of that file alone, and it falls short of the
    rows in its footer. Such files are read once more, as a store may fail for a moment. So rows of
    files that are refused never reach a table, and no second decoder is needed.
    """
    footers = footers.select("path", BATCH, "types", "rows")
    first = _read_once(spark, footers)
    short = stage(_short(first.rows, footers, first.refused), "short")
    if short.isEmpty():
        return first
    again = _read_once(spark, short.drop("_found"))
    lost = stage(_short(again.rows, short.drop("_found"), again.refused), "lost")
    message = F.concat(F.lit("rows read: "), F.col("_found").cast("string"), F.lit(" of "), F.col("rows").cast("string"))
    refused = first.refused.unionByName(again.refused).unionByName(lost.select("path", message.alias("read_error")))
    parts = []
    if first.rows is not None:
        parts.append(first.rows.join(short.select(BATCH), BATCH, "left_anti"))
    if again.rows is not None:
        bad = lost.select(BATCH).unionByName(short.join(again.refused, "path", "left_semi").select(BATCH))
        parts.append(again.rows.join(bad, BATCH, "left_anti"))
    return Readings(_united(parts) if parts else None, refused)


def read_table(spark: SparkSession, folder: str) -> DataFrame | None:
    """A table written by one of the jobs, or ``None`` with nothing there yet."""
    from pyspark.errors import AnalysisException

    try:
        if list_files(spark, folder, recursive=True).isEmpty():
            return None
    except AnalysisException:
        return None
    return spark.read.option("mergeSchema", "true").parquet(folder)
