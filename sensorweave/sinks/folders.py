"""Partitioned writes of very many folders, most of them with few rows.

Spark's own writer pays for a folder, however few rows it has: it opens each file through Hadoop's file
system, which on a local disk starts several processes to set permissions, and the driver puts the folders in
place one after the other. Here tasks write the files with Arrow, in a staging folder of the table,
and when all are written, tasks put them in place, which gives the same folders, rows and column types.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.session import writes_sized_for
from sensorweave.sources.files import list_files, literal_path
from sensorweave.sources.store import MOST_TASKS, located, partition_folder, partition_value, remove_folders

# What a file may hold that Arrow stores just as Spark does, and the codecs that both call the same.
PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
CODECS = ("snappy", "gzip", "zstd", "none")

# Folders that one task writes, or puts in place, about. Each takes a millisecond on a local disk.
FOLDERS_AT_ONCE = 500

# Bytes of one folder's rows that a task gathers before it writes them as a row group.
GROUP_BYTES = 64 * 1024 * 1024

FOLDER = "_partition_folder"
FILE = "_file string, _folder string, _name string"


def can_write(rows: DataFrame, columns: Sequence[str], compression: str) -> bool:
    data = rows.drop(*columns).schema
    return compression in CODECS and len(data) > 0 and all(isinstance(f.dataType, PLAIN) for f in data)


def _base(spark: SparkSession, path: str, staging: str) -> str | None:
    """The absolute path of the table at ``path``; ``None`` if Arrow does not reach it.

    Spark writes a file to the ``staging`` folder in it, and Arrow must find that.
    """
    try:
        located(path)
        probe = f"{path.rstrip('/')}/{staging}/probe"
        spark.range(1).select(F.lit("").alias("value")).coalesce(1).write.text(probe)
        found = list_files(spark, literal_path(probe), pattern="*").first()["path"]
        filesystem, inner = located(found)
        return found.rsplit("/", 3)[0] if filesystem.get_file_info(inner).is_file else None
    except (OSError, ValueError, NotImplementedError):  # all that Arrow raises about a store it does not know
        return None


def write_folders(
    rows: DataFrame, path: str, columns: Sequence[str], folders: int, replace: bool, compression: str, order: Sequence[str] = ()
) -> bool:
    """Write ``rows`` as Hive partitions by ``columns``; False, with nothing written, where Arrow does not reach ``path``.

    ``replace`` drops what the folders of ``rows`` held before, else it stays. Nothing is put in place
    before all rows are written; a run that breaks off later has replaced some of the folders. Tasks
    that are repeated, or run twice, do no harm: names of files follow from the task that writes them, not the attempt.
    Rows of a folder are sorted by ``order``.
    """
    spark, run = rows.sparkSession, uuid.uuid4().hex
    base = _base(spark, path, f".staging-{run}")
    if base is None:
        return False
    staging = f"{base}/.staging-{run}"
    try:
        written = _write(rows, columns, staging, run, compression, order)
        tasks = max(1, min(MOST_TASKS, -(-folders // FOLDERS_AT_ONCE)))
        with writes_sized_for(spark, folders, FOLDERS_AT_ONCE):
            _put_in_place(written.repartition(tasks, "_folder").sortWithinPartitions("_folder"), base, run, replace)
    finally:
        remove_folders(spark.createDataFrame([(staging,)], "path string"))
    spark.catalog.refreshByPath(path)
    return True


def _write(rows: DataFrame, columns: Sequence[str], staging: str, run: str, compression: str, order: Sequence[str]) -> DataFrame:
    """The files that tasks write to ``staging``, with the folders and names that they are to get."""
    values = [partition_value(F.col(c)) for c in columns]
    # No path can hold this character, so as with Spark's writer it is an error.
    invalid = F.raise_error(F.lit("a partition column has a value with the character NUL"))
    folder = partition_folder(list(columns), F.array(*values))
    folder = F.when(F.contains(F.concat(*values), F.lit("\u0000")), invalid).otherwise(folder)
    rows = rows.withColumn(FOLDER, folder).drop(*columns)
    stored = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in rows.drop(FOLDER).schema])
    about = {"org.apache.spark.version": rows.sparkSession.version, "org.apache.spark.sql.parquet.row.metadata": stored.json()}
    names, most = stored.names, GROUP_BYTES

    def write(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        task = TaskContext.get()
        own = f"{staging}/{task.taskAttemptId()}"
        filesystem, inner = located(own)
        form, writer, held, size, current, count, done = None, None, [], 0, None, 0, []

        def flush():
            nonlocal writer, held, size, count
            if writer is None:
                if not count:
                    filesystem.create_dir(inner, recursive=True)
                count += 1
                codec = None if compression == "none" else compression
                writer = pq.ParquetWriter(f"{inner}/{count}", form, filesystem=filesystem, compression=codec, store_schema=False)
            writer.write_table(pa.Table.from_batches(held).combine_chunks())
            held, size = [], 0

        def close():
            nonlocal writer
            if held:
                flush()
            if writer is not None:
                writer.close()
                writer = None
                name = f"part-{task.partitionId():05d}-{run}.c{count:03d}.{compression}.parquet"
                done.append({"_file": f"{own}/{count}", "_folder": current, "_name": name})

        def finished():
            ready, done[:] = list(done), []
            return pa.RecordBatch.from_pylist(ready, schema=pa.schema([(n, pa.string()) for n in ("_file", "_folder", "_name")]))

        for batch in batches:
            data, start = batch.select(names), 0
            if form is None:
                form = pa.schema([pa.field(f.name, f.type) for f in data.schema], metadata=about)
            data = pa.RecordBatch.from_arrays(data.columns, schema=form)
            for folder, same in groupby(batch.column(FOLDER).to_pylist()):
                length = len(list(same))
                if folder != current:
                    close()
                    current = folder
                held.append(data.slice(start, length))
                start, size = start + length, size + held[-1].nbytes
                if size >= most:
                    flush()
            yield finished()
        close()
        yield finished()

    return rows.hint("rebalance", FOLDER).sortWithinPartitions(FOLDER, *order).mapInArrow(write, FILE)


def _put_in_place(files: DataFrame, base: str, run: str, replace: bool) -> None:
    """Move staged files to their folders of the table at ``base``; with ``replace`` drop what is not of this ``run`` there."""

    def put(batches):
        from pyarrow import fs

        filesystem, root = located(base)
        current = None

        def clear(folder):
            for found in filesystem.get_file_info(fs.FileSelector(folder)):
                if run not in found.base_name:
                    try:
                        (filesystem.delete_file if found.is_file else filesystem.delete_dir)(found.path)
                    except FileNotFoundError:  # by the same task, run twice
                        pass

        for batch in batches:
            for row in batch.to_pylist():
                folder, staged = f"{root}/{row['_folder']}", located(row["_file"])[1]
                if folder != current:
                    filesystem.create_dir(folder, recursive=True)
                    if replace:
                        clear(folder)
                    current = folder
                target = f"{folder}/{row['_name']}"
                try:
                    filesystem.move(staged, target)
                except OSError:
                    # Moved already, by the same task before it was repeated.
                    if filesystem.get_file_info(staged).type != fs.FileType.NotFound:
                        filesystem.delete_file(target)
                        filesystem.move(staged, target)
                    elif not filesystem.get_file_info(target).is_file:
                        raise
            yield batch.slice(0, 0)

    files.mapInArrow(put, FILE).write.format("noop").mode("overwrite").save()
