"""Per-file inspection: each Parquet file's own schema, readability and checksum.

A shared read fills columns a file lacks with NULL and stops at a broken file, so
files are judged one by one first. Spark spreads the files over the tasks; the
Python part reads footers and byte streams with bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.schema import FOOTER, REQUIRED
from sensorweave.sources.store import one_task_each, open_file

BLOCK = 4 * 1024 * 1024


def _message(error: Exception) -> str:
    """On one line, as it also goes into a CSV log."""
    return " ".join(f"{type(error).__name__}: {error}".split())


def _md5(path: str) -> str:
    digest = hashlib.md5()
    with open_file(path) as stream:
        while block := stream.read(BLOCK):
            digest.update(block)
    return digest.hexdigest()


def _inspect(path: str, checksum: bool) -> dict:
    import pyarrow.parquet as pq

    found = {"checksum": None, "rows": None, "row_groups": None, "columns": None, "types": None, "schema_error": None}
    # A store that fails is no fault of the file: such an error ends the task, which Spark tries again.
    if checksum:
        found["checksum"] = _md5(path)
    else:
        with open_file(path) as stream:
            stream.read(1)
    try:
        with open_file(path) as stream:
            parquet = pq.ParquetFile(stream)
            schema = parquet.schema_arrow
            found.update(
                rows=parquet.metadata.num_rows,
                row_groups=parquet.metadata.num_row_groups,
                columns=list(schema.names),
                types={f.name: str(f.type) for f in schema},
            )
    except (FileNotFoundError, PermissionError, ConnectionError, TimeoutError):
        raise
    except Exception as error:  # what the format reader finds wrong is a result here, not a crash
        found["schema_error"] = _message(error)
    return found


def read_checksums(files: DataFrame) -> DataFrame:
    """``files`` with ``checksum``, the MD5 of their bytes. One task reads a file, block by block."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "checksum": [_md5(p) for p in batch["path"]]})

    sums = one_task_each(files.select("path")).mapInPandas(scan, "path string, checksum string")
    return files.join(sums, "path")


def read_footers(files: DataFrame, checksum: bool = True) -> DataFrame:
    """One row per file: columns, types, row count and checksum, or ``schema_error``.

    ``files`` comes from ``list_files``; checksums that it has already are taken from there. ``missing``
    and ``extra`` compare the exact column names with the required ones; both are sorted.
    """
    known = "checksum" in files.columns
    checksum = checksum and not known
    listed = files.select("path", F.col("filename").alias("file_name"), "length")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([_inspect(p, checksum) for p in batch["path"]], index=batch.index)
            out = pd.concat([batch, found], axis=1)
            out["rows"] = out["rows"].astype("Int64")
            out["row_groups"] = out["row_groups"].astype("Int32")
            yield out[FOOTER.names]

    footers = one_task_each(listed).mapInPandas(scan, FOOTER)
    if known:
        footers = footers.drop("checksum").join(files.select("path", "checksum"), "path").select(FOOTER.names)
    needed = F.array(*[F.lit(c) for c in REQUIRED])
    return footers.withColumns(
        {
            "missing": F.array_sort(F.array_except(needed, F.col("columns"))),
            "extra": F.array_sort(F.array_except(F.col("columns"), needed)),
        }
    )


def inspect_files(files: DataFrame, checksum: bool = True, verify_pages: bool = True) -> DataFrame:
    """Footers with ``read_error`` from a full read by Spark; ``verify_pages=False`` skips that."""
    footers = read_footers(files, checksum)
    if not verify_pages:
        return footers.withColumn("read_error", F.lit(None).cast("string"))
    from sensorweave.session import stage
    from sensorweave.sources.readings import read_complete

    footers = stage(footers, "footers")
    readable = footers.where("schema_error IS NULL AND size(missing) = 0")
    return footers.join(read_complete(files.sparkSession, readable).refused, "path", "left")
