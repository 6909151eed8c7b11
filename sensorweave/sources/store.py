"""Files and folders as tasks see them, by their plain paths on any store that Arrow knows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.session import stage
from sensorweave.sources.files import list_files

# Most tasks that a list of files or folders is spread over.
MOST_TASKS = 10_000


def located(path: str):
    """The file system of a plain (not percent-encoded) path, and the path inside it."""
    from pyarrow import fs

    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]+):(?://([^/]*))?(/.*)", path)
    scheme, store, inner = found.groups() if found else ("file", "", path)
    if scheme == "file":
        return fs.LocalFileSystem(), inner
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    filesystem, root = fs.FileSystem.from_uri(f"{scheme}://{store}/")
    return filesystem, root.rstrip("/") + inner


def open_file(path: str):
    filesystem, inner = located(path)
    return filesystem.open_input_file(inner)


def one_task_each(listed: DataFrame) -> DataFrame:
    """Spread a short list over as many tasks as it has rows, up to a limit.

    The number is explicit: judged by the few bytes of the list, adaptive execution
    would merge it into one task, which would then read all the files.
    """
    return listed.repartition(max(1, min(listed.count(), MOST_TASKS)))


def remove_folders(folders: DataFrame) -> None:
    """Delete the folders in the column ``path``, contents included; one that is not there is no error.

    Tasks do it, so the list does not pass through the driver. Repeating it does no harm.
    """

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                filesystem, inner = located(path)
                try:
                    filesystem.delete_dir(inner)
                except FileNotFoundError:
                    pass
            yield batch[["path"]]

    listed = folders.select("path").where("path IS NOT NULL").distinct()
    one_task_each(listed).mapInPandas(remove, "path string").write.format("noop").mode("overwrite").save()


# Fixed value: what a partition folder is called for null and for empty text.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = r"([\x01-\x1F\x22#%'*/:=?\x5C\x7F{\[\]^])"


def partition_folder(columns: list[str], values: F.Column | str = "values") -> F.Column:
    """The relative folder of ``values``, an array of texts in the order of the partition columns.

    Characters that Spark escapes in folder names are escaped: each is replaced by its code, ``%`` first.
    """
    names = F.array(*[F.lit(c) for c in columns])

    def escaped(value):
        parts = F.split(F.regexp_replace(value, _ESCAPED, "\u0000$1\u0000"), "\u0000")
        # Every second part is one of the characters to escape.
        shown = F.transform(
            parts, lambda p, i: F.when(i % 2 == 1, F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(p)), 2, "0"))).otherwise(p)
        )
        return F.array_join(shown, "")

    return F.array_join(F.zip_with(names, values, lambda n, v: F.concat(n, F.lit("="), escaped(v))), "/")


def partition_value(column) -> F.Column:
    """The text that stands for a value in the name of its partition folder."""
    text = column.cast("string")
    return F.when(text.isNull() | (text == ""), NO_VALUE).otherwise(text)


def drop_partitions(spark: SparkSession, root: str, columns: list[str], partitions: DataFrame) -> None:
    """Delete the folders of partitions of the table at ``root``; ``values`` has the texts of their columns.

    Where the table lies is taken from one of its files, as tasks need absolute paths.
    """
    if partitions.isEmpty():
        return
    inner = "/".join(f"{c}=[^/]*" for c in columns)
    base = F.regexp_extract("path", rf"^(.*)/{inner}/[^/]+$", 1)
    try:
        first = list_files(spark, root, pattern="*", recursive=True).select(base.alias("base")).where("base <> ''").first()
    except AnalysisException:
        return
    if first is not None:
        folder = F.concat(F.lit(first["base"] + "/"), partition_folder(columns))
        remove_folders(stage(partitions.select(folder.alias("path")), "dropped"))
