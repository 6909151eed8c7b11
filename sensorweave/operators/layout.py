"""Decide, from a light count, how grouped work is spread over the cluster.

A file is the population of every statistic. Where all files are of ordinary size,
one shuffle by file brings each population together and windows do the rest. Where a
file, reading type or sensor may be too much for one task, statistics are aggregated
with map-side combine and joined back, and oversized sensor groups are split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.schema import BATCH
from sensorweave.session import stage


@dataclass(frozen=True)
class Limits:
    group_rows: int = 5_000_000
    """Rows of one group that a single window task may hold."""
    part_rows: int = 1_000_000
    """Rows of a large file that one partition is meant to get; its sort then stays small."""
    broadcast_rows: int = 500_000
    """Rows of a table of statistics that may be broadcast."""
    salts: int = 128
    """Copies of a statistics row when it is too large a table to broadcast."""


DEFAULT_LIMITS = Limits()


# TYPE is a prefix of SENSOR, so that one sort serves the windows of both.
TYPE = [BATCH, "reading_type"]
SENSOR = [*TYPE, "sensor_id"]


@dataclass(frozen=True)
class Layout:
    """Upper bounds of group sizes. They stay valid when rows are removed later."""

    rows: int
    largest_file: int
    largest_sensor: int
    type_groups: int
    unkeyed: int = 0
    files: int = 0
    limits: Limits = DEFAULT_LIMITS
    sizes: DataFrame | None = None
    """Rows per file, where some file is large."""
    hot: DataFrame | None = None
    """The sensor groups to split, where there are any."""
    hot_groups: int = 0

    @property
    def by_file(self) -> bool:
        """Every file fits one task."""
        return self.largest_file <= self.limits.group_rows

    @property
    def broadcast_files(self) -> bool:
        return self.files <= self.limits.broadcast_rows

    @property
    def broadcast_types(self) -> bool:
        return self.type_groups <= self.limits.broadcast_rows


def measure(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> Layout:
    """Count rows per file, which reads no data column; look closer only if a file is large."""
    total = F.count(F.lit(1))
    files = df.groupBy(BATCH).agg(total.alias("n"))
    first = _totals(files)
    if first["largest_file"] <= limits.group_rows:
        return _by_file(first, limits)

    sensors = df.groupBy(SENSOR).agg(total.alias("n"))
    unkeyed = F.col("sensor_id").isNull() | F.col("reading_type").isNull()
    types = sensors.groupBy(TYPE).agg(
        F.max(F.when(~unkeyed, F.col("n"))).alias("top"), F.sum(F.when(unkeyed, F.col("n"))).alias("unkeyed")
    )
    closer = types.agg(
        total.alias("type_groups"),
        F.coalesce(F.max("top"), F.lit(0)).alias("largest_sensor"),
        F.coalesce(F.sum("unkeyed"), F.lit(0)).alias("unkeyed"),
    ).first()
    layout = Layout(**first, **closer.asDict(), limits=limits, sizes=stage(files, "file-sizes"))
    if layout.largest_sensor <= limits.group_rows:
        return layout
    hot = stage(sensors.where(~unkeyed & (F.col("n") > limits.group_rows)).select(SENSOR), "hot-sensors")
    return replace(layout, hot=hot, hot_groups=hot.count())


def route(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> list[tuple[DataFrame, Layout]]:
    """The rows in parts, each with the layout that its files need: ordinary files apart from large ones.

    So one large file does not send all others through the plan for large files. Both parts read the
    input; where it is stored by file, each reads its own files only. There are few large files: at most one for
    every ``group_rows`` rows.
    """
    files = df.groupBy(BATCH).agg(F.count(F.lit(1)).alias("n"))
    whole = _totals(files)
    if whole["largest_file"] <= limits.group_rows:
        return [(df, _by_file(whole, limits))]
    sizes = stage(files, "routed-sizes")
    ordinary = _totals(sizes.where(F.col("n") <= limits.group_rows))
    if not ordinary["files"]:
        return [(df, measure(df, limits))]
    names = sizes.where(F.col("n") > limits.group_rows).select(BATCH)
    if whole["files"] - ordinary["files"] <= limits.broadcast_rows:
        names = F.broadcast(names)
    large = df.join(names, BATCH, "left_semi")
    return [(df.join(names, BATCH, "left_anti"), _by_file(ordinary, limits)), (large, measure(large, limits))]


def _by_file(totals: dict, limits: Limits) -> Layout:
    return Layout(**totals, largest_sensor=totals["largest_file"], type_groups=totals["rows"], limits=limits)


def _totals(files: DataFrame) -> dict:
    return (
        files.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.max("n"), F.lit(0)).alias("largest_file"),
            F.count(F.lit(1)).alias("files"),
        )
        .first()
        .asDict()
    )


def spread_files(df: DataFrame, layout: Layout) -> DataFrame:
    """Shuffle by file and, within large files, by sensor and type; adds the column ``_part``.

    A file goes to as many partitions as its size asks for, and not to all of them, so
    that its rows can be written as a few files of good size without another shuffle.
    """
    most = min(layout.limits.part_rows, layout.limits.group_rows)
    parts = layout.sizes.select(BATCH, F.ceil(F.col("n") / most).alias("_parts"))
    sized = attach(df, parts, [BATCH], layout.broadcast_files, layout.limits)
    part = F.pmod(F.xxhash64("sensor_id", "reading_type"), F.coalesce("_parts", F.lit(1)))
    return sized.withColumn("_part", part).drop("_parts").repartition(BATCH, "_part")


def join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", small: bool = False
) -> DataFrame:
    """Join on key columns of the same names, NULL being equal to NULL, as it is in windows and groups."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    if small:
        renamed = F.broadcast(renamed)
    same = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.join(renamed, reduce(and_, same), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def attach(
    df: DataFrame, stats: DataFrame, keys: Sequence[str], small: bool, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Left-join per-group statistics to rows.

    A table known to be small is broadcast. Otherwise the rows of a group are spread
    over ``salts`` join keys, each with its own copy of the group's statistics, so
    that a group holding a third of all rows does not land in one task.
    """
    keys = list(keys)
    if small:
        return join_on(df, stats, keys, small=True)
    spread = [f.name for f in df.schema if f.name not in keys and not isinstance(f.dataType, T.MapType)]
    copies = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(limits.salts - 1))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(limits.salts)).cast("int"))
    return join_on(salted, copies, [*keys, "_salt"]).drop("_salt")


def with_group_values(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column], layout: Layout) -> DataFrame:
    """Add aggregates of a row's group to the row: by window if files are small, else by aggregation and join."""
    if layout.by_file:
        group = Window.partitionBy(*keys)
        return df.withColumns({name: agg.over(group) for name, agg in aggs.items()})
    stats = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return attach(df, stats, keys, layout.broadcast_types, layout.limits)
