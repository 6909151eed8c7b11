"""Cleaning: drop incomplete keys, keep the first copy, impute, and correct outliers per file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.functions.columns import number
from sensorweave.operators.layout import (
    DEFAULT_LIMITS,
    SENSOR,
    TYPE,
    Layout,
    Limits,
    attach,
    join_on,
    measure,
    route,
    with_group_values,
)
from sensorweave.operators.ranks import exact_median
from sensorweave.operators.timestamps import add_clock, time_order
from sensorweave.schema import BATCH, ORDER, READING_KEY
from sensorweave.session import stage

# Below this many rows a type is clipped; beyond this score a value is an outlier.
SMALL_SAMPLE = 5
Z_LIMIT = 3.0

NUMERIC = ["value", "battery_level"]


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Remove rows lacking any part of the reading key."""
    return df.na.drop(subset=[BATCH, *READING_KEY])


def dedupe_first(df: DataFrame, by_file: bool = False) -> DataFrame:
    """Keep, per reading key and file, the row that comes first in the file.

    Copies are merged before the shuffle, so a group of copies of any size sends one
    row per task. With fixed-width payload columns this is a hash aggregate without a
    sort. ``by_file`` shuffles whole files instead; all later per-file work can then
    use that one shuffle.
    """
    df = drop_incomplete(df)
    key = [BATCH, *READING_KEY]
    rest = [c for c in df.columns if c not in key and c != ORDER]
    fixed_width = all(isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType)) for c in rest)
    if by_file:
        df = df.repartition(BATCH)
    if fixed_width:
        first = [F.min_by(c, ORDER).alias(c) for c in rest]
        kept = df.groupBy(key).agg(F.min(ORDER).alias(ORDER), *first)
    else:
        packed = F.min_by(F.struct(ORDER, *rest), ORDER).alias("_first")
        kept = df.groupBy(key).agg(packed).select(*key, "_first.*")
    return kept.select(df.columns)


def _present(df: DataFrame) -> list[str]:
    return [c for c in NUMERIC if c in df.columns]


def _filled(df: DataFrame) -> dict[str, Column]:
    return {c: F.coalesce(number(c), F.col(f"_{c}_fill")) for c in _present(df)}


def impute_mean(df: DataFrame, layout: Layout | None = None, by_type: bool = False) -> DataFrame:
    """Fill missing values with the file's mean, all reading types together.

    ``by_type`` uses the mean of the file's rows of the same reading type instead.
    """
    layout = layout or measure(df)
    means = {f"_{c}_fill": F.avg(number(c)) for c in _present(df)}
    joined = with_group_values(df, TYPE if by_type else [BATCH], means, layout)
    return joined.withColumns(_filled(df)).select(df.columns)


def clip(value: Column, low: Column, high: Column) -> Column:
    """Move a value to the bound it breaks. NULL bounds and NULL values change nothing."""
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def _bounds(config: DataFrame) -> DataFrame:
    return config.select("reading_type", F.col("min").alias("_low"), F.col("max").alias("_high"))


def clip_small_samples(df: DataFrame, config: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Clip to the configured range where a type has fewer than five rows in its file."""
    layout = layout or measure(df)
    sized = with_group_values(df, TYPE, {"_n": F.count(F.lit(1))}, layout).join(_bounds(config), "reading_type", "left")
    value = number("value")
    clipped = F.when(F.col("_n") < SMALL_SAMPLE, clip(value, F.col("_low"), F.col("_high"))).otherwise(value)
    return sized.withColumn("value", clipped).select(df.columns)


def _score(value: Column) -> Column:
    return F.try_divide(F.abs(value - F.col("_mean")), F.col("_std"))


def _is_outlier(value: Column) -> Column:
    return (F.col("_n") >= SMALL_SAMPLE) & (_score(value) > Z_LIMIT)


def _type_moments(df: DataFrame) -> DataFrame:
    value = number("value")
    aggs = [
        F.count(F.lit(1)).alias("_n"),
        F.count(value).alias("_known"),
        F.sum(value).alias("_sum"),
        F.avg(value).alias("_avg"),
        F.stddev_pop(value).alias("_dev"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    ]
    if "battery_level" in df.columns:
        battery = number("battery_level")
        aggs += [F.sum(battery).alias("_battery_sum"), F.count(battery).alias("_battery_known")]
    return df.groupBy(TYPE).agg(*aggs)


def _after_imputation(moments: DataFrame, layout: Layout) -> DataFrame:
    """Fold the imputed rows, all equal to the file mean, into the moments of each type."""
    parts = {"_value_fill": ("_sum", "_known")}
    if "_battery_sum" in moments.columns:
        parts["_battery_level_fill"] = ("_battery_sum", "_battery_known")
    means = moments.groupBy(BATCH).agg(*[F.try_divide(F.sum(s), F.sum(k)).alias(n) for n, (s, k) in parts.items()])
    stats = attach(moments, means, [BATCH], layout.broadcast_types, layout.limits)

    n, known, fill = F.col("_n"), F.col("_known"), F.col("_value_fill")
    gaps = n - known
    total = F.coalesce(F.col("_sum"), F.lit(0.0)) + gaps * fill
    stats = stats.withColumn("_mean", F.when(gaps == 0, F.col("_avg")).otherwise(total / n))
    shift = F.col("_avg") - F.col("_mean")
    own = F.when(known > 0, known * (F.col("_dev") * F.col("_dev") + shift * shift)).otherwise(0.0)
    added = gaps * (fill - F.col("_mean")) * (fill - F.col("_mean"))
    stats = stats.withColumn("_std", F.when(gaps == 0, F.col("_dev")).otherwise(F.sqrt((own + added) / n)))
    return stats.withColumn("_imputed", F.when(gaps > 0, fill))


def large_file_statistics(df: DataFrame, layout: Layout, fill: bool) -> DataFrame:
    """``_n``, ``_mean``, ``_std``, ``_median`` and the file means per file and type.

    One pass over the rows gives all moments, even those after imputation, because the
    file mean is a roll-up of the type sums. A second one finds the medians, of types
    that have an outlier only. The results are small and staged.
    """
    moments = stage(_type_moments(df), "type-moments")
    if fill:
        stats = _after_imputation(moments, layout)
    else:
        nothing = F.lit(None).cast("double")
        stats = moments.withColumns(
            {"_mean": F.col("_avg"), "_std": F.col("_dev"), "_value_fill": nothing, "_imputed": nothing}
        )
    worst = F.greatest(_score(F.col("_min")), _score(F.col("_max")), _score(F.col("_imputed")))
    flagged = stats.where((F.col("_n") >= SMALL_SAMPLE) & (worst > Z_LIMIT)).select(*TYPE, "_value_fill")
    marked = flagged.withColumn("_flagged", F.lit(True))
    rows = attach(df.select(*TYPE, "value"), marked, TYPE, layout.broadcast_types, layout.limits).where("_flagged")
    values = rows.select(*TYPE, F.coalesce(number("value"), F.col("_value_fill")).alias("value"))
    medians = exact_median(values, TYPE, "value", layout).withColumnRenamed("median", "_median")
    fills = [c for c in ["_value_fill", "_battery_level_fill"] if c in stats.columns]
    return join_on(stats, medians, TYPE).select(*TYPE, "_n", "_mean", "_std", "_median", *fills)


def _with_type_statistics(df: DataFrame, layout: Layout) -> DataFrame:
    if not layout.by_file:
        stats = large_file_statistics(df, layout, fill=False).drop("_value_fill")
        return attach(df, stats, TYPE, layout.broadcast_types, layout.limits)
    value = number("value")
    aggs = {"_n": F.count(F.lit(1)), "_mean": F.avg(value), "_std": F.stddev_pop(value), "_median": F.median(value)}
    return with_group_values(df, TYPE, aggs, layout)


def correct_outliers(df: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Replace values more than three population deviations off by the median of their type and file."""
    joined = _with_type_statistics(df, layout or measure(df))
    value = number("value")
    return joined.withColumn("value", F.when(_is_outlier(value), F.col("_median")).otherwise(value)).select(df.columns)


def clean(
    df: DataFrame,
    config: DataFrame,
    layout: Layout | None = None,
    limits: Limits = DEFAULT_LIMITS,
    keep_clock: bool = False,
) -> DataFrame:
    """All cleaning steps: complete keys, first copy, imputation, then clipping or z-score correction.

    With large files the de-duplicated rows are staged once, as several passes over a
    few of their columns follow. They are staged file by file (a large file in several
    pieces), so that those passes aggregate nearly everything before they shuffle.

    Without a ``layout``, ordinary files and large ones go through their own plans.

    ``keep_clock`` parses the time right after de-duplication and keeps it for the
    steps that follow; with ordinary files it also sorts once for all windows to come.
    """
    if layout is None:
        parts = [clean(rows, config, own, limits, keep_clock) for rows, own in route(df, limits)]
        return reduce(DataFrame.unionByName, parts)
    rows = dedupe_first(df, layout.by_file)
    if keep_clock:
        rows = add_clock(rows)
    output = rows.columns
    if layout.by_file:
        if keep_clock:
            rows = rows.sortWithinPartitions(*SENSOR, *time_order())
        joined = _with_type_statistics(impute_mean(rows, layout), layout)
    else:
        rows = stage(rows.hint("rebalance", BATCH), "deduplicated")
        stats = large_file_statistics(rows, layout, fill=True)
        joined = attach(rows, stats, TYPE, layout.broadcast_types, layout.limits).withColumns(_filled(df))
    joined = joined.join(_bounds(config), "reading_type", "left")
    value = F.col("value")
    corrected = (
        F.when(F.col("_n") < SMALL_SAMPLE, clip(value, F.col("_low"), F.col("_high")))
        .when(_is_outlier(value), F.col("_median"))
        .otherwise(value)
    )
    return joined.withColumn("value", corrected).select(output)
