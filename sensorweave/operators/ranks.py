"""Exact medians of groups of any size, by repeated narrowing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.operators.layout import Layout, attach, join_on
from sensorweave.session import stage

BINS = 4096
_LARGEST = 1.7976931348623157e308


def exact_median(df: DataFrame, keys: Sequence[str], name: str, layout: Layout) -> DataFrame:
    """One row per group: ``keys`` and ``median`` of the non-NULL values.

    Equal values are counted before the shuffle. A group that is too large for one task is narrowed:
    its range is cut into bins, every task counts its rows per bin, and the bin with the middle is
    the next range, from the least value in it to the greatest. That ends when the middle is known
    or so few rows are left that they may be ranked. Counts are exact in every round, so there is
    nothing to miss, and no task gets more than ``group_rows`` rows of a group.
    """
    keys = list(keys)
    values = df.where(F.col(name).isNotNull()).select(*keys, F.col(name).alias("_v"))
    sizes = values.groupBy(keys).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    sizes = stage(sizes, "median-sizes")
    big = F.col("_rows") > layout.limits.group_rows
    if not sizes.where(big).limit(1).count():
        return stage(_ranked(values.withColumns(_whole()), keys), "medians")

    values = stage(values, "median-values")
    small = join_on(values, sizes.where(~big).select(keys), keys, "left_semi")
    found = [stage(_ranked(small.withColumns(_whole()), keys), "medians-small")]
    open_ranges = stage(sizes.where(big).withColumns(_whole()).withColumn("_total", F.col("_rows")), "median-ranges")
    while open_ranges.limit(1).count():
        inside = _inside(values, open_ranges, keys, layout)
        counted = stage(_next(_binned(inside, keys), keys), "median-round")
        found.append(counted.where("median IS NOT NULL").select(*keys, "median"))
        left = counted.where("median IS NULL").drop("median")
        few = F.col("_rows") <= layout.limits.group_rows
        last = left.where(few)
        if last.limit(1).count():
            found.append(stage(_ranked(_inside(values, last, keys, layout), keys), "medians-narrowed"))
        open_ranges = left.where(~few)
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return stage(result, "medians")


def _whole() -> dict[str, Column]:
    """Nothing is known to lie before a group's values yet, nor how many there are."""
    return {"_before": F.lit(0).cast("long"), "_total": F.lit(None).cast("long")}


def _inside(values: DataFrame, ranges: DataFrame, keys: list[str], layout: Layout) -> DataFrame:
    """The values within the range of their group, with what is known of it. NaN is the greatest value."""
    known = ranges.select(*keys, "_lo", "_hi", "_before", "_total")
    met = attach(values, known, keys, layout.broadcast_types, layout.limits)
    return met.where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))


def _bin() -> Column:
    """A bin that never falls as the value rises; the least value is in the first, the greatest in the last.

    Halves are taken, as the width of a range may be beyond the largest number. NaN has a bin of its own.
    """
    near = lambda c: F.greatest(F.least(F.col(c), F.lit(_LARGEST)), F.lit(-_LARGEST)) / 2
    top = F.when(F.isnan("_hi"), F.lit(_LARGEST / 2)).otherwise(near("_hi"))
    share = F.try_divide(near("_v") - near("_lo"), top - near("_lo"))
    bins = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * (BINS - 1)), F.lit(BINS - 1)) + 1
    # The ends apart, so that every round leaves something out.
    last = F.when(F.col("_v") == F.col("_hi"), F.lit(BINS + 1)).otherwise(bins)
    return F.when(F.isnan("_v"), F.lit(BINS + 2)).when(F.col("_v") == F.col("_lo"), F.lit(0)).otherwise(last).cast("int")


def _binned(inside: DataFrame, keys: list[str]) -> DataFrame:
    return inside.groupBy(*keys, _bin().alias("_bin")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
        F.first("_before").alias("_start"),
        F.first("_total").alias("_total"),
    )


def _ranks() -> tuple[Column, Column]:
    """The two places in the middle, from 1; the same for an odd number."""
    return F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)


def _next(bins: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the ``median``, or the bin that holds it as the next range. A group has ``BINS`` + 3 bins at most."""
    ordered = Window.partitionBy(keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = bins.withColumn("_before", F.col("_start") + F.coalesce(F.sum("_rows").over(ordered), F.lit(0)))
    lower, upper = _ranks()
    holds = lambda rank: (F.col("_before") < rank) & (rank <= F.col("_before") + F.col("_rows"))
    bin_of = F.struct("_lo", "_hi", "_before", "_rows", "_bin")
    picked = placed.groupBy(keys).agg(
        F.max(F.when(holds(lower), bin_of)).alias("_a"), F.max(F.when(holds(upper), bin_of)).alias("_b"), F.first("_total").alias("_total")
    )
    # In two bins: the last value of the one and the first of the other. In one of equal values: that value.
    apart = F.col("_a._bin") != F.col("_b._bin")
    median = F.when(apart, (F.col("_a._hi") + F.col("_b._lo")) / 2).when(F.col("_a._lo") == F.col("_a._hi"), F.col("_a._lo"))
    return picked.select(*keys, "_a._lo", "_a._hi", "_a._before", "_a._rows", "_total", median.alias("median"))


def _ranked(values: DataFrame, keys: list[str]) -> DataFrame:
    """The median of groups by ranking their values, ``_before`` of which come before, and ``_total`` in all (NULL: these)."""
    counts = values.groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_c"), F.first("_before").alias("_before"), F.first("_total").alias("_known")
    )
    ordered = Window.partitionBy(keys).orderBy("_v")
    upto = F.col("_before") + F.sum("_c").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.coalesce(F.col("_known"), F.sum("_c").over(Window.partitionBy(keys)))
    ranks = counts.select(*keys, "_v", "_c", upto.alias("_upto"), total.alias("_total"))
    lower, upper = _ranks()
    holds = lambda rank: (F.col("_upto") - F.col("_c") < rank) & (rank <= F.col("_upto"))
    picked = ranks.groupBy(keys).agg(
        F.max(F.when(holds(lower), F.col("_v"))).alias("_lower"),
        F.max(F.when(holds(upper), F.col("_v"))).alias("_upper"),
    )
    return picked.select(*keys, ((F.col("_lower") + F.col("_upper")) / 2).alias("median"))
