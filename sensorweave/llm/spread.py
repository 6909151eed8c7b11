"""Numbering and joining rows without giving one task more than its share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.session import stage

# A class with more than this fraction of all rows is hot; so there are fewer hot ones than that.
HOT_SHARE = 1000


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``number``, the place of a row from 0 in the order over all rows.

    Rows are dealt by ranges, each sorted by a task of its own; what goes before a range is a sum
    over as many numbers as there are ranges. ``order`` must tell all rows apart, as equal ones
    cannot be dealt to different ranges, and ``df`` be a table that reads the same every time.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stage(dealt.withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned("_place", 33)
    sizes = placed.groupBy(part.alias("_range")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    met = placed.withColumn("_range", part).join(F.broadcast(offsets), "_range")
    within = F.col("_place").bitwiseAND((1 << 33) - 1)
    return met.withColumn("number", F.col("_before") + within).drop("_range", "_before", "_place")


def join_classes(rows: DataFrame, classes: DataFrame, keys: list[str], size: str = "rows") -> DataFrame:
    """``rows`` joined with the one row that ``classes`` has for their keys; ``size`` counts a class's rows.

    Classes that are hot are broadcast; the others meet by a shuffle. Keys must not be null, and
    ``classes`` must be staged, as it is read several times.
    """
    total = classes.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    hot = F.col(size) * HOT_SHARE > total
    few, others = F.broadcast(classes.where(hot).drop(size)), classes.where(~hot).drop(size)
    cold = rows.join(F.broadcast(classes.where(hot).select(keys)), keys, "left_anti").join(others, keys)
    return rows.join(few, keys).unionByName(cold)
