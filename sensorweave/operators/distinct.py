"""Distinct counts that can be merged: stored per file, they answer for any set of files without its rows.

Exact counts need numbers for the values, a dictionary; a file then has bitmaps of 32,768 numbers each,
and the union of files is the OR of theirs. Sketches need no dictionary and are off by a few percent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.schema import BATCH
from sensorweave.session import stage

# Numbers given by one task are neighbours; those of different tasks, and of different extensions, lie this far apart.
_STRIDE_BITS = 33


def extend_dictionary(df: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``value`` and ``number`` of all values in ``df`` and in the dictionary ``known``, whose numbers stay.

    NULL is no value. The result is written out, as the numbers depend on how tasks deal the values.
    """
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    offset = 0
    if known is not None:
        values = values.join(known, "value", "left_anti")
        top = known.agg(F.max("number").alias("n")).first()["n"]
        offset = 0 if top is None else (top >> _STRIDE_BITS) + 1
    fresh = values.withColumn("number", F.monotonically_increasing_id() + (offset << _STRIDE_BITS))
    if known is not None:
        fresh = known.select("value", "number").unionByName(stage(fresh, "dictionary-new"))
    return stage(fresh, "dictionary")


def file_bitmaps(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Per file the values it has: ``bucket`` and ``bitmap``. Copies are merged before the join."""
    seen = df.select(BATCH, F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    numbered = seen.join(dictionary, "value")
    bits = numbered.select(
        BATCH, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("bit")
    )
    return bits.groupBy(BATCH, "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def distinct_over(bitmaps: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct values in each set of files. ``sets`` has ``file_name`` and ``set``; a file may be in many.

    Files that have no values, or no bitmaps, add none; a set of such files counts 0.
    """
    merged = sets.join(bitmaps, BATCH).groupBy("set", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    counts = merged.groupBy("set").agg(F.sum(F.bitmap_count("bitmap")).alias("distinct"))
    every = sets.select("set").distinct()
    return every.join(counts, "set", "left").select("set", F.coalesce("distinct", F.lit(0)).alias("distinct"))


def file_sketches(df: DataFrame, column: str, precision: int = 12) -> DataFrame:
    """Per file a HyperLogLog ``sketch`` of the values it has; NULL without any."""
    return df.groupBy(BATCH).agg(F.hll_sketch_agg(column, precision).alias("sketch"))


def estimate_over(sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """About how many distinct values there are in each set of files."""
    merged = sets.join(sketches, BATCH).groupBy("set").agg(F.hll_union_agg("sketch").alias("sketch"))
    every = sets.select("set").distinct()
    estimate = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("long"))
    return every.join(merged, "set", "left").select("set", estimate.alias("distinct"))
