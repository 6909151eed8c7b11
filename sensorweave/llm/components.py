"""Connected components of links between rows, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.session import stage


def _mirrored(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (else the smaller) neighbours of every node onto the least node around it."""
    around = _mirrored(edges)
    if not large:
        around = around.where("b < a")
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = around.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    """What tells two rounds apart. Node numbers may be near 2**63, so they are added up as decimals."""
    total = F.sum(F.col("b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total, F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Per linked node: ``node`` and ``root``, the least node that can be reached.

    ``edges`` has whole numbers ``a`` and ``b``. Every round is a few joins of the links, written
    out at its end; the number of rounds grows with the logarithm of the longest path.
    """
    edges = stage(edges.where("a <> b").distinct(), f"{name}-edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = stage(_star(_star(edges, large=True), large=False), f"{name}-stars")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
