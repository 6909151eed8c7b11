"""Near-copies by SimHash fingerprints of 64 bits, found by deletion variants of segments.

A fingerprint is cut into two segments of 32 bits. Of two fingerprints that differ in two bits
at most, one segment is the same, or the first differs in just one bit (and then so does the
second). So both segments are indexed as they are, and the first one once more for each of its
bits, with that bit deleted: 34 signatures, and linked fingerprints have one in common. Members
of a signature are verified against each other.

A signature with very many members is not compared member by member. Within it, only the other
segment is open, and that by two bits at most (one bit, if the signature deletes one already).
So its members are indexed again by the deletion variants of the other segment. A signature then
leaves two bits open, hence has four members at most. The work per fingerprint is bounded, and
no link is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.components import components
from sensorweave.llm.words import SPACE, lower_ascii, slices, words_of
from sensorweave.session import shuffles_sized_for, stage

SEED = 42
BITS = 32  # of a segment
WHOLE = (1 << BITS) - 1
LIMIT = 64  # members of a signature that are compared with each other
TEXT_BLOCK = 1 << 18  # characters of a text that are taken apart at once
HOT_SHARE = 1000  # a fingerprint with more than this fraction of all rows is hot; so there are fewer than that

_SPACE = re.compile(SPACE)
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_OFFSETS = np.arange(8, dtype=np.int64) * 256


def blocks(text: str) -> Iterator[str]:
    """A text in parts of bounded size (but whole words), one after the other."""
    start = 0
    while start < len(text):
        found = _SPACE.search(text, start + TEXT_BLOCK)
        end = found.end() if found else len(text)
        yield text[start:end]
        start = end


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    octets = hashes.view(np.uint8).reshape(-1, 8) + _BYTE_OFFSETS
    seen = np.bincount(octets.ravel(), minlength=2048).reshape(8, 256)
    return (seen @ _BYTE_BITS).ravel()


def fingerprint(text: str | None, words: int = 3) -> int:
    """Of the shingles of so many words, repeats included, each bit that more than half of the hashes have.

    A-Z count as a-z. A shorter text is one shingle as a whole; without words it is zero.
    """
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    counts, number, before = np.zeros(64, np.int64), 0, []
    for block in blocks(lower_ascii(text or "")):
        own = before + words_of(block)
        shingles = map(" ".join, zip(*[own[k:] for k in range(words)]))
        hashes = np.fromiter(map(digest, shingles), np.uint64)
        if len(hashes):
            counts += _set_bits(hashes)
            number += len(hashes)
        before = own[len(own) - words + 1 :] if len(own) >= words else own
    if not number:
        return digest(" ".join(before)) if before else 0
    return int(np.packbits(2 * counts > number, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id`` and ``fp``, the fingerprint as a signed 64-bit number. Null texts count as empty."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            found = np.array([fingerprint(t, words) for t in batch["_text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["_id"], pa.array(found.view(np.int64))], ["id", "fp"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def _segments() -> tuple[Column, Column]:
    return F.col("fp").bitwiseAND(WHOLE), F.shiftrightunsigned("fp", BITS)


def _signatures(classes: DataFrame, bits: int) -> DataFrame:
    """``fp``, ``kind`` (0, 1: a segment as it is; 2 + p: the first without bit p), ``key``, ``side`` (bit p)."""
    first, second = _segments()
    none = F.lit(0).cast("long")
    rows = [(0, first, none), (1, second, none)]
    if bits > 1:
        rows += [
            (2 + p, first.bitwiseAND(WHOLE ^ (1 << p)), F.shiftright(first, p).bitwiseAND(1)) for p in range(BITS)
        ]
    structs = [F.struct(F.lit(k).alias("kind"), v.alias("key"), s.cast("long").alias("side")) for k, v, s in rows]
    return classes.select("fp", F.inline(F.array(*structs)))


def _within(members: Column, bits: int) -> Column:
    """The pairs of an array of distinct fingerprints that differ in so many bits at most."""
    near = lambda x: F.filter(members, lambda y: (y > x) & (F.bit_count(x.bitwiseXOR(y)) <= bits))
    return F.flatten(F.transform(members, lambda x: F.transform(near(x), lambda y: F.struct(x.alias("a"), y.alias("b")))))


def _open_masks(number: int) -> list[int]:
    """All masks of a segment with so many bits deleted."""
    return [WHOLE ^ sum(1 << p for p in places) for places in combinations(range(BITS), number)]


def _again(members: DataFrame, bits: int) -> DataFrame:
    """Links among the members of large signatures, through deletion variants of the other segment.

    A whole segment in common leaves the other one ``bits`` bits, a deleted bit leaves it one.
    """
    first, second = _segments()
    whole = F.col("kind") < 2
    rest = F.when(F.col("kind") == 1, first).otherwise(second)
    masks = lambda n: F.array(*[F.lit(m).cast("long") for m in _open_masks(n)])
    opened = members.select("kind", "key", "fp", rest.alias("rest"), F.explode(F.when(whole, masks(bits)).otherwise(masks(1))).alias("mask"))
    met = opened.groupBy("kind", "key", "mask", F.col("rest").bitwiseAND(F.col("mask")).alias("open"))
    met = met.agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    return met.select(F.inline(_within(F.col("members"), bits)))


def class_links(classes: DataFrame, bits: int = 2, limit: int = LIMIT) -> DataFrame:
    """All pairs ``a`` < ``b`` (as signed numbers) of the distinct fingerprints ``fp`` that differ in ``bits`` bits or fewer."""
    if bits not in (0, 1, 2):
        raise ValueError("bits must be 0, 1 or 2")
    if not bits:
        return classes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    found = _signatures(classes, bits)
    met = found.groupBy("kind", "key").agg(
        F.count(F.lit(1)).alias("members"), F.sum("side").alias("ones"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    both = (F.col("kind") < 2) | ((F.col("ones") > 0) & (F.col("ones") < F.col("members")))
    met = stage(met.where((F.col("members") > 1) & both).drop("ones"), "simhash-signatures")
    links = met.where("members = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits).select("a", "b")
    more = met.where("members > 2").select("kind", "key", "members")
    if more.limit(1).count():
        # Only fingerprints that have such a signature are looked at again.
        again = stage(found.join(more, ["kind", "key"]).select("kind", "key", "members", "fp"), "simhash-members")
        small = again.where(F.col("members") <= limit).groupBy("kind", "key").agg(F.collect_list("fp").alias("members"))
        links = links.unionByName(small.select(F.inline(_within(F.col("members"), bits))))
        large = again.where(F.col("members") > limit)
        if large.limit(1).count():
            links = links.unionByName(_again(large, bits))
    return links.distinct()


def _labelled(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with the ``label`` of their fingerprint. Hot ones, fewer than ``HOT_SHARE`` by definition, are broadcast."""
    total = classes.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    hot = F.col("rows") * HOT_SHARE > total
    few = F.broadcast(classes.where(hot).select("fp", "label"))
    others = rows.join(few.select("fp"), "fp", "left_anti").join(classes.where(~hot).select("fp", "label"), "fp")
    return rows.join(few, "fp").unionByName(others)


def link(
    docs: DataFrame, words: int = 3, bits: int = 2, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    The latter is the smallest id that can be reached by links, the row's own included; two rows
    are linked if their fingerprints differ in ``bits`` bits at most, so rows with equal ones always
    are. Texts without words (null, empty) have fingerprint zero and are linked like any others.
    A null id is no id: its row may connect others and gets the smallest id of its component, null if
    there is none. Repeated rows stay. Other columns do not matter, whatever their names.
    """
    spark = docs.sparkSession
    rows = stage(fingerprints(docs, words, id_col, text_col), "simhash-rows")
    # A signature takes some 32 bytes on its way.
    with shuffles_sized_for(spark, rows.count() * 34 * 32):
        classes = rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows"))
        classes = stage(classes, "simhash-classes")
        roots = components(class_links(classes, bits, limit), "simhash")
        rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        rooted = stage(rooted.withColumn("root", F.coalesce("root", "fp")), "simhash-rooted")
        # Only classes that have a link need the least id of others.
        labels = rooted.groupBy("root").agg(F.min("least").alias("label"))
        classes = stage(rooted.join(labels, "root").select("fp", "rows", "label"), "simhash-labels")
        result = stage(_labelled(rows, classes), "simhash-result")
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return result.select(F.col("id").alias(id_col), shown.alias("fingerprint"), F.col("label").alias("component_id"))


def links(
    docs: DataFrame, words: int = 3, bits: int = 2, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The links themselves: each two different fingerprints that are linked, once.

    ``a`` and ``b`` are the smallest ids of the rows that have them, in order, ``distance`` the
    number of bits that differ, ``a_rows`` and ``b_rows`` the numbers of rows. Few of any size: a
    fingerprint has at most 2,080 others two bits away.
    """
    rows = stage(fingerprints(docs, words, id_col, text_col), "simhash-rows")
    classes = stage(rows.groupBy("fp").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("rows")), "simhash-classes")
    side = lambda s: classes.select(F.col("fp").alias(s), F.struct("id", "rows").alias(f"_{s}"))
    met = class_links(classes, bits, limit).join(side("a"), "a").join(side("b"), "b")
    ends = F.sort_array(F.array("_a", "_b"))
    return met.select(
        ends[0]["id"].alias("a"),
        ends[1]["id"].alias("b"),
        F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("distance"),
        ends[0]["rows"].alias("a_rows"),
        ends[1]["rows"].alias("b_rows"),
    )
