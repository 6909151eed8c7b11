"""Importance resampling of documents towards a target distribution.

Texts are cut by the pre-tokeniser of the tokenizers library, an untrained split by a regular
expression, which returns words with their offsets. Every window of neighbouring words, a pair of
offsets, is a feature; its CRC says into which bucket it counts. The ratio of a bucket's shares in the
target and in the documents is its gain; the mean gain of a document's features is its weight.
Weights with Gumbel noise added are scores, and the highest scores are a draw without replacement.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.spread import numbered
from sensorweave.llm.words import KNOWN_WORDS, lower_ascii, slices
from sensorweave.session import shuffles_sized_for, stage

# Fixed value: the words of a text whose A-Z are lower-cased.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

# Characters of a text that are cut at once: the library's list of words is far larger than the text.
TEXT_BLOCK = 1 << 16


@dataclass(frozen=True)
class Draw:
    """``longest``: words of the longest window; ``buckets``: at most 65,536; ``percent`` of the
    documents that have ``least_words`` words are drawn; ``seed`` goes into the noise."""

    longest: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: int = 2024


class Buckets(dict):
    """The bucket of a feature by its text, worked out once. What is known is bounded by ``trim``."""

    def __init__(self, number: int):
        super().__init__()
        self.number = number

    def __missing__(self, feature: str) -> int:
        found = self[feature] = zlib.crc32(feature.encode()) % self.number
        return found

    def trim(self) -> None:
        if len(self) > KNOWN_WORDS:
            self.clear()


class Cutter:
    """Words with offsets, and windows over them."""

    def __init__(self, how: Draw):
        from tokenizers import Regex, pre_tokenizers

        if not 1 <= how.buckets <= 1 << 16:
            raise ValueError("buckets must be between 1 and 65,536")
        self.split = pre_tokenizers.Split(Regex(WORDS), behavior="removed", invert=True)
        self.how, self.known = how, Buckets(how.buckets)

    def words(self, text: str | None) -> Iterator[list[tuple[str, tuple[int, int]]]]:
        """Words and their offsets in the text, in order, a block of the text at a time."""
        lowered, start = lower_ascii(text or ""), 0
        while start < len(lowered):
            found = _NO_WORD.search(lowered, start + TEXT_BLOCK)
            end = found.end() if found else len(lowered)
            block = self.split.pre_tokenize_str(lowered[start:end])
            yield [(w, (a + start, b + start)) for w, (a, b) in block] if start else block
            start = end

    def buckets(self, text: str | None) -> tuple[int, np.ndarray]:
        """The number of words, and the buckets of all windows: all of one word, then all of two, and so on."""
        number, longest, bucket_of = 0, self.how.longest, self.known.__getitem__
        found: list[list[np.ndarray]] = [[] for _ in range(longest)]
        before: list[str] = []
        for block in self.words(text):
            self.known.trim()
            own = [word for word, _ in block]
            number += len(own)
            for size in range(1, longest + 1):
                reach = before[max(0, len(before) - size + 1) :] + own if size > 1 else own
                features = map(" ".join, zip(*[reach[k:] for k in range(size)])) if size > 1 else reach
                found[size - 1].append(np.fromiter(map(bucket_of, features), "<u2"))
            before = (before + own)[-longest:]
        every = [x for own in found for x in own]
        return number, np.concatenate(every) if every else np.zeros(0, "<u2")

    def windows(self, text: str | None) -> list[tuple[int, int, int]]:
        """Start, end and bucket of each window, in the order of ``buckets``."""
        words = [w for block in self.words(text) for w in block]
        runs = [words[k : k + size] for size in range(1, self.how.longest + 1) for k in range(len(words) - size + 1)]
        return [(r[0][1][0], r[-1][1][1], self.known[" ".join(w for w, _ in r)]) for r in runs]


def windows(docs: DataFrame, how: Draw = Draw(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``windows``, an array of ``start``, ``end`` (offsets in characters) and ``bucket``.

    A text without words (null, empty) has none. Windows overlap, repeats stay.
    """
    parts = ["start", "end", "bucket"]
    kind = T.ArrayType(T.StructType([T.StructField(p, T.LongType()) for p in parts]))

    def run(batches):
        import pyarrow as pa

        cutter = Cutter(how)
        shape = pa.list_(pa.struct([(p, pa.int64()) for p in parts]))
        for batch in slices(batches):
            found = [[dict(zip(parts, w)) for w in cutter.windows(t)] for t in batch["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["_id"], pa.array(found, shape)], [id_col, "windows"])

    schema = T.StructType([docs.schema[id_col], T.StructField("windows", kind)])
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def features(docs: DataFrame, how: Draw, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_features`` and ``buckets``, 16 bits for each feature."""

    def run(batches):
        import pyarrow as pa

        cutter = Cutter(how)
        for batch in slices(batches):
            found = [cutter.buckets(t) for t in batch["_text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["_id"],
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([len(b) for _, b in found], pa.int64()),
                    pa.array([b.tobytes() for _, b in found], pa.binary()),
                ],
                ["id", "n_words", "n_features", "buckets"],
            )

    id_field = T.StructField("id", docs.schema[id_col].dataType)
    schema = T.StructType(
        [
            id_field,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_features", T.LongType()),
            T.StructField("buckets", T.BinaryType()),
        ]
    )
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def histogram(found: DataFrame, how: Draw) -> np.ndarray:
    """Features in each bucket. A task sums up its own rows; the driver gets one number per bucket."""

    def run(batches):
        import pyarrow as pa

        counts = np.zeros(how.buckets, np.int64)
        for batch in batches:
            for own in batch["buckets"]:
                counts += np.bincount(np.frombuffer(own.as_buffer(), "<u2"), minlength=how.buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["bucket", "n"])

    rows = found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(how.buckets, np.int64)
    for row in rows.collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the logarithm of the ratio of shares, one added to each count, rounded down."""
    every, wanted, n = float(documents.sum()), float(target.sum()), float(len(documents))
    ratio = [(t + 1.0) * (every + n) / ((s + 1.0) * (wanted + n)) for s, t in zip(documents.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``weight``, the mean gain of a row's features rounded down, in place of the buckets."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sums = [int(gain[np.frombuffer(own.as_buffer(), "<u2")].sum()) for own in batch["buckets"]]
            weights = [s // max(n, 1) for s, n in zip(sums, batch["n_features"].to_pylist())]
            kept = batch.select([n for n in batch.schema.names if n != "buckets"])
            yield kept.append_column("weight", pa.array(weights, pa.int64()))

    fields = [f for f in found.schema.fields if f.name != "buckets"]
    return found.mapInArrow(run, T.StructType([*fields, T.StructField("weight", T.LongType())]))


def resample(
    docs: DataFrame,
    target: DataFrame,
    how: Draw = Draw(),
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: id, ``n_features``, ``weight``, ``score``, ``rank``, ``n_words``.

    ``rank`` counts the drawn rows from 1, by descending score, of equal scores the smaller id first,
    a null id last; it is null for rows that are not drawn. Texts without words (null, empty) have
    no features and weight 0, and too few words to be drawn. A null id adds nothing to the text that
    the noise is made of. Repeated rows count and are drawn each for itself, one after the other. An
    empty target has equal shares in all buckets. Other columns do not matter.
    """
    spark = docs.sparkSession
    found = features(docs, how, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    found = stage(found, "importance-features")
    aim = features(target.select(F.lit(0).alias("_none"), F.col(target_text_col).alias("_aim")), how, "_none", "_aim")
    weighted = _weighted(found, gains(histogram(found, how), histogram(aim, how)))

    name = F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296.0)))
    scored = stage(weighted.withColumn("score", F.col("weight") + noise), "importance-scores")

    enough = F.col("n_words") >= how.least_words
    totals = scored.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(enough, 1)).alias("enough")).first()
    most = how.percent * totals["enough"] // 100
    with shuffles_sized_for(spark, totals["rows"] * 64):
        order = [enough.desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row")]
        placed = numbered(scored, order, "importance-order")
    rank = F.when(F.col("number") < most, F.col("number") + 1)
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score", rank.alias("rank"), "n_words")


def crc32_sql(text: str, table: str) -> str:
    """CRC-32 of a text in DuckDB, ``table`` being the list that ``CRC_TABLE`` makes."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT)"
    step = f"lambda a, b: xor(a >> 8, {table}[1 + (xor(a, b) & 255)])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {step}), 4294967295)"


CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(
    list_prepend(n, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""


def oracle(how: Draw) -> str:
    """The query over ``documents`` and ``benchmark`` in DuckDB, for windows of one word."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{WORDS}')"
    n, seed = how.buckets, how.seed
    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM documents
        ), a AS (
            SELECT unnest({words}) AS f FROM benchmark
        ), f AS (
            SELECT r, unnest(w) AS f FROM d
        ), c AS (
            SELECT {CRC_TABLE} AS t
        ), k AS (
            SELECT f, {crc32_sql("f", "t")} % {n} AS b FROM (SELECT f FROM f UNION SELECT f FROM a), c
        ), s AS (
            SELECT b, count(*)::DOUBLE AS s FROM f JOIN k USING (f) GROUP BY b
        ), t AS (
            SELECT b, count(*)::DOUBLE AS t FROM a JOIN k USING (f) GROUP BY b
        ), g AS (
            SELECT b, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM f)::DOUBLE + {n})
                            / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM a)::DOUBLE + {n}))))::BIGINT AS g
            FROM s FULL JOIN t USING (b)
        ), m AS (
            SELECT r, floor(sum(g)::DOUBLE / count(*))::BIGINT AS m FROM f JOIN k USING (f) JOIN g USING (b) GROUP BY r
        ), o AS (
            SELECT r, doc_id, len(w) AS n_features, coalesce(m, 0) AS weight,
                   coalesce(m, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{seed}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5)
                                                         / 4294967296.0)))::BIGINT AS score
            FROM d LEFT JOIN m USING (r)
        ), q AS (
            SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS n, count(*) OVER () AS every
            FROM o WHERE n_features >= {how.least_words}
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN n <= {how.percent} * every // 100 THEN n END AS rank
        FROM o LEFT JOIN q USING (r)
    """
