"""Named queries over the driver tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.llm import (
    chat,
    dedup,
    encoding,
    importance,
    jaccard,
    licenses,
    merkle,
    packing,
    quality,
    simhash,
    token_counts,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

# Vocabulary files, and the most tokens of a document that is not over the limit.
PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
MOST_TOKENS = 4096

# The table of pages has no time of fetching; records bear this one.
FETCHED = "2024-01-01T00:00:00Z"

# Windows of one word in 10,000 buckets; a tenth of the documents of 20 words or more is drawn.
DRAW = importance.Draw(longest=1, buckets=10_000, percent=10, least_words=20, seed=2024)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link(table(spark, folder, "documents"), jaccard.Similarity(words=4, percent=85))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(PIECES)
    counted = token_counts.count(table(spark, folder, "documents"), path, MOST_TOKENS)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "fitting_chars")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.dedupe(table(spark, folder, "documents"))


def op5_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, folder, "pages"), FETCHED))


def op6_piece_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.digest(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op8_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    repaired = chat.repair(table(spark, folder, "conversations"))
    return repaired.withColumn("inserted", F.array_join("inserted", " "))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    return found.withColumns({"sentence_ids": F.array_join("sentence_ids", " "), "licenses": F.array_join("licenses", ",")})


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(WORDS))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return merkle.manifest(docs, seen={"text": merkle.case_tampered("doc_id", "text")})


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return importance.resample(docs, target, DRAW).select("doc_id", "n_features", "weight", "score", "rank")


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.link(table(spark, folder, "documents"), words=3, bits=2)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in [
        op1_quality_rules,
        op2_ngram_jaccard,
        op3_token_counts,
        op4_exact_dedup,
        op5_warc_derivatives,
        op6_piece_ids,
        op7_toxicity,
        op8_chat_repair,
        op9_license_scan,
        op10_packing,
        op11_merkle_manifest,
        op12_importance_resampling,
        op13_simhash,
    ]
}

SQL: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept,
               sha256(t) AS text_sha256
        FROM n WINDOW same AS (PARTITION BY t)
    """,
    "op5_warc_derivatives": warc.oracle(FETCHED),
    "op9_license_scan": licenses.oracle(),
    "op11_merkle_manifest": merkle.oracle(),
    "op12_importance_resampling": importance.oracle(DRAW),
}
