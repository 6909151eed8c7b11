"""The corpus pipeline: quality, toxicity, exact and near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sensorweave.llm import dedup, jaccard, packing, quality, toxicity
from sensorweave.session import at_most_arrow_rows, stage

# Texts that a task of the pipeline hands to Python at once. Spark's own 10,000 take tens of megabytes in the
# JVM and as many in Python, in every task. The setting stays in the session, as results are read later.
ROWS_AT_ONCE = 500


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the quality classifier."""
    at_most_arrow_rows(spark, ROWS_AT_ONCE)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, quality.fit(docs, labels))


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    at_most_arrow_rows(spark, ROWS_AT_ONCE)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id."""
    return dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles at a similarity of 0.8, the one with the smallest id."""
    at_most_arrow_rows(spark, ROWS_AT_ONCE)
    return jaccard.keep_one(docs, jaccard.Similarity(words=5, percent=80))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    at_most_arrow_rows(spark, ROWS_AT_ONCE)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxic_documents),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("best-fit packing", sequences),
]

# Classifiers and the packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{number}")
    return docs
