"""Quality rules: fixed measures of a text, then a calibrated classifier over hashed n-grams.

A text is kept if it passes the base rules and the classifier, logistic regression over
hashed word and character n-grams, gives quality at least a fixed probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.linear import HASHED_WORDS, Grams, Hasher, Model, train
from sensorweave.llm.words import covered, repeated_windows, slices, words_of

# The symbols that count, and the limits of the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED_PERCENT = 30


@dataclass(frozen=True)
class Rules:
    """``threshold``: least calibrated probability of quality. ``sample_rows``: labelled rows to fit on."""

    threshold: float = 0.5
    sample_rows: int = 6_000
    strength: float = 1e-4
    grams: Grams = Grams()


MEASURES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("quality", T.DoubleType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def fit(docs: DataFrame, labels: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The classifier of ``labels.quality``, from at most ``rules.sample_rows`` labelled rows."""
    return train(
        docs, labels, id_col, text_col, "quality", rules.grams, lambda: (words_of, None), rules.sample_rows, rules.strength, "quality"
    )


def _duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


class Judge:
    """Measures and verdicts for the texts of one task."""

    def __init__(self, model: Model, rules: Rules):
        self.model, self.rules, self.hasher = model, rules, Hasher(model.grams)

    def judge(self, texts: list[str | None]) -> list[tuple]:
        hasher = self.hasher
        if len(hasher.numbers) > HASHED_WORDS:
            hasher.forget()
        words = [words_of(t) for t in texts]
        ids = [hasher.numbers.of(w) for w in words]
        hasher.learn()
        margins = np.array([self.model.margin(hasher.features(x)) for x in ids])
        scores = self.model.probability(margins).tolist()
        return [self._row(t or "", w, x, s) for t, w, x, s in zip(texts, words, ids, scores)]

    def _row(self, text: str, words: list[str], ids: np.ndarray, score: float) -> tuple:
        n = len(words)
        repeats = covered(repeated_windows(ids, WINDOW), WINDOW, n) if n > WINDOW else 0
        failed = n < LEAST_WORDS or 100 * repeats > MOST_REPEATED_PERCENT * n
        symbols = sum(map(text.count, SYMBOLS))
        kept = not failed and score >= self.rules.threshold
        return n, sum(map(len, words)), symbols, _duplicate_lines(text), repeats, failed, score, kept


def score(
    docs: DataFrame, model: Model, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: its id, the measures, the calibrated score and the verdict.

    A text without words (null and empty ones, too) fails the base rules. Repeated rows,
    null ids and whatever other columns there are do not matter: rows are judged one by one.
    """

    def run(batches):
        import pyarrow as pa

        judge = Judge(model, rules)
        for batch in slices(batches):
            columns = list(zip(*judge.judge(batch["_text"].to_pylist()))) or [()] * len(MEASURES)
            arrays = [pa.array(c, k) for c, k in zip(columns, [*[pa.int64()] * 5, pa.bool_(), pa.float64(), pa.bool_()])]
            yield pa.RecordBatch.from_arrays([batch[id_col], *arrays], [id_col, *MEASURES.names])

    schema = T.StructType([docs.schema[id_col], *MEASURES.fields])
    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are. No shuffle, no join."""

    def run(batches):
        import pyarrow as pa

        judge = Judge(model, rules)
        for batch in slices(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array([row[-1] for row in judge.judge(texts)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
