"""Exact token counts of every prefix of a text.

A prefix has as many tokens as the prefix before its last token, plus that one. So one
pass fills in the count of every prefix, and questions about truncation and budgets are
answered from the stored counts, without encoding anything again.
"""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.pieces import PieceModel, prefix_counts
from sensorweave.llm.words import Recent, kept_in_worker, slices


def _packed(counts: list[int]) -> bytes | array:
    return bytes(counts) if max(counts, default=0) < 256 else array("q", counts)


class Counter:
    """Prefix counts of the texts of one task; those of a word are worked out once."""

    def __init__(self, path: str, most: int = 1_200_000, most_parts: int = 400_000):
        self.model = PieceModel(path)
        self.parts: Recent = Recent(most_parts)
        self.totals: Recent = Recent(most)

    def _learn(self, parts: set[str]) -> None:
        fresh = sorted(self.parts.lacking(parts))
        # As bytes or arrays, counts are nothing that Python's collector has to look through.
        self.parts.update(zip(fresh, map(_packed, prefix_counts(self.model, fresh))))

    def words(self, texts: list[str]) -> list[list[str]]:
        """The words of texts, after working out those that are new. What is known is bounded."""
        model = self.model
        found = [model.chunks(model.marked(t)) for t in texts]
        fresh = {word: model.split(word) for word in self.totals.lacking(set().union(*found))}
        self._learn({p for own in fresh.values() for p in own})
        for word, own in fresh.items():
            self.totals[word] = sum([self.parts[p][-1] for p in own])
        return found

    def totals_of(self, texts: list[str]) -> list[int]:
        return [sum(map(self.totals.__getitem__, words)) for words in self.words(texts)]

    def fitting(self, words: list[str], limit: int) -> int:
        """Characters of the longest prefix of the text of these (known) ``words`` that has no more tokens than ``limit``.

        Tokens before a word never get fewer, so only the word in which they exceed the limit is opened.
        """
        characters = counted = 0
        for word in words:
            more = self.totals[word]
            if counted + more > limit:
                break
            characters, counted = characters + len(word), counted + more
        else:
            word = ""
        longest, parts = characters, self.model.split(word)
        self._learn(set(parts))
        for part in parts:
            within = self.parts[part]
            fits = [k for k, n in enumerate(within, 1) if counted + n <= limit]
            longest = characters + fits[-1] if fits else longest
            characters, counted = characters + len(part), counted + (within[-1] if within else 0)
        return max(0, longest - int(self.model.dummy))

    def counts(self, text: str) -> np.ndarray:
        """Element k is the count of the first k characters."""
        counted, before = [], 0
        words = self.words([text])[0]
        self._learn({p for word in set(words) for p in self.model.split(word)})
        for word in words:
            for part in self.model.split(word):
                counted.append(np.array(list(self.parts[part]), np.int32) + before)
                before = int(counted[-1][-1])
        counts = np.concatenate(counted) if counted else np.zeros(0, np.int32)
        if self.model.dummy and text:
            counts = counts[1:]
        return np.concatenate([np.zeros(1, np.int32), counts])


def _schema(docs: DataFrame, id_col: str, *fields: T.StructField) -> T.StructType:
    return T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), *fields])


def store(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, and ``prefix_tokens``, whose element k + 1 belongs to the first k characters.

    ``path`` is a SentencePiece model file that the executors have. Null counts as empty:
    no bytes, no tokens, one prefix. Rows are worked on one by one.
    """

    def run(batches):
        import pyarrow as pa

        counter = kept_in_worker(f"counter {path}", lambda: Counter(path))
        for batch in slices(batches):
            texts = [t or "" for t in batch["_text"].to_pylist()]
            counts = [counter.counts(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch[id_col],
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([int(c[-1]) for c in counts], pa.int64()),
                    pa.array(counts, pa.list_(pa.int32())),
                ],
                [id_col, "n_bytes", "n_tokens", "prefix_tokens"],
            )

    schema = _schema(docs, id_col, T.StructField("prefix_tokens", T.ArrayType(T.IntegerType())))
    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def tokens_of(prefix_tokens: Column, characters: Column | int) -> Column:
    """Tokens of so many leading characters; of the whole text beyond its end, none of fewer than one."""
    last = F.size(prefix_tokens)
    return F.element_at(prefix_tokens, F.greatest(F.lit(1), F.least(F.lit(characters) + 1, last)).cast("int"))


def fitting(prefix_tokens: Column, budget: Column | int) -> Column:
    """The most leading characters whose tokens are within a budget; null for a negative budget."""
    fits = F.transform(prefix_tokens, lambda n: n <= budget)
    from_end = F.array_position(F.reverse(fits), True)
    return F.when(from_end > 0, F.size(prefix_tokens) - from_end)


def count(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``, ``over_limit``, and ``fitting_chars``.

    The last is the length of the longest prefix within ``limit`` tokens. The counts are those
    of ``store``, which this leaves in the task; null counts as empty.
    """

    def run(batches):
        import pyarrow as pa

        counter = kept_in_worker(f"counter {path}", lambda: Counter(path))
        for batch in slices(batches):
            texts = [t or "" for t in batch["_text"].to_pylist()]
            words = counter.words(texts)
            totals = [sum(map(counter.totals.__getitem__, own)) for own in words]
            fits = [len(t) if n <= limit else counter.fitting(own, limit) for t, n, own in zip(texts, totals, words)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch[id_col],
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([n > limit for n in totals], pa.bool_()),
                    pa.array(fits, pa.int64()),
                ],
                [id_col, "n_bytes", "n_tokens", "over_limit", "fitting_chars"],
            )

    schema = _schema(
        docs, id_col, T.StructField("over_limit", T.BooleanType()), T.StructField("fitting_chars", T.LongType())
    )
    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)
