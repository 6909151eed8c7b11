"""Toxicity of texts whose words may be disguised.

A noisy channel writes letters as look-alikes, repeats them or spaces them out. The
disguise is undone by Viterbi search over a lattice of readings, priced by a character
model of the corpus; the restored text is scored by logistic regression.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.linear import HASHED_WORDS, Grams, Hasher, Model, train
from sensorweave.llm.words import KNOWN_WORDS, slices, words_of

# Letters that a look-alike may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = " .-_*~'/\\,:"
LETTERS = "abcdefghijklmnopqrstuvwxyz"

# Prices of what the channel does, as negative logarithms of probabilities.
READ_AS_LETTER = 1.5
READ_AS_NOTHING = 6.0
READ_AS_BREAK = 4.0
CLOSE_GAP = 1.0
KEEP_GAP = 1.0
SQUEEZE = 0.5

ORDER = 4
SYMBOLS = len(LETTERS) + 1  # the letters, and the edge of a word as 0


@dataclass(frozen=True)
class Settings:
    """``sample_rows``: most labelled rows to fit on. ``folds``: of how many one is held out."""

    sample_rows: int = 6_000
    strength: float = 1e-4
    folds: int = 5
    grams: Grams = Grams(bits=18, chars=(4, 5), words=1)


def _plain(char: str) -> str:
    """The base letter of an accented one."""
    return unicodedata.normalize("NFKD", char)[0] if char > "\x7f" else char


class Folding(dict):
    """Symbol number by character: 0 for whatever is no Latin letter."""

    def __missing__(self, char: str) -> int:
        number = self[char] = LETTERS.find(_plain(char)) + 1
        return number


def _edges(word: str) -> tuple[str, str, str]:
    """Punctuation before and after, and the word between; ``$$$`` at an end is punctuation, ``@s`` is not."""
    start, end = 0, len(word)
    while start < end and not word[start].isalnum() and (word[start] not in "@$" or word[start : start + 2] in ("@@", "$$")):
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[:start], word[start:end], word[end:]


_REPEATED = re.compile(r"([^\W\d_])\1\1")
_DISGUISED = re.compile(r"[0-9@$!|+(€£.\-_*~'/\\,:]")
_LETTER = re.compile(r"[^\W\d_]")
_SPACED = re.compile(r"(?<![^\s])(?:[^\s](?: )){2,}[^\s](?![^\s])")


def disguised(word: str) -> bool:
    """Whether more than one reading is possible: look-alikes, gaps between single letters, runs of three."""
    if _REPEATED.search(word):
        return True
    if not _DISGUISED.search(word) or not _LETTER.search(word):
        return False
    return any(c in word for c in LOOKALIKES) or all(len(part) == 1 for part in re.split(r"[.\-_*~'/\\,:]", word))


class Decoder:
    """The likeliest reading of disguised words under a character model.

    ``costs`` has the negative logarithm of the probability of a symbol after three others.
    """

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist() if costs.size < 600_000 else costs
        self.folding, self.known = Folding(), {}

    def read(self, written: str) -> str:
        """The best path through the lattice; linear in the length, as few states survive a place."""
        found = self.known.get(written)
        if found is None:
            if len(self.known) > KNOWN_WORDS // 4:
                self.known.clear()
            found = self.known[written] = self._search(written)
        return found

    def _arcs(self, text: str, at: int) -> list[tuple[int, str, float]]:
        """What may be read from a place on: where it ends, what it reads as, its price."""
        char = text[at]
        if self.folding[char]:
            end = at + 1
            while end < len(text) and text[end] == char:
                end += 1
            run = end - at
            if run < 3:
                return [(end, char * run, 0.0)]
            return [(end, char, SQUEEZE), (end, char * 2, SQUEEZE)]
        if char in LOOKALIKES:
            arcs = [(at + 1, c, READ_AS_LETTER) for c in LOOKALIKES[char]]
            return [*arcs, (at + 1, "", READ_AS_NOTHING), (at + 1, " ", READ_AS_BREAK)]
        if char in SEPARATORS:
            return [(at + 1, "", CLOSE_GAP), (at + 1, " ", KEEP_GAP)]
        return [(at + 1, char, 0.0)]

    def _search(self, text: str) -> str:
        block = SYMBOLS ** (ORDER - 1)
        layers: list[dict] = [{} for _ in range(len(text) + 1)]
        layers[0][0] = (0.0, -1, 0, "")
        for at in range(len(text)):
            here = layers[at]
            if not here:
                continue
            for end, reading, price in self._arcs(text, at):
                codes = [0 if c == " " else self.folding[c] for c in reading]
                there = layers[end]
                for state, (cost, *_) in here.items():
                    total, to = cost + price, state
                    for code in codes:
                        if code or to % SYMBOLS:
                            total += self.costs[to * SYMBOLS + code]
                        to = 0 if not code else (to * SYMBOLS + code) % block
                    if to not in there or total < there[to][0]:
                        there[to] = (total, at, state, reading)
        last = layers[-1]
        state = min(last, key=lambda s: (last[s][0] + (self.costs[s * SYMBOLS] if s else 0.0), s))
        at, parts = len(text), []
        while at > 0:
            _, at, state, reading = layers[at][state]
            parts.append(reading)
        return " ".join("".join(reversed(parts)).split(" ")).strip()

    def word(self, word: str) -> str:
        """A lower-case word without the punctuation around it, read if it is disguised."""
        middle = _edges(word)[1]
        return self.read(middle) if middle and disguised(middle) else middle or word

    def words(self, text: str) -> list[str]:
        """Lower-case words; letters spaced out in a row become what they spell."""
        text = text.lower()
        if _SPACED.search(text):
            text = _SPACED.sub(lambda m: self.read(m.group()) if _LETTER.search(m.group()) else m.group(), text)
        return words_of(text)

    def restore(self, text: str) -> str:
        """The text in lower case with disguises undone; spacing and punctuation stay."""
        text = text.lower()
        text = _SPACED.sub(lambda m: self.read(m.group()) if _LETTER.search(m.group()) else m.group(), text)

        def plain(match):
            before, middle, after = _edges(match.group())
            return before + (self.read(middle) if middle and disguised(middle) else middle) + after

        return re.sub(r"[^\x20\x09-\x0D]+", plain, text)


def _gram_counts(words: list[str], counts: list[int], folding: Folding) -> np.ndarray:
    """How often each string of four symbols occurs in words that occur so often."""
    total = np.zeros(SYMBOLS**ORDER)
    codes, weights = [], []
    for word, count in zip(words, counts):
        middle = _edges(word)[1]
        found = [folding[c] for c in middle]
        if found and 0 not in found:
            codes += [0] * (ORDER - 1) + found + [0]
            weights += [0] * (ORDER - 1) + [count] * (len(found) + 1)
    if codes:
        c, w = np.array(codes, np.int64), np.array(weights, float)
        value = np.zeros(len(c) - ORDER + 1, np.int64)
        for k in range(ORDER):
            value = value * SYMBOLS + c[k : k + len(value)]
        total += np.bincount(value, w[ORDER - 1 :], minlength=SYMBOLS**ORDER)
    return total


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Costs of a symbol after three others, from the words of all texts.

    Tasks count strings of four symbols, Spark adds the counts up. There are at most 27**4
    sums, whatever the corpus, so they fit into the driver. Shorter contexts smooth longer ones.
    """

    def count(batches):
        import pyarrow as pa

        folding, seen = Folding(), Counter()
        total = np.zeros(SYMBOLS**ORDER)
        for batch in slices(batches):
            for text in batch["_text"].to_pylist():
                seen.update(words_of((text or "").lower()))
            if len(seen) > HASHED_WORDS:
                total += _gram_counts(list(seen), list(seen.values()), folding)
                seen.clear()
        total += _gram_counts(list(seen), list(seen.values()), folding)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], ["gram", "n"])

    sums = docs.select(F.col(text_col).alias("_text")).mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    table = sums.toPandas()
    counts = np.zeros(SYMBOLS**ORDER)
    counts[table["gram"].to_numpy(np.int64)] = table["n"].to_numpy(float)
    return smoothed(counts)


def smoothed(counts: np.ndarray, pull: float = 5.0) -> np.ndarray:
    """Negative logarithms of probabilities; each context is pulled towards the next shorter one."""
    shape = counts.reshape((SYMBOLS,) * ORDER)
    chance = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for length in range(1, ORDER + 1):
        own = shape.sum(axis=tuple(range(ORDER - length)))
        chance = (own + pull * chance) / (own.sum(axis=-1, keepdims=True) + pull)
    return -np.log(chance).ravel()


@dataclass(frozen=True)
class Scorer:
    costs: np.ndarray
    model: Model


def fold_of(id_col: str, folds: int):
    """Remainder of crc32 of the id as text; 0 is held out. Null without an id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def fit(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> Scorer:
    """The character model of all texts, and the classifier of ``labels.toxic`` over restored texts.

    Rows of the held-out fold are not learned from.
    """
    costs = character_model(docs, text_col)

    def tools():
        decoder = Decoder(costs)
        return decoder.words, decoder.word

    seen = labels.where(fold_of(id_col, settings.folds) != 0)
    model = train(
        docs, seen, id_col, text_col, "toxic", settings.grams, tools, settings.sample_rows, settings.strength, "toxicity"
    )
    return Scorer(costs, model)


class Scoring:
    """Scores the texts of one task."""

    def __init__(self, scorer: Scorer):
        self.decoder, self.model = Decoder(scorer.costs), scorer.model
        self.hasher = Hasher(scorer.model.grams, self.decoder.word)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        found = self.hasher.of([self.decoder.words(t or "") for t in texts])
        return self.model.probability(np.array([self.model.margin(x) for x in found]))


def score(
    docs: DataFrame, scorer: Scorer, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: id, whether it is held out, probability of label 1, and the label predicted.

    Null and empty texts get the score of a text without features. A row without an id is
    not held out. Rows are scored one by one, so repeated ones get equal scores.
    """

    def run(batches):
        import pyarrow as pa

        scoring = Scoring(scorer)
        for batch in slices(batches):
            found = scoring.scores(batch["_text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch[id_col], batch["held_out"], pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))],
                [id_col, "held_out", "score", "predicted"],
            )

    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("held_out", T.BooleanType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    held = F.coalesce(fold_of(id_col, settings.folds) == 0, F.lit(False))
    return docs.select(F.col(id_col), held.alias("held_out"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, scorer: Scorer, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with their columns as they are."""

    def run(batches):
        import pyarrow as pa

        scoring = Scoring(scorer)
        for batch in slices(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array(scoring.scores(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)


def restore(docs: DataFrame, costs: np.ndarray, text_col: str = "text", out: str = "restored") -> DataFrame:
    """``docs`` with the restored text as a further column; null stays null."""

    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(costs)
        for texts in batches:
            yield texts.map(decoder.restore, na_action="ignore")

    return docs.withColumn(out, F.pandas_udf(read, "string", F.PandasUDFType.SCALAR_ITER)(F.col(text_col)))
