"""Hashed word and character n-grams, and calibrated logistic regression over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.words import Numbers, distinct, hash64, mix64, slices
from sensorweave.session import arrow_rows, stage

# A task forgets its words when it has hashed more than this many: a word is several hundred bytes with its n-grams.
HASHED_WORDS = 100_000

# Features that the task that fits works on at once, and rows of features that go to it at once.
BLOCK = 1 << 18
ROWS_AT_ONCE = 256


@dataclass(frozen=True)
class Grams:
    """Which n-grams count. A feature is 1 if the n-gram occurs in the text, else 0.

    ``bits``: two to that power are the places that n-grams are hashed to.
    ``chars``: lengths of the character n-grams, taken inside words with their ends marked.
    ``words``: 2 adds pairs of neighbouring words to single words.
    """

    bits: int = 18
    chars: tuple[int, ...] = (3, 4)
    words: int = 2


class Hasher:
    """Hashed n-grams of texts, with what belongs to a word computed once per word.

    ``read_as`` maps a word to the form that is hashed.
    """

    def __init__(self, grams: Grams, read_as: Callable[[str], str] | None = None):
        self.grams, self.read_as = grams, read_as
        self.forget()

    def forget(self) -> None:
        self.numbers = Numbers()
        self.hashes = np.zeros(0, np.uint64)
        self.starts = np.zeros(1, np.int64)
        self.places = np.zeros(0, np.int32)

    def learn(self) -> None:
        """Hash the character n-grams of the words met since the last call."""
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if not fresh:
            return
        if self.read_as:
            fresh = list(map(self.read_as, fresh))
        hashes = np.fromiter(map(hash64, fresh), np.uint64, len(fresh))
        points = np.frombuffer("".join(f"\x02{w}\x03" for w in fresh).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = points.astype(np.uint64)
        lengths = np.fromiter(map(len, fresh), np.int64, len(fresh)) + 2
        owner = np.repeat(np.arange(len(fresh)), lengths)
        places, owners = [self._place(mix64(hashes))], [np.arange(len(fresh))]
        for size in self.grams.chars:
            n = len(points) - size + 1
            if n > 0:
                value = np.full(n, size, np.uint64)
                for k in range(size):
                    value = value * np.uint64(0x100000001B3) + points[k : k + n]
                inside = owner[:n] == owner[size - 1 :]
                places.append(self._place(mix64(value))[inside])
                owners.append(owner[:n][inside])
        places, owners = np.concatenate(places), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        counts = np.bincount(owners, minlength=len(fresh))
        self.hashes = np.concatenate([self.hashes, hashes])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
        self.places = np.concatenate([self.places, places[order]])

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.grams.bits)).astype(np.int32)

    def features(self, ids: np.ndarray) -> np.ndarray:
        """The sorted places of the n-grams of a text, given its word numbers in order."""
        own = distinct(ids)
        found = []
        if len(own):
            first, sizes = self.starts[own], self.starts[own + 1] - self.starts[own]
            ends = np.cumsum(sizes)
            found.append(self.places[np.arange(ends[-1]) + np.repeat(first - ends + sizes, sizes)])
        if self.grams.words > 1 and len(ids) > 1:
            h = self.hashes[ids]
            found.append(self._place(mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])))
        return distinct(np.concatenate(found)) if found else np.zeros(0, np.int32)

    def of(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Features of texts that are given as lists of words."""
        if len(self.numbers) > HASHED_WORDS:
            self.forget()
        ids = [self.numbers.of(words) for words in texts]
        self.learn()
        return [self.features(x) for x in ids]


def scale(features):
    """What a feature of a text with so many counts: long texts are damped, yet a rare n-gram still shows."""
    return np.maximum(features, 1) ** -0.25


@dataclass(frozen=True)
class Model:
    """Weights by place, intercept, and the slope and offset that calibrate the margin."""

    grams: Grams
    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))

    def margin(self, features: np.ndarray) -> float:
        return self.intercept + float(self.weights[features].sum()) * scale(len(features))


def clean_labels(labelled: DataFrame, id_col: str, label: str) -> DataFrame:
    """One row per id: ``_id``, ``_label``. Ids that are null, unlabelled or labelled both ways are left out."""
    return (
        labelled.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label).cast("int").alias("_label"), F.max(label).cast("int").alias("_other"))
        .where("_label = _other")
        .drop("_other")
    )


def bounded_sample(clean: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` ids, half of them at most per label: those with the smallest hashes.

    It is small enough to broadcast. The choice depends on the ids only, and is the same in every run.
    """

    def of(label):
        chosen = clean.where(F.col("_label") == label)
        return chosen.orderBy(F.xxhash64(F.lit("sample"), "_id"), "_id").limit(rows // 2)

    return of(0).unionByName(of(1))


def train(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str,
    text_col: str,
    label: str,
    grams: Grams,
    tools: Callable[[], tuple[Callable[[str], list[str]], Callable[[str], str] | None]],
    rows: int,
    strength: float,
    name: str,
) -> Model:
    """Fit on a sample of at most ``rows`` labelled rows; calibrate on a quarter of it that the fit never saw.

    The sample has as many rows of either label as there are, up to half of ``rows``; the
    calibration puts the true shares of the labels back.

    ``tools`` makes, inside a task, the function that turns a text into words and the one
    that gives the form of a word to hash. Features are hashed in Arrow batches and staged; one task fits the bounded sample. Without rows
    of both labels, the model gives every text the share of label 1.
    """
    spark = docs.sparkSession
    clean = clean_labels(labelled, id_col, label)
    counts = {r["_label"]: r["n"] for r in clean.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    sample = bounded_sample(clean, rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")

    def hashed(batches):
        import pyarrow as pa

        to_words, read_as = tools()
        hasher = Hasher(grams, read_as)
        for batch in slices(batches):
            found = hasher.of([to_words(t or "") for t in batch["_text"].to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_label"], pa.array(found, pa.list_(pa.int32()))], ["_id", "_label", "_places"]
            )

    schema = T.StructType(
        [
            T.StructField("_id", docs.schema[id_col].dataType),
            T.StructField("_label", T.IntegerType()),
            T.StructField("_places", T.ArrayType(T.IntegerType())),
        ]
    )
    staged = stage(texts.mapInArrow(hashed, schema), f"{name}-features")
    found = staged.repartition(1).mapInArrow(_fit(grams, strength, counts), "weights binary, intercept double, slope double, offset double")
    with arrow_rows(spark, ROWS_AT_ONCE):
        row = found.first()
    return Model(grams, np.frombuffer(row["weights"], np.float32), row["intercept"], row["slope"], row["offset"])


def _fit(grams: Grams, strength: float, counts: dict[int, int]):
    """The work of the one task that fits: the sample is bounded, and so is what it holds."""

    def run(batches):
        import pyarrow as pa

        ids, labels, features = [], [], []
        for batch in batches:
            ids += map(str, batch["_id"].to_pylist())
            labels += batch["_label"].to_pylist()
            features += split(batch["_places"].flatten().to_numpy(), np.diff(batch["_places"].offsets.to_numpy()))
        order = sorted(range(len(ids)), key=lambda i: (hash64(ids[i]), ids[i]))
        labels, rows = np.array(labels, float)[order], Rows.of([features[i] for i in order])
        aside = np.arange(len(labels)) % 4 == 3
        weights, intercept, slope, offset = np.zeros(1 << grams.bits), 0.0, 1.0, 0.0
        if len(set(labels[~aside])) < 2:
            share = (labels.sum() + 1) / (len(labels) + 2)
            intercept = float(np.log(share / (1 - share)))
        else:
            weights, intercept = logistic(rows, labels, ~aside, 1 << grams.bits, strength)
            if min(labels[aside].sum(), (1 - labels[aside]).sum()) >= 5:
                slope, offset = platt(rows.margins(weights, intercept)[aside], labels[aside])
            ones = labels.sum()
            offset += float(np.log(counts[1] / counts[0]) - np.log(ones / (len(labels) - ones)))
        yield pa.RecordBatch.from_pydict(
            {
                "weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary()),
                "intercept": [intercept],
                "slope": [slope],
                "offset": [offset],
            }
        )

    return run


def split(places: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The places of each row, where they lie."""
    ends = np.cumsum(lengths).tolist()
    return [places[start:end] for start, end in zip([0, *ends], ends)]


class Rows:
    """Rows of a 0/1 matrix, each scaled by its number of features.

    Rows stay as they are given, and are worked through block by block: what is held beside them
    is bounded. Sums add up in the order of the rows and their features, whatever the blocks.
    """

    def __init__(self, lengths: np.ndarray, places: np.ndarray, order: list[int]):
        features = split(places, lengths)
        self._hold([features[i] for i in order], BLOCK)

    @classmethod
    def of(cls, features: list[np.ndarray], block: int = BLOCK) -> Rows:
        """Rows whose places are given one by one; they may lie in the batches that they came in."""
        rows = cls.__new__(cls)
        rows._hold(features, block)
        return rows

    def _hold(self, features: list[np.ndarray], block: int) -> None:
        self.features, self.lengths = features, np.fromiter(map(len, features), np.int64, len(features))
        self.count, self.scale = len(features), scale(self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        firsts = np.flatnonzero(np.diff(starts // block, prepend=-1)).tolist()
        self.blocks = list(zip(firsts, [*firsts[1:], self.count]))

    def _parts(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Per block: which rows, the places of their features, and how many each row has."""
        for start, end in self.blocks:
            yield slice(start, end), np.concatenate(self.features[start:end]).astype(np.intp), self.lengths[start:end]

    def margins(self, weights: np.ndarray, intercept: float) -> np.ndarray:
        found = np.zeros(self.count)
        for rows, places, lengths in self._parts():
            found[rows] = np.bincount(np.repeat(np.arange(len(lengths)), lengths), weights[places], len(lengths))
        return found * self.scale + intercept

    def transposed(self, values: np.ndarray, size: int) -> np.ndarray:
        found, scaled = np.zeros(size), values * self.scale
        for rows, places, lengths in self._parts():
            np.add.at(found, places, np.repeat(scaled[rows], lengths))
        return found


def logistic(rows: Rows, labels: np.ndarray, use: np.ndarray, size: int, strength: float, steps: int = 60):
    """Weights and intercept of L2-regularised logistic regression, by limited-memory BFGS."""
    signs, share = np.where(labels > 0, 1.0, -1.0), use / use.sum()

    def loss(x):
        z = signs * rows.margins(x[:-1], x[-1])
        pull = -signs * share / (1.0 + np.exp(np.clip(z, -500, 500)))
        value = (share * np.logaddexp(0, -z)).sum() + strength / 2 * (x[:-1] ** 2).sum()
        return value, np.append(rows.transposed(pull, size) + strength * x[:-1], pull.sum())

    x = np.zeros(size + 1)
    value, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, kept = slope.copy(), []
        for s, y, r in reversed(past):
            kept.append(r * (s @ way))
            way -= kept[-1] * y
        if past:
            s, y, r = past[-1]
            way /= r * (y @ y)
        for (s, y, r), k in zip(past, reversed(kept)):
            way += (k - r * (y @ way)) * s
        step, fall = 1.0 if past else 1.0 / max(np.abs(slope).max(), 1e-12), slope @ way
        while True:
            new_value, new_slope = loss(x - step * way)
            if new_value <= value - 1e-4 * step * fall or step < 1e-9:
                break
            step /= 2
        s, y = -step * way, new_slope - slope
        if s @ y > 1e-12:
            past = [*past[-9:], (s, y, 1.0 / (s @ y))]
        gain, x, value, slope = value - new_value, x + s, new_value, new_slope
        if gain < 1e-5:
            break
    return x[:-1], float(x[-1])


def platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make probabilities of margins, by Newton steps; targets smoothed after Platt."""
    ones = labels.sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)
    at = np.array([1.0, 0.0])

    def loss(v):
        z = x @ v
        return (np.logaddexp(0, z) - target * z).sum()

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        way = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), x.T @ (p - target))
        step = 1.0
        while loss(at - step * way) > loss(at) and step > 1e-6:
            step /= 2
        at = at - step * way
        if np.abs(step * way).max() < 1e-9:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)
