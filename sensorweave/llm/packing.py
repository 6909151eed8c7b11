"""Packing token pieces into sequences of bounded length by a grouping genetic algorithm.

Documents are tokenised and cut only where they exceed a sequence. Pieces are dealt into
shards of bounded size. For every shard, islands evolve packings of their own: crossover
injects whole well-filled sequences of one parent into another, drops the sequences that
hold the same pieces, and fits what they displaced anew by best fit. Between epochs the
best packing of an island migrates to the next one. Badly filled sequences of all shards
are pooled and packed again, until they fit into one shard.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.pieces import LONGEST_REMEMBERED
from sensorweave.llm.words import SPACE, slices
from sensorweave.session import stage

END_ID = 0

# Characters of text whose words a task looks up at once.
BLOCK_CHARS = 1 << 22


@dataclass(frozen=True)
class Evolution:
    """``shard``: pieces per shard. ``well_filled``: share of a sequence from which it is passed on whole."""

    length: int = 2048
    shard: int = 2000
    islands: int = 2
    epochs: int = 2
    generations: int = 4
    population: int = 4
    well_filled: float = 0.995


# Kinds of characters. Chunks are what gaps separate; those with an odd character are left to the library whole.
GAP, LETTER, NUMBER, OTHER, ODD, END = range(6)

# Odd are all characters from here on, control characters, and spaces other than those of ``SPACE``.
TABLE = 0x300
_ODD = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0]")

# Small letters that an apostrophe takes along.
_ONE, _TWO = [ord(c) for c in "stmd"], [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of the characters of the table; one place more stands for all that follow."""
    kinds, lower = np.full(TABLE + 1, ODD, np.uint8), np.arange(TABLE + 1, dtype=np.uint32)
    for code, letter in enumerate(map(chr, range(TABLE))):
        small = letter.lower()
        if _ODD.match(letter) or len(small) > 1 or ord(small) >= TABLE:
            continue
        lower[code] = ord(small)
        kind = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(letter)[0], OTHER)
        kinds[code] = GAP if re.match(SPACE, letter) else kind
    return kinds, lower


def _byte_letters() -> dict[int, str]:
    """The visible character by which byte-level vocabularies write each byte; the space, not in words, stays."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)} | {32: " "}


def _starts(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where words begin, by the tokenizer's own splitting. ``points`` are in lower case, an END comes last."""
    starts = np.empty(len(points), bool)
    starts[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
    starts |= (kinds == NUMBER) | (kinds == END)
    at = np.flatnonzero(points == ord("'"))
    at = at[(kinds[at] == OTHER) & (kinds[at - 1] != OTHER) & (kinds[at + 1] == LETTER)]
    first, second = points[at + 1], points[at + 2]
    one = np.isin(first, _ONE)
    two = np.logical_or.reduce([(first == a) & (second == b) for a, b in _TWO])
    starts[at[one | two] + 1] = False
    after = np.concatenate([at[one] + 2, at[two] + 3])
    starts[after] |= kinds[after] == LETTER
    return starts


def _arrow_words(points: np.ndarray, first: np.ndarray):
    """Words as an Arrow column of UTF-8 bytes. They lie one behind the other in ``points`` and begin at ``first``."""
    places = np.append(first, len(points))
    if points.max(initial=0) < 0x80:
        data = points.astype(np.uint8).tobytes()
    else:
        data = points.astype("<u4", copy=False).tobytes().decode("utf-32-le").encode()
        before = np.zeros(len(points) + 1, np.int32)  # bytes that characters need beyond the first
        np.cumsum((points >= 0x80).view(np.int8) + (points >= 0x800) + (points >= 0x10000), out=before[1:])
        places = places + before[places]
    buffers = [None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(first), buffers)


@dataclass(frozen=True)
class Split:
    """Texts taken apart: codes of all their words, which words have odd characters, and the last words of texts."""

    words: pa.DictionaryArray
    odd: np.ndarray
    ends: np.ndarray


class Tokens:
    """Ids of texts as the library gives them, those of a word worked out once per task.

    Texts are split by array operations over many at once. White space separates chunks that the
    tokenizer treats alike wherever they stand, so a chunk may be left to the library on its own.
    What is known are Arrow words and their ids one behind the other; a space is the end of a text.
    """

    def __init__(self, path: str, most: int = 400_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.most = self.tokenizer.model, most
        (self.kinds, self.lower), self.letters = _tables(), _byte_letters()
        self.words, self.ids = pa.array([b" "], pa.binary()), np.array([END_ID], "<u4")
        self.starts, self.sizes = np.zeros(1, np.int64), np.ones(1, np.int64)
        self.used = None  # which words the last texts have, once too much is known

    def split(self, texts: list[str]) -> Split:
        """At least one text."""
        joined = " ".join([*texts, ""])
        if joined.isascii():
            points = np.frombuffer(joined.encode(), np.uint8)
        else:
            points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kinds, low = self.kinds.take(points, mode="clip"), self.lower.take(points, mode="clip")
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths + 1) - 1
        odd = kinds == ODD
        if "<|" in joined:
            odd[:-1] |= (points[:-1] == ord("<")) & (points[1:] == ord("|"))
        if odd.any():
            gaps = kinds == GAP
            chunks = np.cumsum(gaps)
            odd = (np.bincount(chunks[odd], minlength=chunks[-1] + 1) > 0)[chunks] & ~gaps
            # Texts that are odd for the most part go to the library whole, which costs less.
            share = np.diff(np.cumsum(odd)[ends], prepend=0)
            odd |= np.repeat(2 * share > lengths, lengths + 1)
            kinds[odd], low[odd] = ODD, points[odd]
        kinds[ends] = END
        starts, kept = _starts(low, kinds), kinds != GAP
        first = np.flatnonzero(starts[kept])
        words, kinds = _arrow_words(low[kept], first).dictionary_encode(), kinds[kept][first]
        return Split(words, np.flatnonzero(kinds == ODD), np.flatnonzero(kinds == END))

    def of(self, splits: list[Split]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each: the ids of its texts one behind the other, each followed by ``END_ID``, and where each ends."""
        self._forget()
        codes = self._learn(splits)
        for own, split in zip(codes, splits):
            sizes = self.sizes[own]
            ends = np.cumsum(sizes)
            yield self.ids[np.repeat(self.starts[own] - (ends - sizes), sizes) + np.arange(ends[-1])], ends[split.ends]

    def _learn(self, splits: list[Split]) -> list[np.ndarray]:
        """Codes of all words among those known, after working out the words that are new."""
        before = pa.DictionaryArray.from_arrays(np.arange(len(self.words), dtype=np.int32), self.words)
        met = pa.chunked_array([before, *(split.words for split in splits)]).unify_dictionaries()
        self.words = met.chunk(0).dictionary
        known, *codes = (chunk.indices.to_numpy() for chunk in met.chunks)
        new, odd = np.ones(len(self.words), bool), np.zeros(len(self.words), bool)
        new[known] = False
        for own, split in zip(codes, splits):
            odd[own[split.odd]] = True
        starts, sizes, ids = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64), [self.ids]
        starts[known], sizes[known] = self.starts, self.sizes
        for which, work in ((new & ~odd, self._plain), (new & odd, self._library)):
            found, sizes[which] = work(self.words.filter(which).to_numpy(zero_copy_only=False).tolist())
            starts[which] = sum(map(len, ids)) + np.cumsum(sizes[which]) - sizes[which]
            ids.append(np.array(found, "<u4"))
        self.starts, self.sizes, self.ids = starts, sizes, np.concatenate(ids)
        if len(self.words) > self.most or self.words.nbytes > LONGEST_REMEMBERED * self.most:
            self.used = np.zeros(len(self.words), bool)
            for own in codes:
                self.used[own] = True
        return codes

    def _plain(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Ids of words, and how many each has, by the library's model alone: they are split off and in lower case."""
        ids, sizes, tokenize = [], [], self.model.tokenize
        spelled = b" ".join(words).decode("latin-1").translate(self.letters)
        for word in spelled.split(" ") if words else []:
            own = tokenize(word)
            ids += [token.id for token in own]
            sizes.append(len(own))
        return ids, sizes

    def _library(self, chunks: list[bytes]) -> tuple[list[int], list[int]]:
        ids, sizes = [], []
        for chunk in chunks:
            own = self.tokenizer.encode(chunk.decode(), add_special_tokens=False).ids
            ids += own
            sizes.append(len(own))
        return ids, sizes

    def _forget(self) -> None:
        """Where too much is known, keep the short words of the last texts only."""
        if self.used is None:
            return
        kept = np.flatnonzero(self.used & (pc.binary_length(self.words).to_numpy() <= LONGEST_REMEMBERED))
        sizes = self.sizes[kept]
        ends = np.cumsum(sizes)
        self.ids = self.ids[np.repeat(self.starts[kept] - (ends - sizes), sizes) + np.arange(ends[-1])]
        self.words, self.starts, self.sizes, self.used = self.words.take(kept), ends - sizes, sizes, None


def _blocks(batches, tokens: Tokens, id_col: str) -> Iterator[list[tuple[pa.Array, Split]]]:
    """Ids of rows with their texts taken apart, as many at once as have ``BLOCK_CHARS`` characters."""
    held, size = [], 0
    for batch in slices(batches):
        if batch.num_rows:
            texts = [text or "" for text in batch["_text"].to_pylist()]
            # A copy, as a part of the batch would keep all of it.
            held.append((batch[id_col].take(pa.array(range(len(texts)))), tokens.split(texts)))
            size += sum(map(len, texts))
        if size >= BLOCK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def cut(docs: DataFrame, path: str, how: Evolution, id_col: str, text_col: str) -> DataFrame:
    """Pieces of all rows: id, number, start, length, crc32 of the ids; dealt into shards as they come.

    A shard is numbered by task and holds at most ``how.shard`` pieces. Pieces as long as a
    sequence get none.
    """

    def run(batches):
        from pyspark import TaskContext

        tokens, most = Tokens(path), how.length
        shard, slot = (TaskContext.get().partitionId() + 1) << 20, 0
        for block in _blocks(batches, tokens, id_col):
            names, splits = zip(*block)
            for own, (ids, ends) in zip(names, tokens.of(splits)):
                rows, begin = [], 0
                for at, end in enumerate(ends.tolist()):
                    for number, start in enumerate(range(begin, end, most)):
                        length = min(most, end - start)
                        crc = zlib.crc32(ids[start : start + length])
                        rows.append((at, number, start - begin, length, crc, shard, slot))
                        slot += 1
                        if slot == how.shard:
                            shard, slot = shard + 1, 0
                    begin = end
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [own.take(pa.array(columns[0], pa.int64()))]
                    + [pa.array(c, k) for c, k in zip(columns[1:], [pa.int32(), *[pa.int64()] * 5])],
                    [id_col, *PIECE.names],
                )

    schema = T.StructType([docs.schema[id_col], *PIECE.fields])
    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)


PIECE = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("shard", T.LongType()),
        T.StructField("slot", T.LongType()),
    ]
)


def best_fit(lengths: np.ndarray, places: np.ndarray, items: np.ndarray, room: int) -> np.ndarray:
    """Put ``items``, longest first, each into the fullest sequence that takes it, or into a new one.

    ``places`` has the sequence of every piece, or -1 for those that have none yet.
    """
    places = places.copy()
    held = places[places >= 0]
    used = np.bincount(held, lengths[places >= 0]).astype(np.int64) if len(held) else np.zeros(0, np.int64)
    open_bins = sorted((room - int(u), b) for b, u in enumerate(used.tolist()) if 0 < u < room)
    fresh = len(used)
    sizes = lengths.tolist()
    for item in sorted(items.tolist(), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        at = bisect_left(open_bins, (size, -1))
        if at < len(open_bins):
            left, place = open_bins.pop(at)
        else:
            left, place, fresh = room, fresh, fresh + 1
        places[item] = place
        if left > size:
            insort(open_bins, (left - size, place))
    return places


def _renumbered(places: np.ndarray) -> np.ndarray:
    return np.unique(places, return_inverse=True)[1]


def fitness(lengths: np.ndarray, places: np.ndarray, room: int) -> float:
    """Few sequences first; among equally many, the more unevenly filled, which leaves larger gaps to use."""
    used = np.bincount(places, lengths)
    return float(((used / room) ** 2).mean() - len(used))


def crossover(rng, lengths: np.ndarray, one: np.ndarray, other: np.ndarray, how: Evolution) -> np.ndarray:
    """Inject well-filled sequences of ``other`` into ``one``, drop those that repeat pieces, refit the displaced."""
    used = np.bincount(other, lengths)
    good = np.flatnonzero(used >= how.well_filled * how.length)
    if not len(good):
        good = np.argsort(-used)[: max(1, len(used) // 4)]
    chosen = good[rng.random(len(good)) < rng.uniform(0.1, 0.5)]
    injected = np.isin(other, chosen)
    broken = np.isin(one, np.unique(one[injected]))
    return _refit(rng, lengths, one, injected, other, broken, how)


def _refit(rng, lengths, one, injected, other, broken, how: Evolution) -> np.ndarray:
    child = np.where(injected, other + one.max(initial=0) + 1, np.where(broken, -1, one))
    used = np.bincount(child[child >= 0], lengths[child >= 0], minlength=1) if (child >= 0).any() else np.zeros(1)
    spare = np.flatnonzero((used > 0) & (used < how.length * how.well_filled))
    child = np.where(np.isin(child, spare) & (rng.random(len(child)) < 0.5), -1, child)  # shake the ill-filled
    kept = child >= 0
    compact = np.full(len(child), -1, np.int64)
    if kept.any():
        compact[kept] = _renumbered(child[kept])
    return _renumbered(best_fit(lengths, compact, np.flatnonzero(~kept), how.length))


def evolve(lengths: np.ndarray, guests: list[np.ndarray], seed: int, how: Evolution) -> np.ndarray:
    """The best packing an island finds in one epoch; it begins with ``guests`` and best-fit packings."""
    rng, n = np.random.default_rng(seed), len(lengths)
    least = -(-int(lengths.sum()) // how.length)
    best = lambda group: max(group, key=lambda p: fitness(lengths, p, how.length))
    none = np.full(n, -1, np.int64)
    group = list(guests) or [best_fit(lengths, none, np.arange(n), how.length)]
    if best(group).max(initial=-1) + 1 <= least:
        return best(group)
    while len(group) < how.population:
        mixed = rng.random(n) < 0.5
        first = best_fit(lengths, none, np.flatnonzero(mixed), how.length)
        group.append(_renumbered(best_fit(lengths, first, np.flatnonzero(~mixed), how.length)))
    for _ in range(how.generations):
        order = rng.permutation(len(group))
        for a, b in zip(order[::2], order[1::2]):
            for one, other in ((a, b), (b, a)):
                child = crossover(rng, lengths, group[one], group[other], how)
                worst = min(range(len(group)), key=lambda i: fitness(lengths, group[i], how.length))
                if fitness(lengths, child, how.length) > fitness(lengths, group[worst], how.length):
                    group[worst] = child
        if best(group).max(initial=-1) + 1 <= least:
            break
    return best(group)


ISLAND = "shard long, island int, slots array<long>, lengths array<long>, guests array<array<int>>, best array<int>, fit double"


def _epoch(islands: DataFrame, number: int, how: Evolution) -> DataFrame:
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                lengths = np.array(row["lengths"], np.int64)
                guests = [np.array(g, np.int64) for g in row["guests"]]
                seed = (row["shard"] * 31 + row["island"]) * 31 + number
                found = evolve(lengths, guests, seed & 0x7FFFFFFFFFFFFFFF, how)
                row["best"], row["fit"] = found.tolist(), fitness(lengths, found, how.length)
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    return islands.mapInArrow(run, ISLAND)


def pack_shards(pieces: DataFrame, how: Evolution) -> DataFrame:
    """Per shard: the slots of its pieces, their lengths, and the sequence that each got in the best packing."""
    shards = pieces.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("slot", "length"))).alias("own"))
    numbers = F.explode(F.sequence(F.lit(0), F.lit(how.islands - 1))).alias("island")
    islands = shards.select(
        "shard",
        numbers,
        F.col("own.slot").alias("slots"),
        F.col("own.length").alias("lengths"),
        F.array().cast("array<array<int>>").alias("guests"),
        F.array().cast("array<int>").alias("best"),
        F.lit(0.0).alias("fit"),
    )
    found = _epoch(islands, 0, how)
    for number in range(1, how.epochs):
        found = stage(found, "packing-islands")
        moved = found.select("shard", ((F.col("island") + 1) % how.islands).alias("island"), F.col("best").alias("guest"))
        met = found.join(moved, ["shard", "island"])
        met = met.select("shard", "island", "slots", "lengths", F.array("best", "guest").alias("guests"), "best", "fit")
        found = _epoch(met, number, how)
    best = F.max_by(F.struct("slots", "lengths", "best"), F.struct("fit", F.col("island"))).alias("b")
    return found.groupBy("shard").agg(best).select("shard", "b.slots", "b.lengths", F.col("b.best").alias("places"))


def _laid_out(shards: DataFrame, level: int, last: bool, how: Evolution) -> DataFrame:
    """Per piece: sequence and offset; ``again`` marks those of ill-filled sequences, to be pooled."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                places, lengths = np.array(row["places"], np.int64), np.array(row["lengths"], np.int64)
                order = np.argsort(places, kind="stable")
                ends = np.cumsum(lengths[order])
                first = np.concatenate([[True], places[order][1:] != places[order][:-1]])
                offsets = np.zeros(len(places), np.int64)
                starts = np.maximum.accumulate(np.where(first, ends - lengths[order], 0))
                offsets[order] = ends - lengths[order] - starts
                used = np.bincount(places, lengths)[places]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(places), row["shard"]), pa.int64()),
                        pa.array(row["slots"], pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array((level << 58) + (row["shard"] << 12) + places, pa.int64()),
                        pa.array(offsets, pa.int64()),
                        pa.array((used < how.well_filled * how.length) & (not last), pa.bool_()),
                    ],
                    ["shard", "slot", "length", "sequence_id", "offset", "again"],
                )

    return shards.mapInArrow(run, "shard long, slot long, length long, sequence_id long, offset long, again boolean")


def pack(docs: DataFrame, path: str, how: Evolution = Evolution(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    ``path`` is a tokenizer file that the executors have. The ids of a text are followed by
    one 0; null counts as empty, so it is a piece of length 1. Repeated rows and null ids are
    packed like any other; other columns do not matter.
    """
    pieces = stage(cut(docs, path, how, id_col, text_col), "packing-pieces")
    full = pieces.where(F.col("length") == how.length).select(
        "shard", "slot", (F.lit(15 << 58) + F.col("shard") * 4096 + F.col("slot")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    open_pieces = pieces.where(F.col("length") < how.length).select("shard", "slot", "length")
    count, level, done = open_pieces.count(), 0, full
    names = open_pieces.withColumns({"first_shard": F.col("shard"), "first_slot": F.col("slot")})
    while count:
        alone = count <= how.shard or level == 14
        placed = _laid_out(pack_shards(names.select("shard", "slot", "length"), how), level, alone, how)
        placed = stage(placed, f"packing-level-{level}")
        where = placed.drop("length").join(names.drop("length"), ["shard", "slot"])
        settled = where.where("NOT again").select(
            F.col("first_shard").alias("shard"), F.col("first_slot").alias("slot"), "sequence_id", "offset"
        )
        done = done.unionByName(settled)
        if alone:
            break
        count = placed.where("again").count()
        shards = max(1, -(-count // how.shard))
        spread = F.pmod(F.xxhash64("shard", "slot"), F.lit(shards))
        slot = F.row_number().over(Window.partitionBy("_next").orderBy("shard", "slot")).cast("long") - 1
        pool = placed.where("again").join(names.drop("length"), ["shard", "slot"]).withColumn("_next", spread)
        pool = pool.withColumn("_slot", slot)
        names = stage(
            pool.select(F.col("_next").alias("shard"), F.col("_slot").alias("slot"), "length", "first_shard", "first_slot"),
            f"packing-pool-{level}",
        )
        level += 1
    return pieces.join(done, ["shard", "slot"]).select(
        F.col(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
