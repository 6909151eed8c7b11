"""Words, lines and hashes of texts inside Arrow batches."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable
from typing import Any

import numpy as np
import xxhash

# What separates words, and the class of a word, in every operator here.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_WORDS = re.compile(WORD)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# A task forgets its words when it knows more than this many: its memory stays bounded.
KNOWN_WORDS = 300_000

# Bytes of text that a task takes apart at once.
TEXT_BYTES = 1 << 19


def slices(batches, text_col: str = "_text"):
    """Arrow batches again, cut to a bounded number of bytes of text each, but to a row at least."""
    for batch in batches:
        sizes = _sizes(batch, text_col)
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > TEXT_BYTES:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size + 1
        if len(sizes) > start or not len(sizes):
            yield batch.slice(start)


def _sizes(batch, text_col: str) -> list[int]:
    import pyarrow.compute as pc

    lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text_col)))
    return pc.fill_null(lengths, 0).to_pylist()


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text) if text else []


def lower_ascii(text: str) -> str:
    """Lower-case A-Z only."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def hash64(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


class Numbers(dict):
    """Numbers words in the order of first sight; ``fresh`` lists those not yet looked at."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def kept_in_worker(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python worker, which works on task after task.

    Only for memories that change no result; they must be bounded, as they stay as long as the worker.
    """
    home = sys.modules.setdefault("_sensorweave_llm_kept", types.ModuleType("_sensorweave_llm_kept"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


class Recent(dict):
    """What was worked out lately, in two generations: the older one goes when the younger one is full.

    So what is used all the time is never worked out again, and what is known stays bounded.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most // 2, {}

    def lacking(self, keys: set) -> set:
        """Those of ``keys`` that are not known; the others are in the younger generation after this."""
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        # Asked key by key: set arithmetic would go through all that is known.
        new, older = set(), self.older
        for key in keys:
            if key not in self:
                if key in older:
                    self[key] = older[key]
                else:
                    new.add(key)
        return new


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def chain64(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` neighbouring hashes, in order; by doubling."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, width = mix64(hashes ^ np.uint64(size)), 1
    while width < size:
        step = min(width, size - width)
        out = mix64(out[: len(out) - step] * np.uint64(0x9E3779B97F4A7C15) + out[step:])
        width += step
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def repeated_windows(ids: np.ndarray, size: int) -> np.ndarray:
    """Which windows of ``size`` word numbers occur twice or more. Exact.

    Equal windows have equal hashes, so distinct hashes prove that nothing repeats. Only
    otherwise are windows ranked exactly, by doubling.
    """
    n = len(ids) - size + 1
    if n < 2:
        return np.zeros(max(n, 0), bool)
    if len(distinct(chain64(ids.astype(np.uint64), size))) == n:
        return np.zeros(n, bool)
    rank, width = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    while width < size:
        step = min(width, size - width)
        m = len(rank) - step
        rank = np.unique((rank[:m] << 32) | rank[step : step + m], return_inverse=True)[1].astype(np.int64)
        width += step
    return np.bincount(rank)[rank] > 1


def covered(starts: np.ndarray, size: int, length: int) -> int:
    """How many of ``length`` places lie in a window of ``size`` that begins at a marked start."""
    edges = np.zeros(length + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))
