"""SentencePiece models as lattices: streaming Viterbi encoding, decoding, exact prefix counts.

For every prefix of a text, one piece ends the encoding of that prefix. In a unigram model
it is the one of the best total score. In a BPE model it is the only one that byte-pair
merging leaves next to the piece before it: a sequence of pieces is the encoding of its
text exactly if merging leaves every two neighbours as they are, so back-pointers over
such pairs give the library's ids without replaying merges over the whole text.
"""

from __future__ import annotations

import re
from operator import add

import numpy as np

from sensorweave.llm.words import Recent

SPACE_MARK = "▁"
_CHUNKS = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+")
LONGEST_REMEMBERED = 64


class PieceModel:
    """The pieces of a model file, of type unigram or BPE, with an identity normaliser."""

    def __init__(self, path: str | None = None, *, pieces: list[tuple[str, float]] | None = None, unigram: bool = False):
        """From a file, or from (piece, score) pairs, whose numbers are their places, with the bytes after them."""
        if path:
            from sentencepiece import sentencepiece_model_pb2

            proto = sentencepiece_model_pb2.ModelProto()
            with open(path, "rb") as file:
                proto.ParseFromString(file.read())
            norm, kind = proto.normalizer_spec, proto.trainer_spec.model_type
            if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or kind not in (1, 2):
                raise ValueError("only unigram and BPE models that leave characters as they are")
            types = type(proto.pieces[0])
            self.unigram, self.dummy = kind == 1, norm.add_dummy_prefix
            rows = [(i, p.piece, p.score, p.type) for i, p in enumerate(proto.pieces)]
            normal = [(i, p, s) for i, p, s, t in rows if t in (types.NORMAL, types.USER_DEFINED)]
            self.bytes = [i for i, _, _, t in rows if t == types.BYTE]
            self.unknown, size = next(i for i, _, _, t in rows if t == types.UNKNOWN), len(rows)
            self.silent = {i for i, _, _, t in rows if t == types.CONTROL}
        else:
            normal = [(i, p, s) for i, (p, s) in enumerate(pieces or [])]
            self.unigram, self.dummy, size = unigram, True, len(normal) + 256
            self.bytes, self.unknown, self.silent = list(range(len(normal), size)), -1, set()
        self.ids = {p: i for i, p, _ in normal}
        self.scores = {i: s for i, _, s in normal}
        self.longest = max(map(len, self.ids), default=1)
        self.least = min(self.scores.values(), default=0.0) - 10.0
        self.by_chunk = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in self.ids)
        self.surface = [b""] * size
        for piece, i in self.ids.items():
            self.surface[i] = piece.replace(SPACE_MARK, " ").encode()
        for value, i in enumerate(self.bytes):
            self.surface[i] = bytes([value])
        self.pairs = Pairs(self)
        self.inner = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}

    def marked(self, text: str) -> str:
        """The text as the lattice sees it."""
        if not text:
            return ""
        return (SPACE_MARK if self.dummy else "") + text.replace(" ", SPACE_MARK)

    def chunks(self, marked: str) -> list[str]:
        """Words: parts that no piece reaches across. The whole where pieces may contain inner spaces."""
        return _CHUNKS.findall(marked) if self.by_chunk else [marked] if marked else []

    def split(self, chunk: str) -> list[str]:
        """Parts of a chunk between neighbours that stand side by side in no piece."""
        inner = self.inner
        cuts = [k for k, pair in enumerate(map(add, chunk, chunk[1:]), 1) if pair not in inner]
        return [chunk[a:b] for a, b in zip([0, *cuts], [*cuts, len(chunk)])] if cuts else [chunk]

    def ids_of(self, piece: str) -> list[int]:
        """A piece, or a character without one as its bytes."""
        found = self.ids.get(piece)
        if found is not None:
            return [found]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]

    def stays_apart(self, left: str, right: str) -> bool:
        """Whether merging neighbours, the best score first and of equals the leftmost, ends in these two pieces.

        A merge across their border settles that it does not.
        """
        parts, border, ids, scores = [*left, *right], len(left), self.ids, self.scores
        prices = [scores.get(ids.get(parts[k] + parts[k + 1])) for k in range(len(parts) - 1)]
        while True:
            best, at = None, -1
            for k, price in enumerate(prices):
                if price is not None and (best is None or price > best):
                    best, at = price, k
            if at < 0:
                return parts == ([left, right] if left else [right])
            if at == border - 1:
                return False
            if at < border:
                border -= 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del prices[at]
            if at:
                prices[at - 1] = scores.get(ids.get(parts[at - 1] + parts[at]))
            if at < len(prices):
                prices[at] = scores.get(ids.get(parts[at] + parts[at + 1]))


class Pairs(dict):
    """By two pieces: whether merging their characters ends in just these two. Of one piece, the first is empty."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, pair: tuple[str, str]) -> bool:
        if len(self) > 1_000_000:
            self.clear()
        left, right = pair
        found = self[pair] = self.model.stays_apart(left, right)
        return found


class Stream:
    """Viterbi over a text that arrives in parts.

    Back-pointers are kept for a window: the places that a further piece can start from, as
    many as the longest piece has characters, and what leads to them. When all their paths
    run through one boundary, the ids before it are final and leave the window.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        self.text = ""
        self.back = [0]
        self.cost = [0.0]
        self.ends = [""]  # the piece that ends at each place; at first the last final one

    def _piece(self, end: int) -> str:
        return self.text[self.back[end] : end]

    def _grow(self) -> None:
        """Back-pointers for all places that have none yet."""
        model, text, back = self.model, self.text, self.back
        ids, longest = model.ids, model.longest
        if model.unigram:
            for end in range(len(back), len(text) + 1):
                best = None
                for start in range(max(0, end - longest), end):
                    i = ids.get(text[start:end])
                    price = model.scores[i] if i is not None else model.least if start == end - 1 else None
                    if price is not None and (best is None or self.cost[start] + price > best[0]):
                        best = (self.cost[start] + price, start)
                self.cost.append(best[0])
                back.append(best[1])
            return
        pairs, ends = model.pairs, self.ends
        for end in range(len(back), len(text) + 1):
            for start in range(end - longest if end > longest else 0, end):
                piece = text[start:end]
                if (piece in ids or start == end - 1) and pairs[ends[start], piece]:
                    back.append(start)
                    ends.append(piece)
                    break

    def feed(self, part: str) -> list[int]:
        """Take more (marked) text; gives the ids that have become final."""
        out: list[int] = []
        for start in range(0, len(part), self.model.longest):
            self.text += part[start : start + self.model.longest]
            self._grow()
            out += self._settle()
        return out

    def _settle(self) -> list[int]:
        end = len(self.text)
        alive = set(range(max(0, end - self.model.longest + 1), end + 1))
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(self.back[last])
        return self._commit(alive.pop())

    def path(self, end: int) -> list[int]:
        """The ids on the best path from the start of the window to a place."""
        pieces = []
        while end:
            pieces.append(self._piece(end))
            end = self.back[end]
        return [i for piece in reversed(pieces) for i in self.model.ids_of(piece)]

    def _commit(self, boundary: int) -> list[int]:
        if not boundary:
            return []
        out = self.path(boundary)
        self.ends = self.ends[boundary:]
        self.text = self.text[boundary:]
        self.back = [max(0, b - boundary) for b in self.back[boundary:]]
        if self.model.unigram:
            self.cost = [c - self.cost[boundary] for c in self.cost[boundary:]]
        return out

    def finish(self) -> list[int]:
        """The end of the text: the path to its last place is final."""
        out = self._commit(len(self.text))
        self.__init__(self.model)
        return out


def encode(model: PieceModel, text: str) -> list[int]:
    """All ids of one text, without remembering anything."""
    stream = Stream(model)
    out = stream.feed(model.marked(text))
    return out + stream.finish()


def prefix_counts(model: PieceModel, parts: list[str]):
    """Of each (marked) part, the tokens of the encoding of each non-empty prefix; by dynamic programming.

    What was worked out for a prefix holds for every part that begins with it, so sorted parts
    are cheapest: each goes on where it differs from the one before.
    """
    stream, counts, ids = Stream(model), [0], model.ids
    back = stream.back
    for part in parts:
        same, before = 0, stream.text
        most = min(len(part), len(before))
        while same < most and part[same] == before[same]:
            same += 1
        del back[same + 1 :], stream.ends[same + 1 :], stream.cost[same + 1 :], counts[same + 1 :]
        stream.text = part
        stream._grow()
        for end in range(same + 1, len(part) + 1):
            start = back[end]
            piece = part[start:end]
            counts.append(counts[start] + (1 if piece in ids else len(model.ids_of(piece))))
        yield counts[1:]


def encoded_parts(model: PieceModel, parts: list[str]):
    """Ids of each (marked) part as little-endian 32-bit bytes.

    Long parts stream through a window. Of short ones, which fit into it, each goes on where it
    differs from the one before, so sorted parts are cheapest; at their end all paths meet.
    """
    stream = Stream(model)
    for part in parts:
        if len(part) > LONGEST_REMEMBERED:
            own = Stream(model)
            ids = own.feed(part)
            yield np.array(ids + own.finish(), "<u4").tobytes()
            continue
        same, before = 0, stream.text
        most = min(len(part), len(before))
        while same < most and part[same] == before[same]:
            same += 1
        del stream.back[same + 1 :], stream.ends[same + 1 :], stream.cost[same + 1 :]
        stream.text = part
        stream._grow()
        yield np.array(stream.path(len(part)), "<u4").tobytes()


class Encoder:
    """Ids of the texts of one task; those of a word are worked out once. What is known is bounded."""

    def __init__(self, model: PieceModel, most: int = 1_200_000, most_parts: int = 400_000):
        self.model = model
        self.parts: Recent = Recent(most_parts)
        self.known: Recent = Recent(most)

    def of(self, texts: list[str]) -> list[bytes]:
        model = self.model
        found = [model.chunks(model.marked(t)) for t in texts]
        fresh = {word: model.split(word) for word in self.known.lacking(set().union(*found))}
        parts = sorted(self.parts.lacking({p for own in fresh.values() for p in own}))
        self.parts.update(zip(parts, encoded_parts(model, parts)))
        for word, own in fresh.items():
            self.known[word] = b"".join([self.parts[p] for p in own])
        return [b"".join(map(self.known.__getitem__, words)) for words in found]


def decode(model: PieceModel, ids) -> str:
    """The text of ids; bytes that form no character become the replacement character."""
    text = b"".join([model.surface[i] for i in ids if i not in model.silent]).decode("utf-8", "replace")
    return text[1:] if model.dummy and text.startswith(" ") else text
