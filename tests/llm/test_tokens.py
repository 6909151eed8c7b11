"""Token counts, SentencePiece ids and packing, against the libraries and brute force."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorweave.llm import catalog, encoding, packing, token_counts
from sensorweave.llm.pieces import Encoder, PieceModel, Stream, decode, encode

FOLDER = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "a", "  two  spaces ", "<s> </s>", "ﬁ　中漢", "\n\t\x0b", "▁mark", "x" * 3000, "<|endoftext|> a", "a b\u0085c", "İ é é Σς", "it's 12½ ²", "word " * 2500]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def model():
    return PieceModel(PIECES)


def random_texts(count, letters="abcdethionsr   ▁<s>éß中\n\t0123'."):
    rng = random.Random(5)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(count)]


def test_ids_are_those_of_the_library(model, library):
    fast = Encoder(model)
    for text in random_texts(300) + [t for t in ODD if t]:
        ids = library.encode(text)
        assert encode(model, text) == ids
        assert np.frombuffer(fast.of([text])[0], "<u4").tolist() == ids
        assert decode(model, ids) == library.decode(ids)


def test_counts_of_all_prefixes(library):
    counter = token_counts.Counter(PIECES)
    for text in random_texts(60):
        assert counter.counts(text).tolist() == [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        assert counter.totals_of([text, text]) == [len(library.encode(text))] * 2


def test_window_is_bounded(model):
    stream, longest, ids = Stream(model), 0, []
    text = model.marked("therefore the stream forgets what is final " * 50)
    for k in range(0, len(text), 7):
        ids += stream.feed(text[k : k + 7])
        longest = max(longest, len(stream.text))
    assert longest <= 4 * model.longest
    assert ids + stream.finish() == encode(model, "therefore the stream forgets what is final " * 50)


def test_unigram_against_all_segmentations():
    rng = random.Random(2)
    letters = "ab▁"
    pieces = {c: -3.0 - rng.random() for c in letters}
    for _ in range(12):
        pieces["".join(rng.choice(letters) for _ in range(rng.randint(2, 4)))] = -2.0 - 4 * rng.random()
    rows = list(pieces.items())
    model = PieceModel(pieces=rows, unigram=True)

    def best(text):
        cost, back = [0.0], [0]
        for end in range(1, len(text) + 1):
            options = [(cost[s] + pieces[text[s:end]], s) for s in range(end) if text[s:end] in pieces]
            cost.append(max(options)[0])
            back.append(max(options)[1])
        return cost[-1]

    for _ in range(100):
        text = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 40)))
        ids = encode(model, text)
        assert abs(sum(rows[i][1] for i in ids) - best(model.marked(text))) < 1e-9
        assert decode(model, ids) == text


def frame(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a b", "x")] * 2, "doc_id long, text string, n_tokens string")


def test_count_and_store(spark, library):
    docs = frame(spark)
    stored = token_counts.store(docs, PIECES)
    asked = stored.select(
        "doc_id", "n_bytes", "n_tokens",
        token_counts.tokens_of(F.col("prefix_tokens"), 5).alias("five"),
        token_counts.fitting(F.col("prefix_tokens"), 3).alias("fits"),
        token_counts.fitting(F.col("prefix_tokens"), -1).alias("never"),
    ).collect()
    counted = {(r["doc_id"], r["n_tokens"]): r for r in token_counts.count(docs, PIECES, 3).collect()}
    for row in asked:
        text = (ODD[row["doc_id"]] if row["doc_id"] is not None else "a b") or ""
        assert row["n_tokens"] == len(library.encode(text)) and row["n_bytes"] == len(text.encode())
        assert row["five"] == len(library.encode(text[:5])) and row["never"] is None
        other = counted[row["doc_id"], row["n_tokens"]]
        assert other["over_limit"] == (row["n_tokens"] > 3)
        assert other["fitting_chars"] == row["fits"]
        if len(text) < 100:
            assert row["fits"] == max(k for k in range(len(text) + 1) if len(library.encode(text[:k])) <= 3)
    assert token_counts.count(docs.limit(0), PIECES, 3).count() == 0 == token_counts.store(docs.limit(0), PIECES).count()


def test_count_query(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in catalog.table(spark, FOLDER, "documents").collect()}
    for row in catalog.op3_token_counts(spark, FOLDER).collect():
        text = docs.pop(row["doc_id"])
        n = len(library.encode(text))
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), n, n > 4096)
    assert not docs


def test_encoding_query_and_columns(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in catalog.table(spark, FOLDER, "documents").collect()}
    for row in catalog.op6_piece_ids(spark, FOLDER).collect():
        ids = library.encode(docs[row["doc_id"]])
        assert row["n_tokens"] == len(ids) and row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert row["round_trip"] == (library.decode(ids) == docs[row["doc_id"]])
    rows = encoding.decode_column(encoding.encode_column(frame(spark), PIECES), PIECES).collect()
    for row in rows:
        assert row["ids"] == (None if row["text"] is None else library.encode(row["text"]))
        assert row["text"] is None or row["decoded"] == row["text"] or "▁" in row["text"]
    assert encoding.digest(frame(spark).limit(0), PIECES).count() == 0


def check_packing(rows, texts, tokenizer, length):
    """Every document in full, pieces cut only at the length, sequences gapless and within the length."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, pieces in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        pieces.sort(key=lambda r: r["piece"])
        assert [r["start"] for r in pieces] == list(range(0, len(ids), length))
        assert [r["length"] for r in pieces] == [min(length, len(ids) - s) for s in range(0, len(ids), length)]
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in pieces])
        assert [r["offset"] for r in pieces] == [0, *ends[:-1]] and ends[-1] <= length
    return len(by_sequence), -(-sum(r["length"] for r in rows) // length)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def test_packing_query(spark, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in catalog.table(spark, FOLDER, "documents").collect()}
    used, least = check_packing(catalog.op10_packing(spark, FOLDER).collect(), texts, tokenizer, 2048)
    assert used <= least + 1


def test_packing_in_small_shards(spark, tokenizer):
    """Shards of a few pieces: islands, migration and several levels of pooling."""
    how = packing.Evolution(length=300, shard=20, islands=3, epochs=3)
    docs = catalog.table(spark, FOLDER, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    used, least = check_packing(packing.pack(docs, WORDS, how).collect(), texts, tokenizer, 300)
    assert used <= 1.02 * least + 1


def test_packing_of_odd_rows(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)], "doc_id long, text string, length int")
    rows = packing.pack(docs, WORDS).collect()
    assert {r["doc_id"] for r in rows} == set(range(len(ODD)))
    check_packing(rows, dict(enumerate(ODD)), tokenizer, 2048)
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert [r["length"] for r in packing.pack(twice, WORDS).orderBy("doc_id").collect()] == [1, 3, 3]
    assert packing.pack(docs.limit(0), WORDS).count() == 0


def ids_of(tokens, splits):
    return [p.tolist() for ids, ends in tokens.of(splits) for p in np.split(ids, ends[:-1])]


def test_packing_splits_as_the_library_does(tokenizer):
    """Any characters in any order, in blocks of several slices, also where words are forgotten in between."""
    tokens = packing.Tokens(WORDS, most=50)
    texts = [f"a{c}b {c} {c}'s A{c}LL {c}{c}9" for c in map(chr, range(0x370)) if c != "\n"] + [t or "" for t in ODD]
    texts += random_texts(2000, "abcdelmrstvABE   \n\x0b''’!.<|>½²39éÅßȺİΣς́̈́中한가\x00\x85\xa0 🙂")
    texts += ["x'll've'tt 're'rex !'s 's''s", "<|endoftext|>x <|ENDOFTEXT|> <|end <| oftext|>", "́ ́á", "'" * 9]
    texts += [t[:k] + " " + t[k:] for t in random_texts(200, "中한Σς \n’İé") for k in (0, 3, len(t))]
    known = []
    for at in range(0, len(texts), 300):
        block = [texts[k : k + 100] for k in range(at, min(at + 300, len(texts)), 100)]
        found = ids_of(tokens, [tokens.split(part) for part in block])
        known.append(len(tokens.words))
        for text, ids in zip([t for part in block for t in part], found, strict=True):
            assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID], text
    assert min(known) < max(known)
    assert ids_of(tokens, [tokens.split([""])]) == [[packing.END_ID]]


def test_packing_works_out_distinct_words_only(monkeypatch):
    """A word that is known costs no step of its own, and one odd character does not send a text to the library."""
    tokens, asked = packing.Tokens(WORDS), []
    for name in ("_plain", "_library"):
        work = getattr(tokens, name)
        monkeypatch.setattr(tokens, name, lambda words, name=name, work=work: asked.extend((name, w) for w in words) or work(words))
    texts = ["the cat’s milk and the dog's milk " * 200, "THE Cat"]
    for _ in range(3):
        list(tokens.of([tokens.split(texts), tokens.split(texts[::-1])]))
    plain = [b"'s", b"and", b"cat", b"dog", b"milk", b"the"]
    assert sorted(asked) == [("_library", "cat’s".encode()), *(("_plain", w) for w in plain)]


def test_what_packing_knows_is_bounded():
    """Also if nobody asks for more than there is: a block adds its own words, then frequent short ones stay."""
    tokens, asked = packing.Tokens(WORDS, most=1000), []
    work = tokens._plain
    tokens._plain = lambda words: asked.extend(words) or work(words)
    for k in range(40):
        texts = [f"the q{chr(97 + k % 26) * (k // 26 + 1)}x{chr(97 + j % 26) * (j // 26 + 1)} {'y' * 100}{j}" for j in range(100)]
        splits = [tokens.split([*texts, "é" * 50_000 + "\x85"])]
        assert len([end for _, (_, end) in zip(splits, tokens.of(splits))]) == 1
        assert len(tokens.words) <= 1000 + 100 + 20 and tokens.words.nbytes < 64_000 + 110_000
    assert len(asked) > 4000 and asked.count(b"the") == 1 and asked.count(b"y" * 100) > 1


def test_packing_of_letters_that_grow(spark, tokenizer):
    """Small letters of these lie beyond U+0300, where they are letters still."""
    texts = {0: "ȺȾ aȺb", 1: "plain"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_packing(packing.pack(docs, WORDS).collect(), texts, tokenizer, 2048)


def test_evolution_keeps_every_piece():
    rng = np.random.default_rng(8)
    how = packing.Evolution(length=100, generations=6)
    for seed in range(15):
        lengths = rng.integers(1, 100, rng.integers(1, 60))
        places = packing.evolve(lengths, [], seed, how)
        used = np.bincount(places, lengths)
        assert len(places) == len(lengths) and (used > 0).all() and (used <= 100).all()
        first = packing.best_fit(lengths, np.full(len(lengths), -1), np.arange(len(lengths)), 100)
        assert len(used) <= first.max() + 1
