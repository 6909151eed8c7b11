"""Quality rules and toxicity: measures against brute force, verdicts on rows that were held out."""

import re
import tracemalloc
import zlib

import numpy as np
import pytest

from sensorweave.llm import catalog, linear, quality, toxicity
from sensorweave.llm.words import covered, distinct, repeated_windows, words_of

FOLDER = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k : k + 8]), []).append(k)
    inside = {k + i for starts in windows.values() if len(starts) > 1 for k in starts for i in range(8)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


ODD = [None, "", " \n\t ", "a", "é " * 30, "x y z\n" * 12, "word " * 5000, "a b c d e f g h " * 2 + "q r s # | <", "\n\nq\n \nq\n"]


def test_repeated_windows_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(200):
        ids, size = rng.integers(0, 3, rng.integers(0, 40)), int(rng.integers(2, 9))
        windows = [tuple(ids[k : k + size]) for k in range(len(ids) - size + 1)]
        expected = [windows.count(w) > 1 for w in windows]
        found = repeated_windows(ids, size)
        assert found.tolist() == expected
        inside = {k + i for k, hit in enumerate(expected) if hit for i in range(size)}
        assert covered(found, size, len(ids)) == len(inside)
    assert distinct(np.array([3, 1, 3])).tolist() == [1, 3] and len(distinct(np.zeros(0))) == 0


@pytest.fixture(scope="module")
def blank():
    grams = linear.Grams()
    return linear.Model(grams, np.zeros(1 << grams.bits, np.float32), 1.0)


def test_measures_of_odd_texts(spark, blank):
    rows = [(i, t, "clash", 1) for i, t in enumerate(ODD)] + [(None, "twice", "clash", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text string, n_words int")
    found = quality.score(docs, blank).collect()
    assert len(found) == len(rows)
    for row in found:
        text = ODD[row["doc_id"]] if row["doc_id"] is not None else "twice"
        assert tuple(row)[1:7] == measures(text)
        assert row["kept"] == (not row["base_failed"])
    kept = quality.keep(docs, blank)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in found if r["kept"])
    assert quality.score(docs.limit(0), blank).count() == 0 and quality.keep(docs.limit(0), blank).count() == 0


def test_quality_query_against_brute_force_and_labels(spark):
    docs = {r["doc_id"]: r["text"] for r in catalog.table(spark, FOLDER, "documents").collect()}
    found = {r["doc_id"]: r for r in catalog.op1_quality_rules(spark, FOLDER).collect()}
    assert found.keys() == docs.keys()
    assert all(tuple(found[i])[1:7] == measures(t) for i, t in docs.items())
    labels = [(r["quality"], found[r["doc_id"]]) for r in catalog.table(spark, FOLDER, "labels").collect()]
    passed = [(label, row["kept"]) for label, row in labels if not row["base_failed"]]
    assert np.mean([bool(label) == kept for label, kept in passed]) > 0.95


def test_quality_on_unseen_rows(spark):
    labels = catalog.table(spark, FOLDER, "labels")
    docs = catalog.table(spark, FOLDER, "documents")
    model = quality.fit(docs, labels.where("doc_id % 4 <> 0"))
    rows = quality.score(docs.where("doc_id % 4 = 0"), model).join(labels.select("doc_id", F_label()), "doc_id").collect()
    passed = [r for r in rows if not r["base_failed"]]
    assert np.mean([r["kept"] == bool(r["label"]) for r in passed]) > 0.9


def F_label():
    from pyspark.sql import functions as F

    return F.col("quality").alias("label")


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1, 0)], [(None, None, None), (2, 1, 0), (2, 0, 1)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        model = quality.fit(docs, table)
        assert 0 < model.probability(np.array([model.intercept]))[0] < 1
        assert toxicity.score(docs, toxicity.fit(docs, table)).count() == 2


def test_sample_is_bounded_and_balanced(spark):
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)], "doc_id long, toxic int")
    clean = linear.clean_labels(labels.union(labels), "doc_id", "toxic")
    sample = linear.bounded_sample(clean, 100).collect()
    assert sorted(r["_label"] for r in sample) == [0] * 50 + [1] * 50


def test_fit_reaches_the_minimum():
    rng = np.random.default_rng(1)
    places = [distinct(rng.integers(0, 30, 8)) for _ in range(200)]
    labels = np.array([float(3 in p) for p in places])
    rows = linear.Rows(np.array([len(p) for p in places]), np.concatenate(places), list(range(200)))
    weights, intercept = linear.logistic(rows, labels, np.ones(200, bool), 30, 1e-3, steps=200)
    z = rows.margins(weights, intercept)
    slope = rows.transposed((1 / (1 + np.exp(-z)) - labels) / 200, 30) + 1e-3 * weights
    assert np.abs(slope).max() < 1e-2 and ((z > 0) == (labels > 0)).all()


WORDLIST = "the idiot and a clown went stupid of pathetic loser then again idiots clowning".split()


@pytest.fixture(scope="module")
def decoder():
    counts = toxicity._gram_counts(WORDLIST, [50] * len(WORDLIST), toxicity.Folding())
    return toxicity.Decoder(toxicity.smoothed(counts))


@pytest.mark.parametrize(
    "written, meant",
    [
        ("1d10t", "idiot"),
        ("Idiiiiot!!", "idiot"),
        ("cl0wn", "clown"),
        ("$tupid", "stupid"),
        ("p4th3tic", "pathetic"),
        ("l.o.s.e.r", "loser"),
        ("l-o-s-e-r", "loser"),
        ("clown$$$", "clown"),
        ("plain", "plain"),
        ("1234", "1234"),
        ("***", "***"),
    ],
)
def test_disguises(decoder, written, meant):
    assert decoder.word(written.lower()) == meant


def test_spaced_out_letters(decoder):
    assert decoder.words("the i d i o t went") == ["the", "idiot", "went"]
    assert decoder.restore("The  i d i o t,\nw3nt") .startswith("the  ")
    assert decoder.words("") == [] and decoder.restore("") == ""


def test_search_finds_the_cheapest_path(decoder):
    """Against all readings of short strings."""
    from itertools import product

    def cost(symbols):
        total, state = 0.0, 0
        for code in symbols:
            if code or state % toxicity.SYMBOLS:
                total += decoder.costs[state * toxicity.SYMBOLS + code]
            state = 0 if not code else (state * toxicity.SYMBOLS + code) % toxicity.SYMBOLS**3
        return total + (decoder.costs[state * toxicity.SYMBOLS] if state else 0.0)

    for text in ("1d10t", "cl0wn", "a.b.c", "5tup1d"):
        options = []
        for char in text:
            at = {"text": char}["text"]
            options.append([(r, p) for _, r, p in decoder._arcs(at, 0)])
        ways = []
        for way in product(*options):
            reading = "".join(r for r, _ in way)
            codes = [0 if c == " " else decoder.folding[c] for c in reading]
            ways.append((sum(p for _, p in way) + cost(codes), " ".join(reading.split(" ")).strip()))
        assert decoder.read(text) in {r for c, r in ways if c < min(ways)[0] + 1e-9}


def test_toxicity_query(spark):
    found = catalog.op7_toxicity(spark, FOLDER).collect()
    assert len(found) == 1000
    labels = {r["doc_id"]: r["toxic"] for r in catalog.table(spark, FOLDER, "labels").collect()}
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
    held = [(labels[r["doc_id"]], r["score"]) for r in found if r["held_out"] and r["doc_id"] in labels]
    ones, zeros = [s for y, s in held if y], [s for y, s in held if not y]
    assert np.mean([a > b for a in ones for b in zeros]) > 0.75


def test_held_out_labels_do_not_matter(spark):
    from pyspark.sql import functions as F

    docs, labels = (catalog.table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    flipped = labels.withColumn(
        "toxic", F.when(toxicity.fold_of("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    one, other = (toxicity.fit(docs, t).model for t in (labels, flipped))
    assert (one.weights == other.weights).all() and one.offset == other.offset


def test_toxicity_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a" * 50_000, "x"), (3, "w0rd " * 3000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    costs = toxicity.character_model(docs)
    assert np.allclose(np.exp(-costs.reshape(-1, 27)).sum(axis=1), 1)
    grams = toxicity.Settings().grams
    scorer = toxicity.Scorer(costs, linear.Model(grams, np.zeros(1 << grams.bits, np.float32), -1.0))
    found = toxicity.score(docs, scorer).collect()
    assert len(found) == 5 and [r["held_out"] for r in found if r["doc_id"] is None] == [False]
    assert toxicity.keep_clean(docs, scorer).schema == docs.schema
    assert toxicity.keep_clean(docs, scorer).count() == 5
    assert toxicity.score(docs.limit(0), scorer).count() == 0
    restored = {r["restored"] for r in toxicity.restore(docs, costs).collect()}
    assert None in restored and "" in restored


def test_words():
    assert words_of(None) == [] and words_of("a\x0bb\xa0c d") == ["a", "b\xa0c", "d"]


def test_matrix_in_blocks_against_dense():
    rng = np.random.default_rng(5)
    features = [distinct(rng.integers(0, 50, n)).astype(np.int32) for n in [0, 3, 40, 0, 1, 60, 7, 0]]
    dense = np.array([np.isin(np.arange(50), x) * linear.scale(len(x)) for x in features])
    weights, values = rng.normal(size=50), rng.normal(size=len(features))
    for block in (1, 8, 1000):
        rows = linear.Rows.of(features, block)
        assert np.allclose(rows.margins(weights, 0.5), dense @ weights + 0.5)
        assert np.allclose(rows.transposed(values, 50), values @ dense)
    assert len(linear.Rows.of([]).margins(weights, 0.0)) == 0 and not linear.Rows.of([]).transposed(np.zeros(0), 50).any()


def test_fit_holds_little_beside_its_rows():
    import pyarrow as pa

    rng = np.random.default_rng(6)
    grams, size, each = linear.Grams(bits=12), 1000, 2000
    places = np.concatenate([np.sort(rng.permutation(1 << grams.bits)[:each]) for _ in range(size)]).astype(np.int32)
    labels = (rng.normal(size=1 << grams.bits)[places].reshape(size, each).sum(1) > 0).astype(int)

    def batches(n):
        for start in range(0, size, n):
            held = places[start * each : (start + n) * each]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(held) + 1, each, np.int32)), pa.array(held))
            ids, own = pa.array(range(start, start + len(lists))), pa.array(labels[start : start + n].tolist())
            yield pa.RecordBatch.from_arrays([ids, own, lists], ["_id", "_label", "_places"])

    def fitted(n):
        return next(linear._fit(grams, 1e-4, {0: 1, 1: 1})(batches(n))).to_pydict()

    tracemalloc.start()
    found = fitted(100)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(places)  # bytes; 32 and more while whole columns were made of all features
    assert found == fitted(size)


def test_pipeline_hands_few_rows_to_python_at_once(spark):
    import corpus_pipeline
    from sensorweave.session import ARROW_ROWS, arrow_rows, at_most_arrow_rows

    docs = spark.range(1200, numPartitions=1).selectExpr("id AS doc_id", "'plain words here' AS text")
    with arrow_rows(spark, 10_000):
        corpus_pipeline.sequences(spark, docs, FOLDER)
        sizes = docs.mapInArrow(lambda batches: (b.select([0]).slice(0, 1) for b in batches), "doc_id long").count()
        assert sizes == -(-1200 // corpus_pipeline.ROWS_AT_ONCE)
        for now, then in (("0", "500"), ("20", "20")):
            spark.conf.set(ARROW_ROWS, now)
            at_most_arrow_rows(spark, 500)
            assert spark.conf.get(ARROW_ROWS) == then
        before = spark.conf.get(ARROW_ROWS)
        with pytest.raises(ZeroDivisionError), arrow_rows(spark, 3):
            assert spark.conf.get(ARROW_ROWS) == "3" and 1 / 0
        assert spark.conf.get(ARROW_ROWS) == before
