"""Importance resampling against a plain count in Python, and SQL."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from compare import connect, difference

from sensorweave.llm import catalog, importance
from sensorweave.llm.importance import Cutter, Draw
from sensorweave.llm.spread import join_classes, numbered
from sensorweave.llm.words import lower_ascii

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, score int, rank string, id string, buckets string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_features(text, how):
    words = WORD.findall(lower_ascii(text or ""))
    return words, [" ".join(words[k : k + s]) for s in range(1, how.longest + 1) for k in range(len(words) - s + 1)]


def expected(rows, target, how):
    own = [plain_features(t, how) for _, t in rows]
    bucket = lambda f: zlib.crc32(f.encode()) % how.buckets
    s, t = [0] * how.buckets, [0] * how.buckets
    for _, features in own:
        for f in features:
            s[bucket(f)] += 1
    for text in target:
        for f in plain_features(text, how)[1]:
            t[bucket(f)] += 1
    every, wanted = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (every + how.buckets) / ((s[b] + 1) * (wanted + how.buckets)))) for b in range(how.buckets)]
    found = []
    for (i, _), (words, features) in zip(rows, own):
        weight = sum(gain[bucket(f)] for f in features) // max(1, len(features))
        name = f"{how.seed}:{'' if i is None else i}"
        u = (int(hashlib.sha256(name.encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        found.append([i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log(u))), None, len(words)])
    ready = sorted((r for r in found if r[5] >= how.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k in range(how.percent * len(ready) // 100):
        ready[k][4] = k + 1
    return sorted(map(tuple, found), key=repr)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", "z") for i, t in rows], SCHEMA)


def check(spark, rows, target, how):
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    found = importance.resample(docs_of(spark, rows), aim, how)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows, target, how)


def texts(rng, number):
    for k in range(number):
        yield k, rng.choice(" \n-_") .join(rng.choice(["W", "ü", "x9", "É", ""]) + str(rng.randrange(60)) for _ in range(rng.randrange(60)))


@pytest.mark.parametrize("how", [Draw(), Draw(longest=3, buckets=97, percent=50, least_words=5, seed=1)])
def test_against_plain_counts(spark, how):
    rng = random.Random(how.longest)
    rows = list(texts(rng, 150)) + [(None, None), (None, "a b " * 30), (900, ""), (901, "..."), (902, "é " * 40_000)]
    check(spark, rows + [rows[3]] * 5 + [rows[0]] * 2, [t for _, t in texts(rng, 20)] + [None, ""], how)


def test_empty_tables(spark):
    check(spark, list(texts(random.Random(2), 40)), [], Draw())
    check(spark, [], ["a b"], Draw())
    check(spark, [], [], Draw())


def test_query_against_plain_counts_and_sql(spark):
    query = catalog.QUERIES["op12_importance_resampling"](spark, FOLDER)
    rows = [(r["doc_id"], r["text"]) for r in catalog.table(spark, FOLDER, "documents").collect()]
    target = [r["text"] for r in catalog.table(spark, FOLDER, "benchmark").collect()]
    assert sorted((tuple(r) for r in query.collect()), key=repr) == sorted((r[:5] for r in expected(rows, target, Draw())), key=repr)
    assert difference(query, connect(FOLDER), catalog.SQL["op12_importance_resampling"]) is None


def test_offsets(spark, monkeypatch):
    text = "It's 3 Über-long  wörds, ok? \x00 A_b"
    rows = importance.windows(docs_of(spark, [(1, text), (2, None)]), Draw(longest=2)).collect()
    found = {r["doc_id"]: [tuple(w) for w in r["windows"]] for r in rows}
    shown = [lower_ascii(text[a:b]) for a, b, _ in found[1]]
    words = ["it", "s", "3", "Über".replace("U", "u"), "long", "wörds", "ok", "a", "b"]
    assert shown[:9] == words and shown[9] == "it's" and shown[12] == words[3] + "-long" and len(shown) == 17
    assert [b for _, _, b in found[1]] == [zlib.crc32(f.encode()) % 10_000 for f in plain_features(text, Draw(longest=2))[1]]
    assert found[2] == []
    for block in (1, 3, 20):
        monkeypatch.setattr(importance, "TEXT_BLOCK", block)
        cutter = Cutter(Draw(longest=2))
        assert [tuple(w) for w in cutter.windows(text)] == found[1]
        number, buckets = cutter.buckets(text)
        assert number == 9 and buckets.tolist() == [b for _, _, b in found[1]] and buckets.dtype == np.dtype("<u2")


def test_numbers_and_classes(spark):
    rows = spark.range(3000).selectExpr("id", "pmod(hash(id), 7) AS k")
    rows.write.mode("overwrite").parquet(f"{spark.conf.get('spark.checkpoint.dir')}/numbered-rows")
    rows = spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/numbered-rows")
    from pyspark.sql import functions as F

    placed = numbered(rows, [F.col("k").desc(), F.col("id")], "numbers").collect()
    wanted = sorted(((r["k"], r["id"]) for r in placed), key=lambda r: (-r[0], r[1]))
    assert [(r["k"], r["id"]) for r in sorted(placed, key=lambda r: r["number"])] == wanted
    assert sorted(r["number"] for r in placed) == list(range(3000))
    classes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("least"))
    met = join_classes(rows, classes, ["k"]).collect()
    assert len(met) == 3000 and len({(r["k"], r["least"]) for r in met}) == 7
