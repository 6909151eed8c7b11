"""The manifest against a tree that is built plainly."""

import hashlib
import random
import zlib

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from sensorweave.llm import catalog, merkle

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, pos int, h string, path string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root, and per node what is left and right of it on each level."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            start = p // 8 * 8
            paths[k].append(("".join(nodes[start:p]), "".join(nodes[p + 1 : start + 8])))
        nodes = [h("".join(nodes[s : s + 8])) for s in range(0, len(nodes), 8)]
        at = [p // 8 for p in at]
    return nodes[0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    parts, subroots = [], []
    for key in keys:
        own = sorted(groups[key], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subroot, paths = tree([leaf_of(r) for r in own])
        parts.append((own, paths))
        subroots.append(subroot)
    if not rows:
        return []
    root, above = tree(subroots)
    found = []
    for (own, paths), up, subroot in zip(parts, above, subroots):
        for r, path in zip(own, paths):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded = leaf_of((*r[:4], text))
            for left, right in path + up:
                folded = h(left + folded + right)
            proof = h("".join(a + b for a, b in path + up))
            found.append((r[0], leaf_of(r), subroot, root, proof, folded, folded == root))
    return sorted(found, key=repr)


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)
    seen = {"text": merkle.case_tampered("doc_id", "text")}
    found = merkle.manifest(docs, seen=seen)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def rows_of(rng, ids, langs):
    texts = ["", None, "abc", "ABC", "Été Ä", "x y", "Z" * 50_000]
    return [(i, rng.choice(["web", None]), rng.choice(langs), rng.choice([None, 7]), rng.choice(texts)) for i in ids]


@pytest.mark.parametrize("levels", [1, 3])
def test_sizes(spark, monkeypatch, levels):
    """Groups of 1, 8, 9, 64, 65 and 600 rows, identifiers dense, sparse, negative and at both ends."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rng, rows = random.Random(levels), []
    for lang, size in [("a", 1), ("b", 8), ("Z", 9), (None, 64), ("é", 65), ("", 600)]:
        wide = [rng.choice([rng.getrandbits(63), -rng.getrandbits(63), rng.randrange(-300, 300)]) for _ in range(size)]
        rows += rows_of(rng, dict.fromkeys([*wide, (1 << 63) - 1, -(1 << 63)][-size:]), [lang])
    rows += rows_of(rng, range(200, 300), ["dense"])
    rng.shuffle(rows)
    check(spark, rows)


def test_ties_and_nulls(spark):
    rng = random.Random(5)
    ids = [None] * 20 + [3] * 30 + list(range(0, 70)) + [64, 64, -1, -1, 10**12, 10**12]
    rows = rows_of(rng, ids, ["de", None, "fr"])
    check(spark, rows + [rows[25]] * 12 + [(None, None, None, None, None)] * 9)


def test_one_row_and_none(spark):
    check(spark, [(0, None, "en", 1, "A")])
    check(spark, [(None, None, None, None, None)])
    check(spark, [])


def test_many_groups(spark):
    rng = random.Random(6)
    check(spark, rows_of(rng, range(700), [f"g{k}" for k in range(90)]))


def test_paths(spark):
    docs = catalog.table(spark, FOLDER, "documents")
    found = merkle.manifest(docs, paths=True)
    assert found.select(F.min(merkle.verify(found, F.col("leaf")))).first()[0]
    assert not found.select(F.max(merkle.verify(found, F.reverse("leaf")))).first()[0]
    by = {}
    for r in found.join(docs.select("doc_id", "lang"), "doc_id").collect():
        by.setdefault(r["lang"], []).append((r["doc_id"], r["position"]))
    assert all([p for _, p in sorted(own)] == list(range(len(own))) for own in by.values())


def test_query_against_plain_tree_and_sql(spark):
    docs = catalog.table(spark, FOLDER, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    query = catalog.QUERIES["op11_merkle_manifest"](spark, FOLDER)
    assert sorted((tuple(r) for r in query.collect()), key=repr) == expected(rows)
    assert difference(query, connect(FOLDER), catalog.SQL["op11_merkle_manifest"]) is None
    assert 0 < query.where("verified").count() < len(rows)
