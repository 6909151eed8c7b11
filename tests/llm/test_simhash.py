"""SimHash near-copies, against brute force over all pairs of fingerprints."""

import itertools
import random
import re

import xxhash

from sensorweave.llm import catalog, simhash
from sensorweave.llm.words import lower_ascii

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, fp int, id string, label string, rows double"


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reached(nodes, near):
    """By node, the least that it reaches; ``near`` tells which are linked."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if near(a, b):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {n: find(n) for n in nodes}


def expected(rows, bits=2):
    own = [plain_fingerprint(t) for _, t in rows]
    root = least_reached(sorted(set(own)), lambda a, b: (a ^ b).bit_count() <= bits)
    least = {}
    for (i, _), f in zip(rows, own):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, own)), key=repr)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", 0.5) for i, t in rows], SCHEMA)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_query_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in catalog.table(spark, FOLDER, "documents").collect()]
    found = result(catalog.QUERIES["op13_simhash"](spark, FOLDER))
    assert found == expected(rows)
    assert len({c for _, _, c in found}) < len(rows)


def test_fingerprints_near_each_other(spark):
    """All links, whatever segments the bits lie in, with signatures of any size."""
    rng = random.Random(0)
    made = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(6):
        base = rng.getrandbits(64)
        made |= {base}
        for _ in range(25):  # a chain of steps of up to three bits, on either side
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            made |= {base}
        low = rng.sample(range(32), 5)  # a dense group: any bits of five
        made |= {base ^ sum(1 << b for k, b in enumerate(low) if n >> k & 1) for n in range(32)}
        made |= {base ^ (rng.getrandbits(32) << 32) for _ in range(10)}  # the same segment, far apart
    signed = {f - (1 << 64) if f >> 63 else f for f in made}
    classes = spark.createDataFrame([(f,) for f in signed], "fp long")
    for bits in (0, 1, 2):
        near = {(a, b) for a, b in itertools.combinations(sorted(signed), 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
        for limit in (2, 64) if bits == 2 else (5,):
            found = [tuple(r) for r in simhash.class_links(classes, bits, limit).collect()]
            assert len(found) == len(set(found)) and set(found) == near
    assert near


def test_odd_rows(spark, monkeypatch):
    long = " ".join(f"w{k % 5000}" for k in range(60_000))
    rows = [(None, "a b c d e f"), (5, "A b  c d\te f"), (5, "a b c d e f"), (7, None), (8, ""), (3, " \n"), (9, long), (10, long)]
    rows += [(11, "one two"), (12, "One\x0btwo"), (13, "one"), (14, "É é é"), (None, "alone here and nowhere else"), (15, "x" * 300_000)]
    docs = docs_of(spark, rows)
    wanted = expected(rows)
    assert result(simhash.link(docs)) == wanted
    monkeypatch.setattr(simhash, "HOT_SHARE", 1)
    assert result(simhash.link(docs, limit=2)) == wanted
    assert simhash.link(docs.limit(0)).count() == 0 and simhash.links(docs.limit(0)).count() == 0


def test_blocks_do_not_matter(monkeypatch):
    rng = random.Random(1)
    for size in (1, 2, 3, 5):
        text = " ".join(f"w{rng.randrange(9)}" for _ in range(200)) + "  "
        wanted = simhash.fingerprint(text, size)
        assert size != 3 or wanted == plain_fingerprint(text)
        for block in (1, 7, 50):
            with monkeypatch.context() as patch:
                patch.setattr(simhash, "TEXT_BLOCK", block)
                assert simhash.fingerprint(text, size) == wanted


def test_links_between_texts(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(15):
        words = [f"w{rng.randrange(500)}" for _ in range(300)]
        for _ in range(4):
            words[rng.randrange(300)] = f"e{rng.randrange(99)}"
            texts.append(" ".join(words))
    rows = list(enumerate(texts + texts[:5]))
    by = {}
    for i, t in rows:
        by.setdefault(plain_fingerprint(t), []).append(i)
    wanted = set()
    for a, b in itertools.combinations(by, 2):
        if (a ^ b).bit_count() <= 2:
            one, other = sorted((a, b), key=lambda f: min(by[f]))
            wanted.add((min(by[one]), min(by[other]), (a ^ b).bit_count(), len(by[one]), len(by[other])))
    assert {tuple(r) for r in simhash.links(docs_of(spark, rows)).collect()} == wanted and wanted
