"""Join of texts whose word n-gram sets have a Jaccard similarity of so many percent.

Candidates come from prefix filters under several orders of all n-grams and must pass each:

* The first order is by hash. Of every set, the front is indexed. Rarity in that index then
  says which n-grams of a shorter set are looked up: if two sets are similar, the shorter
  misses at most so many of its own n-grams in the longer, so any one more of them than
  that, from a part that lies in the longer one's indexed front, must meet it. The rarest
  are taken, hence n-grams of widespread passages are hardly ever looked up.
* Two more orders, by other hashes, each give a classical prefix; the prefixes of a pair
  must overlap under both before its sets are compared.

Equal sets are one class from the start. An n-gram in many sets is not paired up. Who would
look one up, and whoever has it, meet again with their whole sets: there, what is rare in a
set settles most of them. What is left has hardly anything of its own, so it is compared
with leaders first, the sets that are closest to their bucket; and only members of a bucket
that are not connected by then are compared with each other. No link between components is lost.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.components import components
from sensorweave.llm.words import KNOWN_WORDS, Numbers, chain64, distinct, hash64, lower_ascii, mix64, slices, words_of
from sensorweave.session import stage


@dataclass(frozen=True)
class Similarity:
    """``words`` per n-gram; ``percent``: least intersection over union.

    ``slack``: share of a set, in percent, among which the rarest n-grams can be chosen.
    ``bucket``: sets that share an n-gram are all paired up to that many, else by leaders.
    ``leaders``: rounds of leaders before what is left is paired in full.
    """

    words: int = 5
    percent: int = 80
    slack: int = 15
    bucket: int = 32
    leaders: int = 2

    def prefix(self, n):
        """Length of a classical prefix, under any order."""
        return n - -(-self.percent * n // 100) + 1

    def probes(self, n):
        """N-grams of a set of which at least one is in every similar set that is no shorter."""
        return n - -(-2 * self.percent * n // (100 + self.percent)) + 1

    def reach(self, n):
        """The front of a set that probes are chosen from."""
        return np.minimum(n, np.maximum(-(-self.slack * n // 100) + 1, self.probes(n)))

    def front(self, n):
        """What is indexed: the reach, and as many as a similar, shorter set may lack."""
        return np.minimum(n, self.reach(n) + (100 - self.percent) * n // 100)


# Other orders of n-grams: hashes mixed with these.
ORDERS = (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D)

# Nodes up to this many may be broadcast; their number is counted first.
BROADCAST_ROWS = 500_000


class Shingler:
    """Sets of n-gram hashes, ascending in the first order."""

    def __init__(self, words: int):
        self.words = words
        self.forget()

    def forget(self) -> None:
        self.numbers, self.hashes = Numbers(), np.zeros(0, np.uint64)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.numbers) > KNOWN_WORDS:
            self.forget()
        ids = [self.numbers.of(words_of(lower_ascii(t))) if t else np.zeros(0, np.int64) for t in texts]
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if fresh:
            self.hashes = np.concatenate([self.hashes, np.fromiter(map(hash64, fresh), np.uint64, len(fresh))])
        return [distinct(self._grams(self.hashes[i]).view(np.int64)) for i in ids]

    def _grams(self, hashes: np.ndarray) -> np.ndarray:
        """All n-grams; a shorter text is one n-gram as a whole."""
        return chain64(hashes, min(self.words, len(hashes))) if len(hashes) else hashes


def _digest(tokens: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(tokens.tobytes())


def _order(tokens: np.ndarray, number: int, length: int) -> np.ndarray:
    """The prefix of a set under another order, as 32 bits of each n-gram."""
    ranks = mix64(tokens.view(np.uint64) ^ np.uint64(ORDERS[number]))
    return np.sort(ranks)[:length].view(np.int64).astype(np.int32)


SETS = [("node", T.LongType()), ("n", T.LongType()), ("digest", T.BinaryType()), ("front", T.ArrayType(T.LongType()))]


def sets(docs: DataFrame, how: Similarity, id_col: str, text_col: str) -> DataFrame:
    """Per row: a number of its own, id, size and digest of the set, and its indexed front."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        shingler, node = Shingler(how.words), TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            found = shingler.sets(batch["_text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["_id"],
                    pa.array(np.arange(node, node + len(found)), pa.int64()),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([_digest(x) if len(x) else None for x in found], pa.binary()),
                    pa.array([x[: how.front(len(x))] for x in found], pa.list_(pa.int64())),
                ],
                ["id", *[name for name, _ in SETS]],
            )
            node += len(found)

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(*f) for f in SETS]])
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def _whole_sets(docs: DataFrame, how: Similarity) -> DataFrame:
    """Per row of ``_text``: digest, the whole set, and its prefixes under the other orders."""

    def run(batches):
        import pyarrow as pa

        shingler = Shingler(how.words)
        for batch in slices(batches):
            found = shingler.sets(batch["_text"].to_pylist())
            prefixes = [[_order(x, k, how.prefix(len(x))) for x in found] for k in range(len(ORDERS))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_digest(x) if len(x) else None for x in found], pa.binary()),
                    pa.array(found, pa.list_(pa.int64())),
                    *[pa.array(p, pa.list_(pa.int32())) for p in prefixes],
                ],
                ["digest", "grams", "order1", "order2"],
            )

    return docs.select("_text").mapInArrow(run, "digest binary, grams array<long>, order1 array<int>, order2 array<int>")


def _shared(grams: DataFrame) -> DataFrame:
    """The rows whose n-gram others have, too, with ``df``: a single shuffle, as most n-grams have one row."""
    return grams.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("gram"))).where("df > 1")


def _live(own: DataFrame, how: Similarity) -> DataFrame:
    """The n-grams of fronts that more than one class has: ``gram``, ``node``, ``n``, ``near`` (within reach), ``df``."""
    grams = own.select("node", "n", F.posexplode("front").alias("pos", "gram"))
    return _shared(grams.select("gram", "node", "n", (F.col("pos") < _reach(how)).alias("near")))


def _live_whole(whole: DataFrame) -> DataFrame:
    """The same for whole sets, all of which is within reach."""
    return _shared(whole.select(F.explode("grams").alias("gram"), "node", F.size("grams").cast("long").alias("n")))


def _ceil(a: Column, b: int) -> Column:
    return F.ceil(a / F.lit(b))


def _needed(how: Similarity) -> Column:
    """N-grams of a set of which at least one is in every similar set that is no shorter."""
    n = F.col("n")
    return n - _ceil(2 * how.percent * n, 100 + how.percent) + 1


def _reach(how: Similarity) -> Column:
    """The front of a set that probes are chosen from."""
    n = F.col("n")
    return F.least(n, F.greatest(_ceil(how.slack * n, 100) + 1, _needed(how)))


def _probes(live: DataFrame, how: Similarity, whole: bool = False) -> DataFrame:
    """What each class looks up: its rarest n-grams within reach, as far as others have them at all.

    Where ``live`` has whole sets, all of a set is within reach.
    """
    reach, near = (F.col("n"), live) if whole else (_reach(how), live.where("near"))
    order = Window.partitionBy("node").orderBy("df", "gram")
    every = Window.partitionBy("node")
    ranked = near.select(
        "gram", "node", "n", "df", F.row_number().over(order).alias("rank"), F.count(F.lit(1)).over(every).alias("shared")
    )
    alone = reach - F.col("shared")  # n-grams within reach that no other class has count among the probes
    return ranked.where(F.col("rank") <= _needed(how) - alone).select("gram", "node", "n", "df")


def _meets(how: Similarity, other: str = "b") -> Column:
    """Whether the sizes of a pair allow the similarity, the prober being the shorter one."""
    a, b = F.col("a_n"), F.col(f"{other}_n")
    earlier = (a < b) | (F.col("a") < F.col(other))
    return (F.col("a") != F.col(other)) & (a <= b) & (100 * a >= how.percent * b) & earlier


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _as(df: DataFrame, side: str) -> DataFrame:
    return df.select("gram", F.col("node").alias(side), F.col("n").alias(f"{side}_n"))


# Members of a bucket that one block holds about, where all of them are paired up.
BLOCK = 1024


def _all_pairs(probes: DataFrame, index: DataFrame, how: Similarity) -> DataFrame:
    """Pairs through n-grams of any frequency: buckets are cut on both sides, each key pairs two blocks."""
    blocks = F.ceil(F.col("df") / F.lit(BLOCK)).cast("int")
    own, others = F.pmod(F.xxhash64("node"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks - 1))
    asking = probes.select("gram", F.col("node").alias("a"), F.col("n").alias("a_n"), own.alias("_a"), others.alias("_b"))
    asked = index.select("gram", F.col("node").alias("b"), F.col("n").alias("b_n"), own.alias("_b"), others.alias("_a"))
    return _pairs(asking.join(asked, ["gram", "_a", "_b"]).where(_meets(how)))


def _size_class(n: Column, how: Similarity) -> Column:
    return F.floor(F.log(n.cast("double")) / float(-np.log(how.percent / 100))).cast("int")


def _led(probes: DataFrame, index: DataFrame, how: Similarity, number: int) -> DataFrame:
    """Pairs of a class with the leaders of its buckets: one per n-gram and class of sizes.

    The first leaders are the sets with the largest share of frequent n-grams, which have the
    least of their own; later ones are drawn by hashes, another one for each n-gram.
    """
    own_share = index.groupBy("node").agg((F.count(F.lit(1)) / F.max("n")).alias("share"))
    ranked = _as(index, "b").join(own_share.withColumnRenamed("node", "b"), "b")
    by = F.struct(-F.col("share"), "b") if number == 0 else F.struct(F.xxhash64("b", "gram", F.lit(number)), "b")
    ranked = ranked.withColumn("size", _size_class(F.col("b_n"), how))
    leaders = ranked.groupBy("gram", "size").agg(F.min_by(F.struct("b", "b_n"), by).alias("l"))
    leaders = leaders.select("gram", "size", "l.b", "l.b_n")
    own = _size_class(F.col("a_n"), how)
    asking = _as(probes, "a").withColumn("size", F.explode(F.array(own, own + 1)))
    met = asking.join(leaders, ["gram", "size"])
    a, b = F.col("a_n"), F.col("b_n")
    return _pairs(met.where((F.col("a") != F.col("b")) & (100 * F.least(a, b) >= how.percent * F.greatest(a, b))))


def _cores(index: DataFrame, roots: DataFrame, how: Similarity) -> DataFrame:
    """Per component and core, the smallest set that has it: ``node``, ``n``, ``core`` (its size), ``root``.

    A set's core are its frequent n-grams. Where two sets share nothing else, their intersection
    lies in both cores, so a core must make up so many percent of its set; and of the sets
    with one core, the smallest is similar to whatever another one is similar to.
    """
    size, marks = F.count(F.lit(1)), [F.bit_xor("gram").alias("_x"), F.bit_xor(F.xxhash64("gram")).alias("_y")]
    cores = index.groupBy("node").agg(F.max("n").alias("n"), size.alias("core"), *marks)
    cores = cores.where(100 * F.col("core") >= how.percent * F.col("n"))
    cores = cores.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = cores.groupBy("root", "core", "_x", "_y").agg(F.min(F.struct("n", "node")).alias("_least"))
    return least.select("_least.node", "_least.n", "core", "root")


def _unconnected(probes: DataFrame, index: DataFrame, roots: DataFrame, how: Similarity) -> DataFrame:
    """Pairs of sets in different components that may be similar; enough of them to connect what is similar.

    Pairs that share an n-gram that is not frequent are known by now. So whoever else is similar to
    a set lacks all that is outside its core, and of the core at least one is found
    among any more n-grams than it may lack besides. Those that the fewest sets of other
    components have are looked up; an n-gram that none of them has costs a count.
    """
    members = stage(index.select("gram", "node").join(_cores(index, roots, how), "node"), "jaccard-members")
    inside = members.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("inside"))
    every = inside.groupBy("gram").agg(F.sum("inside").alias("every"))
    outside = inside.join(every, "gram").select("gram", "root", (F.col("every") - F.col("inside")).alias("outside"))
    order = Window.partitionBy("node").orderBy("outside", "gram")
    ranked = members.join(probes.select("node").distinct(), "node", "left_semi").join(outside, ["gram", "root"])
    ranked = ranked.withColumn("rank", F.row_number().over(order))
    lacking = _needed(how) - (F.col("n") - F.col("core"))
    asking = ranked.where((F.col("rank") <= lacking) & (F.col("outside") > 0))
    side = lambda df, s: df.select("gram", *[F.col(c).alias(s if c == "node" else f"{s}_{c}") for c in ("node", "n", "core", "root")])
    shared = F.least("a_core", "b_core")
    fits = (100 + how.percent) * shared >= how.percent * (F.col("a_n") + F.col("b_n"))
    found = side(asking, "a").join(side(members, "b"), "gram")
    return _pairs(found.where((F.col("a_root") != F.col("b_root")) & _meets(how) & fits))


class _Verifier:
    """Compares candidate pairs: prefixes under the other orders first, then the sets."""

    def __init__(self, docs: DataFrame, own: DataFrame, how: Similarity, id_col: str, text_col: str):
        self.docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        self.own, self.how = own.select("node", "id", "digest"), how

    def whole(self, nodes: DataFrame, name: str) -> DataFrame:
        """Whole sets and prefixes of the given classes, from their texts."""
        nodes = stage(nodes, f"jaccard-nodes-{name}")
        small = nodes.count() <= BROADCAST_ROWS
        known = stage(self.own.join(F.broadcast(nodes) if small else nodes, "node"), f"jaccard-known-{name}")
        ids = known.select("id").distinct()
        texts = self.docs.join(F.broadcast(ids) if small else ids, F.col("_id").eqNullSafe(F.col("id")), "left_semi")
        found = _whole_sets(texts, self.how).join(known.select("node", "digest"), "digest").drop("digest")
        return stage(found.dropDuplicates(["node"]), f"jaccard-whole-{name}")

    def links(self, pairs: DataFrame, name: str, whole: DataFrame | None = None) -> DataFrame:
        pairs = stage(pairs, f"jaccard-pairs-{name}")
        if whole is None:
            whole = self.whole(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), name)
        side = lambda s: whole.select([F.col(c).alias(s if c == "node" else f"{s}_{c}") for c in whole.columns])
        met = pairs.join(side("a"), "a").join(side("b"), "b")
        met = met.where(F.arrays_overlap("a_order1", "b_order1")).where(F.arrays_overlap("a_order2", "b_order2"))
        both = F.size(F.array_intersect("a_grams", "b_grams"))
        either = F.size("a_grams") + F.size("b_grams") - both
        return stage(met.where(100 * both >= self.how.percent * either).select("a", "b"), f"jaccard-links-{name}")


def _rare_pairs(probes: DataFrame, live: DataFrame, how: Similarity) -> DataFrame:
    """Pairs through n-grams that few sets have."""
    rare = F.col("df") <= how.bucket
    return _as(probes.where(rare), "a").join(_as(live.where(rare), "b"), "gram").where(_meets(how))


def _concerned(hunters: DataFrame, live: DataFrame, how: Similarity) -> DataFrame:
    """The hunters, and whatever may be similar to one: enough of its front must be within reach of hunters.

    Of a hunter's reach, a similar set that is no shorter lacks fewer n-grams than there are
    probes, and has the others in its front.
    """
    n = F.col("n")
    hunted = live.join(hunters, "node", "left_semi").where("near").select("gram").distinct()
    shared = live.join(hunted, "gram", "left_semi").groupBy("node").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("shared"))
    rest = max(0.0, how.slack / 100 - (1 - 2 * how.percent / (100 + how.percent)))
    least = F.greatest(F.lit(1), F.floor(n * (rest * how.percent / 100)) - 1)
    return shared.where(F.col("shared") >= least).select("node").unionByName(hunters).distinct()


def _frequent_links(
    often: DataFrame, live: DataFrame, links: DataFrame, verifier: _Verifier, how: Similarity, every: bool
) -> DataFrame:
    """Links through n-grams that many sets have, among those sets alone; with ``links``, all that components need.

    With ``every``, all there are.
    """
    hunters = often.select("node").distinct()
    whole = verifier.whole(_concerned(hunters, live, how), "again")
    live = stage(_live_whole(whole), "jaccard-live-again")
    probes = stage(_probes(live.join(hunters, "node", "left_semi"), how, whole=True), "jaccard-probes-again")
    frequent = F.col("df") > how.bucket
    often, index = probes.where(frequent), live.where(frequent)
    pairs = _rare_pairs(probes, live, how)
    pairs = _pairs(pairs)
    if every:
        pairs = pairs.unionByName(_all_pairs(often, index, how))
        return links.unionByName(verifier.links(pairs.distinct(), "again", whole)).distinct()
    for number in range(how.leaders):
        pairs = pairs.unionByName(_led(often, index, how, number))
    links = links.unionByName(verifier.links(pairs.distinct(), "again", whole))
    if not often.limit(1).count():
        return links
    rest = _unconnected(often, index, components(links, "jaccard-roots"), how)
    return links.unionByName(verifier.links(rest, "rest", whole))


def _linked(docs: DataFrame, how: Similarity, id_col: str, text_col: str, every: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows; those with n-grams and ``rep``, the class of equal sets; links between classes, with ``every`` all."""
    found = stage(sets(docs, how, id_col, text_col), "jaccard-sets")
    slim = found.select("node", "id", "n", "digest").where("n > 0")
    classes = slim.groupBy("digest").agg(F.min("node").alias("rep"))
    members = stage(slim.join(classes, "digest"), "jaccard-classes")
    copies = stage(members.where("node <> rep").select("node"), "jaccard-copies")
    own = found.where("n > 0").join(copies, "node", "left_anti")

    live = stage(_live(own, how), "jaccard-live")
    probes = stage(_probes(live, how), "jaccard-probes")
    verifier = _Verifier(docs, own, how, id_col, text_col)
    links = verifier.links(_pairs(_rare_pairs(probes, live, how)), "first")
    often = probes.where(F.col("df") > how.bucket)
    if often.limit(1).count():
        links = _frequent_links(often, live, links, verifier, how, every)
    return found, members, links


def link(docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles``, ``component_id``.

    The latter is the smallest id that can be reached by links. A text without words (null,
    empty) has no n-grams and is linked with nothing: its component is its own id. Rows with
    equal sets are linked. A null id is no id: its row may connect others, and gets the
    smallest id of its component. Other columns do not matter.
    """
    found, members, links = _linked(docs, how, id_col, text_col, every=False)
    roots = components(links, "jaccard-roots")
    rooted = members.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    rooted = rooted.select("node", "id", "n", F.coalesce("root", "rep").alias("root"))
    least = rooted.groupBy("root").agg(F.min("id").alias("least"))
    linked = rooted.join(least, "root").select("id", "n", "least")
    empty = found.where("n = 0").select("id", "n", F.col("id").alias("least"))
    return linked.unionByName(empty).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("least").alias("component_id")
    )


def pairs(docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The join itself: each two different sets that are similar, once.

    Rows with equal sets are one class. ``a`` and ``b`` are the smallest ids of two classes, the
    smaller one first, ``a_rows`` and ``b_rows`` their numbers of rows. A class without any id
    has null. The result, and the work, grow with the square of a group of similar sets.
    """
    _, members, links = _linked(docs, how, id_col, text_col, every=True)
    classes = stage(members.groupBy("rep").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("rows")), "jaccard-reps")
    side = lambda s: classes.select(F.col("rep").alias(s), F.struct("id", "rows").alias(f"_{s}"))
    both = F.sort_array(F.array("_a", "_b"))
    met = links.join(side("a"), "a").join(side("b"), "b").select(both.alias("_p"))
    first, second = F.col("_p")[0], F.col("_p")[1]
    return met.select(first["id"].alias("a"), second["id"].alias("b"), first["rows"].alias("a_rows"), second["rows"].alias("b_rows"))


def link_counts(docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id and ``n_links``, the number of other rows that are similar to it, equal sets included."""
    found, members, links = _linked(docs, how, id_col, text_col, every=True)
    classes = stage(members.groupBy("rep").agg(F.count(F.lit(1)).alias("rows")), "jaccard-reps")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(classes.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("rows").alias("others"))
    counts = classes.join(others, F.col("rep") == F.col("a"), "left")
    counts = counts.select("rep", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    counted = members.join(counts, "rep").select("id", "n_links")
    empty = found.where("n = 0").select("id", F.lit(0).cast("long").alias("n_links"))
    return counted.unionByName(empty).select(F.col("id").alias(id_col), "n_links")


def keep_one(docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not linked to a row with a smaller id, with their columns as they are.

    Rows without an id stay, and so do repeated rows with the smallest id of a component.
    """
    linked = link(docs, how, id_col, text_col)
    name = f"_dropped_{uuid.uuid4().hex}"  # no column of docs has such a name
    dropped = linked.where(F.col(id_col) > F.col("component_id")).select(F.col(id_col).alias(name)).distinct()
    dropped = stage(dropped, "jaccard-dropped")
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, F.col(id_col) == F.col(name), "left_anti")
