"""Merkle manifest of a dataset: a tree for each group of rows, and one over their roots.

Leaves are put in order without sorting them. For each group the identifiers are merged into a bitmap,
compressed by keeping only words of 64 bits that have any set, over which a directory of popcounts is
laid in four levels. A row's coordinate is a rank query: the count before its word, and the bits below
its own. From there on nodes are placed into the slots of keyed arrays, 8 ** LEVELS of them each, which
reduce several levels at once. Proofs come back down the same arrays.

Only rows that share an identifier, or have none, are numbered by sorting ranges of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.llm.importance import CRC_TABLE, crc32_sql
from sensorweave.llm.spread import join_classes, numbered
from sensorweave.session import shuffles_sized_for, stage

ARITY_BITS = 3
ARITY = 1 << ARITY_BITS
LEVELS = 3  # that one array of slots reduces

# Bits of a word's number that each level of the directory takes; the topmost takes the other 15.
DIRECTORY = (14, 14, 15)
WORD_BITS = 6


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of values, each with its length in UTF-8 before it, null as a dash."""
    shown = [F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")) for f in fields]
    return sha256(F.concat(*[F.coalesce(s, F.lit("-")) for s in shown]))


def leaves(
    docs: DataFrame, id_col: str, group_col: str, fields: list[str], seen: dict[str, Column] | None = None
) -> DataFrame:
    """Per row: ``row``, ``id``, ``grp``, ``leaf``, and ``seen``, the digest of what is found later where it differs."""
    group = F.when(F.col(group_col).isNotNull(), F.concat(F.lit("="), F.col(group_col).cast("string")))
    leaf = leaf_digest([F.col(f) for f in fields])
    later = leaf_digest([(seen or {}).get(f, F.col(f)) for f in fields]) if seen else leaf
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(group, F.lit("")).alias("grp"), leaf.alias("leaf"), later.alias("seen")
    )
    rows = rows.withColumn("seen", F.when(F.col("seen") != F.col("leaf"), F.col("seen")))
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")


def _bit() -> Column:
    return F.col("id").bitwiseAND(63).cast("int")


def _shifted(value: int, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("long"), by)


def bitmaps(rows: DataFrame) -> DataFrame:
    """Per group and word: ``bits`` with the identifiers that are there, and ``rows``, the rows that have them."""
    word = F.shiftright("id", WORD_BITS).alias("word")
    found = rows.where("id IS NOT NULL").select("grp", word, _shifted(1, _bit()).alias("bit"))
    return found.groupBy("grp", "word").agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("rows"))


def directory(words: DataFrame, nulls: DataFrame) -> DataFrame:
    """``words`` with ``before``, the rows of the group before a word, and ``total``, all of the group.

    ``nulls`` has rows without identifier per group, which come first. Counts are added up level by
    level; a window covers the children of one entry, 32,768 at most.
    """
    levels = [words.withColumnRenamed("word", "k0")]
    for number, bits in enumerate(DIRECTORY):
        up = F.shiftright(f"k{number}", bits).alias(f"k{number + 1}")
        levels.append(levels[-1].groupBy("grp", up).agg(F.sum("rows").alias("rows")))
    last = len(DIRECTORY)
    top = levels[last].join(nulls, "grp", "left").withColumn("nulls", F.coalesce("nulls", F.lit(0)))
    group = Window.partitionBy("grp")
    earlier = group.orderBy(f"k{last}").rowsBetween(Window.unboundedPreceding, -1)
    above = top.select(
        "grp",
        f"k{last}",
        (F.col("nulls") + F.coalesce(F.sum("rows").over(earlier), F.lit(0))).alias("before"),
        (F.col("nulls") + F.sum("rows").over(group)).alias("total"),
    )
    for number in range(last - 1, -1, -1):
        parent = f"k{number + 1}"
        own = levels[number].withColumn(parent, F.shiftright(f"k{number}", DIRECTORY[number]))
        earlier = Window.partitionBy("grp", parent).orderBy(f"k{number}").rowsBetween(Window.unboundedPreceding, -1)
        own = own.withColumn("_within", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        own = own.join(above.select("grp", parent, "before", "total"), ["grp", parent]).withColumn("before", F.col("before") + F.col("_within"))
        above = own.drop("_within", parent)
    return above.withColumnRenamed("k0", "word")


def coordinates(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pos``, the place in the group by identifier, and ``total``, the rows of the group.

    Rows without identifier come first. Rows that share one are ordered by ``leaf``; those that
    share that, too, in any order.
    """
    nulls = stage(rows.where("id IS NULL").groupBy("grp").agg(F.count(F.lit(1)).alias("nulls")), "merkle-nulls")
    words = stage(bitmaps(rows), "merkle-bitmaps")
    found = stage(directory(words, nulls), "merkle-directory")
    present = rows.where("id IS NOT NULL").withColumn("word", F.shiftright("id", WORD_BITS))
    below = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(_shifted(-1, _bit()))))
    keep = [*rows.columns, "pos", "total"]

    shared = F.col("rows") > F.bit_count("bits")
    if not found.where(shared).limit(1).count() and not nulls.limit(1).count():
        placed = present.join(found, ["grp", "word"])
        return placed.withColumn("pos", F.col("before") + below).select(keep)

    # Per word, the bits that several rows have and how many more than one: 64 at most.
    doubled = present.join(found.where(shared).select("grp", "word"), ["grp", "word"], "left_semi")
    doubled = doubled.groupBy("grp", "word", "id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    doubled = stage(doubled, "merkle-doubled")
    extra = doubled.groupBy("grp", "word").agg(F.collect_list(F.struct(_bit().alias("bit"), (F.col("rows") - 1).alias("more"))).alias("extra"))
    found = found.join(extra, ["grp", "word"], "left")
    lower = lambda e: F.when(e["bit"] < _bit(), e["more"]).otherwise(F.lit(0))
    more = F.coalesce(F.aggregate("extra", F.lit(0).cast("long"), lambda n, e: n + lower(e)), F.lit(0))
    rank = F.col("before") + below + more

    # Words as classes: a shared identifier may have any number of rows.
    sizes = stage(found, "merkle-words")
    placed = join_classes(present, sizes, ["grp", "word"]).withColumn("pos", rank)
    own = F.exists("extra", lambda e: e["bit"] == _bit())
    tied = placed.withColumn("_tied", F.coalesce(own, F.lit(False))).select(*keep, "_tied")
    totals = rows.groupBy("grp").agg(F.count(F.lit(1)).alias("total"), F.count(F.lit(1)).alias("rows"))
    unnamed = join_classes(rows.where("id IS NULL"), stage(totals, "merkle-totals"), ["grp"])
    unnamed = unnamed.withColumns({"pos": F.lit(0).cast("long"), "_tied": F.lit(True)}).select(*keep, "_tied")
    tied = stage(tied.unionByName(unnamed), "merkle-ranked")
    order = [F.col("grp"), F.col("pos"), F.col("leaf"), F.col("row")]
    ordered = stage(numbered(tied.where("_tied"), order, "merkle-tied"), "merkle-numbered")
    first = ordered.groupBy("grp", F.col("pos")).agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("rows"))
    ordered = join_classes(ordered, stage(first, "merkle-first"), ["grp", "pos"])
    ordered = ordered.withColumn("pos", F.col("pos") + F.col("number") - F.col("first")).select(keep)
    return tied.where("NOT _tied").select(keep).unionByName(ordered)


def _up(nodes: Column) -> Column:
    """The next level of an array of digests: each 8 neighbours, or what is left of them, are one."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: sha256(F.array_join(F.slice(nodes, i * ARITY + 1, ARITY), "")))


def _siblings(nodes: Column, slot: Column, level: int) -> Column:
    """Left and right of the node above ``slot`` on a level, the others of its run."""
    at = F.shiftright(slot, level * ARITY_BITS)
    start = at.bitwiseAND(~(ARITY - 1))
    left = F.array_join(F.slice(nodes, start + 1, at - start), "")
    right = F.array_join(F.slice(nodes, at + 2, ARITY - 1 - (at - start)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def _arrays(nodes: DataFrame, payload: list[str], name: str) -> DataFrame:
    """Nodes in the slots of keyed arrays: per ``grp`` and ``block`` the levels of digests, and ``used`` of them."""
    slots = ARITY**LEVELS
    item = F.struct(F.col("pos").bitwiseAND(slots - 1).cast("int").alias("slot"), "h", *payload)
    blocks = nodes.groupBy("grp", F.shiftright("pos", LEVELS * ARITY_BITS).alias("block")).agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.max("total").alias("total")
    )
    blocks = blocks.withColumn("level0", F.transform("items", lambda x: x["h"]))
    for level in range(LEVELS):
        blocks = blocks.withColumn(f"level{level + 1}", _up(F.col(f"level{level}")))
    used = sum(((F.col("total") > ARITY**k).cast("int") for k in range(1, LEVELS)), (F.col("total") > 1).cast("int"))
    blocks = blocks.withColumn("used", used)
    top = F.element_at(F.array(*[F.element_at(f"level{k}", 1) for k in range(LEVELS + 1)]), F.col("used") + 1)
    return stage(blocks.withColumn("top", top), name)


def reduce_levels(nodes: DataFrame, payload: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """The arrays of slots from the leaves up, and per group its root as ``h``. Nodes: ``grp``, ``pos``, ``total``, ``h``."""
    most = nodes.agg(F.max("total").alias("n")).first()["n"] or 0
    steps: list[DataFrame] = []
    slots = ARITY**LEVELS
    while not steps or most > 1:
        blocks = _arrays(nodes, payload if not steps else [], f"{name}-arrays-{len(steps)}")
        steps.append(blocks)
        most = -(-most // slots)
        total = F.ceil(F.col("total") / slots).alias("total")
        nodes = blocks.select("grp", F.col("block").alias("pos"), total, F.col("top").alias("h"))
    return steps, nodes.select("grp", "h")


def _descend(steps: list[DataFrame], roots: DataFrame, payload: list[str], carried: list[str], name: str) -> DataFrame:
    """Nodes of the lowest level with ``path``: what stands left and right of each node up to the root.

    ``roots`` has per group a path to go on with, and columns to carry down.
    """
    above = roots.withColumn("pos", F.lit(0).cast("long"))
    for number in range(len(steps) - 1, -1, -1):
        blocks = steps[number].join(above.withColumnRenamed("pos", "block"), ["grp", "block"])
        levels = [F.col(f"level{k}") for k in range(LEVELS)]
        own = lambda x: F.slice(F.array(*[_siblings(v, x["slot"], k) for k, v in enumerate(levels)]), 1, F.col("used"))
        shown = payload if not number else []
        items = F.transform(
            "items",
            lambda x: F.struct(x["slot"].alias("slot"), x["h"].alias("h"), *[x[p].alias(p) for p in shown], own(x).alias("beside")),
        )
        nodes = blocks.select("grp", "block", "path", *carried, F.inline(items))
        pos = F.shiftleft("block", LEVELS * ARITY_BITS) + F.col("slot")
        above = nodes.select("grp", pos.alias("pos"), *carried, "h", *shown, F.concat("beside", "path").alias("path"))
        if number:
            above = stage(above.drop("h"), f"{name}-paths-{number}")
    return above


def _fold(path: Column, leaf: Column) -> Column:
    return F.aggregate(path, leaf, lambda h, p: sha256(F.concat(p["left"], h, p["right"])))


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    seen: dict[str, Column] | None = None,
    paths: bool = False,
) -> DataFrame:
    """Per row of ``docs``: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A leaf digests the values of ``fields``; those of a group are ordered by id, a whole number. Eight
    neighbours are a node, down to one; groups, null first and then by their text, likewise. A proof
    has the digests beside a row's node on each level. ``seen`` gives columns as they are found later;
    the proof is folded with their leaf, and the result compared with the root. ``paths`` adds
    ``path``, the proof itself, and ``position`` in the group.

    Rows without id come first in their group. Rows that share an id are ordered by leaf; equal ones
    are leaves of their own. Nulls and empty texts are different values. A table without rows gives
    none. Other columns do not matter, whatever their names.
    """
    spark = docs.sparkSession
    rows = leaves(docs, id_col, group_col, list(fields), seen)
    # A row takes some 300 bytes on its way: two digests and its numbers.
    with shuffles_sized_for(spark, rows.count() * 300):
        nodes = coordinates(rows).withColumnRenamed("leaf", "h").drop("row")
        steps, roots = reduce_levels(nodes, ["id", "seen"], "merkle")
        roots = stage(roots, "merkle-subroots")
        groups = numbered(roots, [F.col("grp")], "merkle-groups")
        groups = groups.select(F.lit("").alias("grp"), F.col("number").alias("pos"), "h", F.col("grp").alias("own"))
        groups = groups.withColumn("total", F.lit(roots.count()).cast("long"))
        group_steps, top = reduce_levels(groups, ["own"], "merkle-top")
        empty = F.array().cast("array<struct<left: string, right: string>>")
        above = _descend(group_steps, top.select("grp", F.col("h").alias("root"), empty.alias("path")), ["own"], ["root"], "merkle-top")
        above = above.select(F.col("own").alias("grp"), F.col("h").alias("subroot"), "root", "path")
        found = _descend(steps, stage(above, "merkle-group-paths"), ["id", "seen"], ["subroot", "root"], "merkle")
        proof = sha256(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""))
        folded = _fold(F.col("path"), F.coalesce("seen", "h"))
        more = [F.col("pos").alias("position"), "path"] if paths else []
        shown = found.select(
            F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
            F.col("h").alias("leaf"),
            "subroot",
            "root",
            proof.alias("proof_sha256"),
            folded.alias("folded_root"),
            *more,
        )
        return stage(shown, "merkle-manifest").withColumn("verified", F.col("folded_root") == F.col("root"))


def verify(found: DataFrame, leaf: Column, path_col: str = "path", root_col: str = "root") -> Column:
    """Whether a leaf leads to the root by its path. Rows need nothing but themselves for that."""
    return _fold(F.col(path_col), leaf) == F.col(root_col)


def case_tampered(id_col: str, text_col: str) -> Column:
    """The text with A-Z lower-cased where 3 divides the CRC of the id."""
    lowered = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0
    return F.when(hit, lowered).otherwise(F.col(text_col))


def oracle(levels: int = 11) -> str:
    """The query over ``documents`` in DuckDB, level by level; ``levels`` suffice for groups of 8 ** levels rows."""

    def shown(name: str, value: str | None = None) -> str:
        value = value or f"CAST({name} AS VARCHAR)"
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def tree(source: str, prefix: str, key: str, depth: int) -> list[str]:
        """A node has ``k`` (its key), ``pos``, ``n`` (nodes on its level), ``h``; ``l`` and ``r`` are its siblings."""
        parts, own = [], source
        for level in range(depth):
            run = f"{key}, pos // {ARITY}"
            cut = lambda side: f"coalesce(string_agg(h, '' ORDER BY pos) OVER (PARTITION BY {run} ORDER BY pos ROWS BETWEEN {side}), '')"  # noqa: E731,B023
            left, right = cut("UNBOUNDED PRECEDING AND 1 PRECEDING"), cut("1 FOLLOWING AND UNBOUNDED FOLLOWING")
            left, right = (x.replace(" ORDER BY pos)", ")") for x in (left, right))
            parts.append(f"{prefix}s{level} AS MATERIALIZED (SELECT {key}, pos, n, h, CASE WHEN n > 1 THEN {left} ELSE '' END AS l, CASE WHEN n > 1 THEN {right} ELSE '' END AS r FROM {own})")
            parts.append(
                f"{prefix}n{level + 1} AS MATERIALIZED (SELECT {key}, pos // {ARITY} AS pos, (max(n) + {ARITY - 1}) // {ARITY} AS n,"
                f" CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h FROM {prefix}s{level} GROUP BY {run})"
            )
            own = f"{prefix}n{level + 1}"
        return parts

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    values = [shown(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = lambda text: f"sha256({' || '.join([*values, shown('text', text)])})"
    crc = crc32_sql("CAST(doc_id AS VARCHAR)", "t")
    tampered = f"CASE WHEN {crc} % 3 = 0 THEN translate(text, '{upper}', '{lower}') ELSE text END"
    ctes = [
        f"c AS (SELECT {CRC_TABLE} AS t)",
        f"d AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS k, {leaf('text')} AS h, {leaf(tampered)} AS seen FROM documents, c)",
        "e AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,"
        " count(*) OVER (PARTITION BY k) AS n FROM d)",
        *tree("e", "a", "k", levels),
        f"g AS MATERIALIZED (SELECT 0 AS z, k, h, row_number() OVER (ORDER BY encode(k)) - 1 AS pos, count(*) OVER () AS n FROM an{levels})",
        *tree("g", "b", "z", levels),
    ]
    joins, path, folded = [], [], "seen"
    for prefix, key, at in (("a", "e.k", "e.pos"), ("b", "0", "g.pos")):
        if prefix == "b":
            joins.append("JOIN g ON g.k = e.k")
        name = "k" if prefix == "a" else "z"
        for level in range(levels):
            s = f"{prefix}s{level}"
            joins.append(f"JOIN {s} ON {s}.{name} = {key} AND {s}.pos = {at} // {ARITY**level}")
            path.append(f"{s}.l || {s}.r")
    return f"""
        WITH {", ".join(ctes)}, p AS (
            SELECT e.doc_id, e.h AS leaf, g.h AS subroot, bn{levels}.h AS root, e.seen,
                   {" || ".join(path)} AS proof,
                   [{", ".join(f"{{'n': {x}s{k}.n, 'l': {x}s{k}.l, 'r': {x}s{k}.r}}" for x in "ab" for k in range(levels))}] AS path
            FROM e {" ".join(joins)}, bn{levels}
        ), f AS (
            SELECT *, list_reduce(list_prepend({{'n': 0::BIGINT, 'l': seen, 'r': ''}}, path), lambda a, b:
                {{'n': 0::BIGINT, 'l': CASE WHEN b.n > 1 THEN sha256(b.l || a.l || b.r) ELSE a.l END, 'r': ''}}).l AS folded_root FROM p
        )
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified FROM f
    """
