"""Repair of conversations whose turns break the rules of a chat format.

A finite automaton says which turn may follow which. For every conversation, dynamic
programming finds the cheapest way to make it legal: merge a turn into the one before,
give a turn another role, or insert an empty turn. The repaired sequence is then rendered.

The costs of a stretch of turns form a small matrix, from the state before to the state
after, and matrices of neighbouring stretches combine. So a conversation may be spread
over many tasks: each works on a stretch, and only matrices meet.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.session import stage

# The roles, and which may follow which; "" is the start. Any role in LAST may end.
ROLES = ["", "system", "user", "assistant"]
FOLLOWS = {"": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]}
LAST = ["assistant"]


@dataclass(frozen=True)
class Costs:
    """What each repair costs. Of equally cheap ways, the one that is tried first wins, in a fixed order."""

    merge: int = 1
    insert: int = 2
    relabel: int = 3
    open_turn: str = "<|{role}|>\n"
    close_turn: str = "<|end|>\n"
    join: str = "\n\n"


FAR = 1 << 40
STATES = len(ROLES)


def insertions(costs: Costs) -> tuple[np.ndarray, list[list[list[int]]]]:
    """The cost of reaching a state from another by empty turns alone, and the turns."""
    price = np.full((STATES, STATES), FAR, np.int64)
    ways: list[list[list[int]]] = [[[] for _ in ROLES] for _ in ROLES]
    for state in range(STATES):
        price[state, state] = 0
    for _ in ROLES:
        for a in range(STATES):
            for b in range(STATES):
                for role in FOLLOWS[ROLES[b]]:
                    c = ROLES.index(role)
                    if price[a, b] + costs.insert < price[a, c]:
                        price[a, c], ways[a][c] = price[a, b] + costs.insert, [*ways[a][b], c]
    return price, ways


def turn_matrix(role: int, costs: Costs) -> tuple[np.ndarray, list[list[tuple | None]]]:
    """Costs of one turn by the states before and after, and what is done: (action, inserted roles).

    ``role`` is the number of the turn's own role; 0 stands for any that the format does not know.
    """
    empty, ways = insertions(costs)
    price = np.full((STATES, STATES), FAR, np.int64)
    deeds: list[list[tuple | None]] = [[None] * STATES for _ in ROLES]
    for before in range(STATES):
        for middle in range(STATES):
            for name in FOLLOWS[ROLES[middle]]:
                after = ROLES.index(name)
                total = empty[before, middle] + (0 if after == role else costs.relabel)
                if total < price[before, after]:
                    price[before, after] = total
                    deeds[before][after] = ("keep" if after == role else "relabel", ways[before][middle])
        if before:
            total = costs.merge + (0 if before == role else costs.relabel)
            if total < price[before, before]:
                price[before, before] = total
                deeds[before][before] = ("merge" if before == role else "relabel and merge", [])
    return price, deeds


def combined(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The cheapest way through one stretch and the next."""
    return np.minimum((one[:, :, None] + other[None, :, :]).min(axis=1), FAR)


def ending(costs: Costs) -> tuple[np.ndarray, list[list[int]]]:
    """What it costs to end in a state: nothing in a last one, else the empty turns that lead to one."""
    empty, ways = insertions(costs)
    best = [min((int(empty[s, ROLES.index(r)]), ROLES.index(r)) for r in LAST) for s in range(STATES)]
    return np.array([c for c, _ in best]), [ways[s][r] for s, (_, r) in enumerate(best)]


SORTED = "conv_id {id}, turn {turn}, role string, text string, part int, pos long, code int, matrix array<long>"
DECIDED = "conv_id {id}, part int, entry int, leave int, last boolean, cost long"
TRACED = "part int, pos long, action string, new_role string, before array<string>, after array<string>, first boolean, final boolean, cost long"


def _sorted(rows: DataFrame, costs: Costs, schema: str) -> DataFrame:
    """Number the sorted rows of each task; the last row of a conversation in a task carries its matrix."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        matrices = [turn_matrix(r, costs)[0] for r in range(STATES)]
        part, pos, held = TaskContext.get().partitionId(), 0, None

        def numbered(batch, codes, out, pos):
            arrays = [
                pa.array(np.full(batch.num_rows, part), pa.int32()),
                pa.array(np.arange(pos - batch.num_rows, pos), pa.int64()),
                pa.array(codes, pa.int32()),
                pa.array(out, pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], [*batch.schema.names, "part", "pos", "code", "matrix"]
            )

        current, matrix = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_pylist()
            if held and (current,) != (ids[0],):
                held[2][-1] = matrix.ravel().tolist()
            if held:
                yield numbered(*held)
            codes = [ROLES.index(r) if r in ROLES else 0 for r in batch["role"].to_pylist()]
            out: list = [None] * len(ids)
            for at, (own, code) in enumerate(zip(ids, codes)):
                if matrix is None or own != current:
                    if at:
                        out[at - 1] = matrix.ravel().tolist()
                    current, matrix = own, matrices[code]
                else:
                    matrix = combined(matrix, matrices[code])
            pos += len(ids)
            held = (batch, codes, out, pos)
        if held:
            held[2][-1] = matrix.ravel().tolist()
            yield numbered(*held)

    return rows.mapInArrow(run, schema)


def _decide(stretches: DataFrame, costs: Costs, schema: str) -> DataFrame:
    """Per stretch, the states before and after it on the cheapest way through its conversation."""

    def run(batches):
        import pyarrow as pa

        close, _ = ending(costs)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at = np.array([0 if s == 0 else FAR for s in range(STATES)])
                costs_at, tables = [at], []
                for stretch in row["own"]:
                    tables.append(np.array(stretch["matrix"]).reshape(STATES, STATES))
                    costs_at.append(np.minimum((costs_at[-1][:, None] + tables[-1]).min(axis=0), FAR))
                state = int(np.argmin(costs_at[-1] + close))
                total = int((costs_at[-1] + close)[state])
                for k in range(len(tables) - 1, -1, -1):
                    entry = int(np.argmin(costs_at[k] + tables[k][:, state]))
                    out.append((row["conv_id"], row["own"][k]["part"], entry, state, k == len(tables) - 1, total))
                    state = entry
            columns = list(zip(*out)) or [()] * 6
            kinds = [batch.schema.field("conv_id").type, pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["conv_id", "part", "entry", "leave", "last", "cost"]
            )

    return stretches.mapInArrow(run, schema)


def _trace(rows: DataFrame, costs: Costs) -> DataFrame:
    """What is done with every turn. Rows come stretch by stretch, in order; they are numbers only."""

    def run(batches):
        import pyarrow as pa

        tables = [turn_matrix(r, costs) for r in range(STATES)]
        close, tails = ending(costs)
        own: list[dict] = []
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.bool_(), pa.bool_(), pa.int64()]
        names = ["part", "pos", "action", "new_role", "before", "after", "first", "final", "cost"]

        def solved():
            ahead = [None] * (len(own) + 1)
            ahead[-1] = np.array([0 if s == own[0]["leave"] else FAR for s in range(STATES)])
            for k in range(len(own) - 1, -1, -1):
                ahead[k] = np.minimum((tables[own[k]["code"]][0] + ahead[k + 1][None, :]).min(axis=1), FAR)
            state, out = own[0]["entry"], []
            for k, row in enumerate(own):
                price, deeds = tables[row["code"]]
                after = int(np.argmin(price[state] + ahead[k + 1]))
                action, before = deeds[state][after]
                final = row["last"] and k == len(own) - 1
                inserted = [[ROLES[r] for r in roles] for roles in (before, tails[after] if final else [])]
                out.append((row["part"], row["pos"], action, ROLES[after], *inserted, state == 0, final, row["cost"]))
                state = after
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if own and (own[0]["part"], own[0]["conv_id"]) != (row["part"], row["conv_id"]):
                    yield solved()
                    own = []
                own.append(row)
        if own:
            yield solved()

    return rows.mapInArrow(run, TRACED)


def repair(
    conversations: DataFrame,
    costs: Costs = Costs(),
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per turn: ``conv_id``, ``position``, ``turn``, ``role``, ``new_role``, ``action``, ``inserted``, ``rendered``, ``cost``.

    Turns are ordered by number, null first, and of equal numbers by role and text; repeated rows
    are turns of their own. A null conversation id is a conversation, too. A null or unknown role
    has to be relabelled; a null text is empty. ``rendered`` is what the turn adds to the
    conversation: with the inserted turns before (and at the end, after) it, a new turn's opening,
    or what joins it to the turn it is merged into. Read by ``position``, that is the rendered
    conversation. ``cost`` is that of the whole repair. Other columns do not matter.
    """
    kinds = {"id": conversations.schema[id_col].dataType.simpleString(), "turn": conversations.schema[turn_col].dataType.simpleString()}
    rows = conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    keys = [F.col("conv_id"), F.col("turn"), F.col("role"), F.xxhash64("text"), F.col("text")]
    ordered = rows.repartitionByRange(*keys[:4]).sortWithinPartitions(*keys)
    found = stage(_sorted(ordered, costs, SORTED.format(**kinds)), "chat-sorted")
    stretches = found.where("matrix IS NOT NULL").select("conv_id", "part", "matrix")
    stretches = stretches.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "matrix"))).alias("own"))
    decided = stage(_decide(stretches, costs, DECIDED.format(**kinds)), "chat-decided").withColumnRenamed("conv_id", "_id").withColumnRenamed("part", "_part")
    same = F.col("conv_id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part"))
    slim = found.select("conv_id", "part", "pos", "code").join(decided, same).drop("_id", "_part")
    traced = _trace(slim.repartition("part").sortWithinPartitions("part", "pos"), costs)
    whole = found.select("conv_id", "turn", "role", "text", "part", "pos").join(traced, ["part", "pos"])

    head = lambda role: F.replace(F.lit(costs.open_turn), F.lit("{role}"), role)
    starts = ~F.col("action").contains("merge")
    shut = F.when(~F.col("first"), F.lit(costs.close_turn)).otherwise(F.lit(""))
    empty = F.array_join(F.transform("before", lambda r: F.concat(head(r), F.lit(costs.close_turn))), "")
    opened = F.concat(shut, empty, head(F.col("new_role")))
    tail = F.array_join(F.transform("after", lambda r: F.concat(head(r), F.lit(costs.close_turn))), "")
    text = F.coalesce("text", F.lit(""))
    end = F.when(F.col("final"), F.lit(costs.close_turn)).otherwise(F.lit(""))
    return whole.select(
        "conv_id",
        (F.shiftleft(F.col("part").cast("long"), 40) + F.col("pos")).alias("position"),
        "turn",
        "role",
        "new_role",
        "action",
        F.concat("before", "after").alias("inserted"),
        F.concat(F.when(starts, opened).otherwise(F.lit(costs.join)), text, end, tail).alias("rendered"),
        "cost",
    )
