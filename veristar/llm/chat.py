"""Chat formatting: repair of roles at minimum cost, then rendering.

A legal conversation is an optional system turn, then user and assistant in turn, beginning
with user. The automaton has the states start, system, user and assistant (the last role). Each
turn of the input is kept, relabelled, or merged into the turn before it, with empty turns
inserted where the automaton needs them; costs are ``RELABEL`` (``UNKNOWN`` for a role that is no
role at all), ``MERGE`` and ``INSERT``. Dynamic programming over the states finds the cheapest repair; ties
go to keeping, then merging, then the state first in the order above.

A step is a small table of costs from state to state, and tables multiply (min, +). So a
conversation of any length is cut into segments: turns are put in order over range partitions, each
segment is reduced to its table, the tables of a conversation (one row a partition) give the states at the
segment's ends, and then each segment is repaired by itself. No task holds a whole conversation.

Defined results: a null conversation is one of its own; null turns come first; turns of equal number
are in order of role and text; a null or unknown role is relabelled; a null text is empty; a conversation
may end after any role; repeated rows are turns of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written

ROLES = ("system", "user", "assistant")
RELABEL, UNKNOWN, MERGE, INSERT = 3, 2, 1, 4
START = 0  # states: start, then the roles
_FAR = 1 << 40
_LEGAL = {(0, 1), (0, 2), (1, 2), (2, 3), (3, 2)}

Step = tuple[int, str, tuple[int, ...]]  # cost, action, inserted states


def _path(a: int, b: int) -> tuple[int, ...] | None:
    """Empty turns to insert behind state a so that b is legal (shortest; two at most are ever needed)."""
    if (a, b) in _LEGAL:
        return ()
    for c in (1, 2, 3):
        if (a, c) in _LEGAL and (c, b) in _LEGAL:
            return (c,)
    for c in (1, 2, 3):
        for d in (1, 2, 3):
            if (a, c) in _LEGAL and (c, d) in _LEGAL and (d, b) in _LEGAL:
                return (c, d)
    return None


def step_table(role: str | None) -> list[list[Step]]:
    """The cheapest step for a turn of this role, from each state to each state."""
    own = ROLES.index(role) + 1 if role in ROLES else 0
    table = []
    for a in range(4):
        row = []
        for b in range(4):
            best: Step = (_FAR, "", ())
            if b:
                change = 0 if b == own else RELABEL if own else UNKNOWN
                path = _path(a, b)
                if path is not None:
                    best = (change + INSERT * len(path), "keep" if not change else "relabel", path)
                if a == b and change + MERGE < best[0]:
                    best = (change + MERGE, "merge", ())
            row.append(best)
        table.append(row)
    return table


TABLES = {role: step_table(role) for role in (*ROLES, None)}


def _table(role: str | None) -> list[list[Step]]:
    return TABLES[role if role in ROLES else None]


def summary(roles) -> list[int]:
    """Costs of a segment from state to state, 16 numbers."""
    costs = [[0 if a == b else _FAR for b in range(4)] for a in range(4)]
    for role in roles:
        t = _table(role)
        costs = [[min(row[m] + t[m][b][0] for m in range(4)) for b in range(4)] for row in costs]
    return [min(c, _FAR) for row in costs for c in row]


def repair(roles: list[str | None], first: int, last: int | None = None) -> list[tuple[int, str, tuple[int, ...]]]:
    """(state, action, inserted states) for each turn, from one state to another (to the cheapest, if none is given)."""
    best, back = [0 if s == first else _FAR for s in range(4)], []
    for role in roles:
        t = _table(role)
        came = [min(range(4), key=lambda m: (best[m] + t[m][b][0], m)) for b in range(4)]
        best = [min(best[m] + t[m][b][0], _FAR) for b, m in enumerate(came)]
        back.append(came)
    state = min(range(4), key=lambda s: (best[s], s)) if last is None else last
    out = []
    for role, came in zip(reversed(roles), reversed(back)):
        before = came[state]
        _, action, inserted = _table(role)[before][state]
        out.append((state, action, inserted))
        state = before
    return out[::-1]


def opened(role: str) -> str:
    return f"<|{role}|>\n"


CLOSED = "<|end|>\n"


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, part, at: the order of all turns over range partitions, as written."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.lower(F.trim("role")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # Copies of a turn are told apart by a hash of the text, so that they do not share one partition.
    keys = ["conv_id", "turn", "role", F.xxhash64("text")]
    return written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
                   .withColumn("part", F.spark_partition_id())
                   .withColumn("at", F.monotonically_increasing_id()), "chat-turns")


def by_runs(rows: DataFrame, keys: list[str], order: list[str], reduce: Callable[[list[dict]], list[tuple]],
            schema: str, types: list[pa.DataType]) -> DataFrame:
    """``reduce`` over the rows of each key, in order; one key's rows are in memory at a time."""
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, out = [], None, []
        for batch in slices(batches, 1024):
            for r in batch.to_pylist():
                key = tuple(r[k] for k in keys)
                if held and key != last:
                    out += reduce(held)
                    held = []
                held.append(r)
                last = key
            if len(out) > 1024:
                yield batch_of(out)
                out = []
        if held:
            out += reduce(held)
        if out:
            yield batch_of(out)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def segment_ends(rows: DataFrame) -> DataFrame:
    """conv_id, part, first, last, offset: states at both ends of each segment, turns before it."""
    def reduce(held: list[dict]) -> list[tuple]:
        return [(held[0]["conv_id"], held[0]["part"], len(held), summary([r["role"] for r in held]))]

    segments = by_runs(rows.select("conv_id", "part", "at", "role"), ["conv_id", "part"], ["at"], reduce,
                       "conv_id long, part int, n long, costs array<long>",
                       [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())])

    def states(held: list[dict]) -> list[tuple]:
        """A row for each partition that the conversation is in."""
        best, back = [0, _FAR, _FAR, _FAR], []
        for r in held:
            costs = r["costs"]
            came = [min(range(4), key=lambda m: (best[m] + costs[4 * m + b], m)) for b in range(4)]
            best = [min(best[m] + costs[4 * m + b], _FAR) for b, m in enumerate(came)]
            back.append(came)
        state, ends = min(range(4), key=lambda s: (best[s], s)), []
        for came in reversed(back):
            ends.append((came[state], state))
            state = came[state]
        out, offset = [], 0
        for r, (first, last) in zip(held, reversed(ends)):
            out.append((r["conv_id"], r["part"], first, last, offset))
            offset += r["n"]
        return out

    return by_runs(segments, ["conv_id"], ["part"], states,
                   "conv_id long, part int, first int, last int, offset long",
                   [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()])


def repaired(turns: DataFrame) -> DataFrame:
    """A row for each turn: conv_id, position, turn, role, new_role, action, inserted, rendered.

    ``inserted`` lists the empty turns before it. ``rendered`` is what the turn adds to the conversation:
    joined by position, these strings are the conversation, but for the end of its last turn (``CLOSED``).
    """
    rows = ordered_turns(turns)
    ends = segment_ends(rows).select(
        F.col("conv_id").alias("of"), F.col("part").alias("in_part"), "first", "last", "offset")
    joined = rows.join(ends, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")))

    def emit(held: list[dict]) -> list[tuple]:
        out = []
        steps = repair([r["role"] for r in held], held[0]["first"], held[0]["last"])
        for i, (r, (state, action, inserted)) in enumerate(zip(held, steps)):
            role, position = ROLES[state - 1], r["offset"] + i
            text = "\n" if action == "merge" else CLOSED if position else ""
            for s in inserted:
                text += opened(ROLES[s - 1]) + CLOSED
            text += r["text"] if action == "merge" else opened(role) + r["text"]
            out.append((r["conv_id"], position, r["turn"], r["role"], role, action,
                        [ROLES[s - 1] for s in inserted], text))
        return out

    return by_runs(
        joined.select("conv_id", "part", "at", "turn", "role", "text", "first", "last", "offset"),
        ["conv_id", "part"], ["at"], emit,
        "conv_id long, position long, turn long, role string, new_role string, action string, "
        "inserted array<string>, rendered string",
        [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string()])
