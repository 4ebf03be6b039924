"""Chat formatting with role repair at minimum cost.

Legal conversations are the paths of a small automaton: at the start an optional system turn, then
user and assistant take turns, a user first. Each turn of the input may be kept, relabelled, or merged into
the turn before it; empty turns may be inserted. Every choice has a cost, and dynamic programming
over the automaton's states finds the cheapest legal sequence, which is then rendered.

A turn acts on the costs of states as a small matrix, and matrices of consecutive turns
multiply (minimum for sum, sum for product). So a conversation is no unit of work: rows are ordered
by conversation and turn over all partitions, each partition hands on one matrix for the conversation
it starts with and one for the one it ends with, and a conversation that fills many partitions is put
together from their matrices. Every partition then decodes its own rows between known states.

Defined cases: unknown, null and empty roles may become any role at the price of a relabelling. Rows that
repeat conversation, turn, role and text are one turn. Turns with equal numbers are ordered by role, then
text; nulls come first. A null conversation id is a conversation of its own. A null text is empty.
Empty tables give empty results; columns beside the four named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .arrow import map_batches

ROLES = ("system", "user", "assistant")
#: States: nothing yet, and the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}
NEVER = 1 << 40


@dataclass(frozen=True)
class Costs:
    """Prices of the repairs. ``merge`` joins a turn to one of its own role, ``merge_other`` to one of another."""

    relabel: int = 4
    relabel_unknown: int = 1
    merge: int = 1
    merge_other: int = 6
    insert: int = 3
    #: What a conversation costs that ends in this role.
    end: Mapping[str, int] = field(default_factory=dict)


def inserted(costs: Costs) -> tuple[np.ndarray, list[list[tuple[int, ...]]]]:
    """Cheapest insertions from state to state: cost, and the states passed (the last included)."""
    cost = np.full((4, 4), NEVER, np.int64)
    path: list[list[tuple[int, ...]]] = [[()] * 4 for _ in range(4)]
    for s in range(4):
        cost[s, s] = 0
    for _ in range(4):
        for s in range(4):
            for mid in range(4):
                for t in NEXT[mid]:
                    if cost[s, mid] + costs.insert < cost[s, t]:
                        cost[s, t], path[s][t] = cost[s, mid] + costs.insert, (*path[s][mid], t)
    return cost, path


def role_state(role: str | None) -> int | None:
    """The state of a role's name; None for an unknown one."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else None


class Automaton:
    """Turn matrices and how each of their entries comes about."""

    def __init__(self, costs: Costs = Costs()):
        self.costs = costs
        insert, path = inserted(costs)
        self.moves: dict[int | None, tuple[np.ndarray, list[list[tuple[str, tuple[int, ...]]]]]] = {}
        for own in (None, SYSTEM, USER, ASSISTANT):
            price = np.full((4, 4), NEVER, np.int64)
            how: list[list[tuple[str, tuple[int, ...]]]] = [[("", ())] * 4 for _ in range(4)]
            for s in range(4):
                if s != START:
                    price[s, s], how[s][s] = (costs.merge if own in (s, None) else costs.merge_other), ("merge", ())
                for t in (SYSTEM, USER, ASSISTANT):
                    turn = 0 if own == t else costs.relabel_unknown if own is None else costs.relabel
                    for mid in range(4):
                        if t in NEXT[mid] and insert[s, mid] < NEVER and (c := int(insert[s, mid]) + turn) < price[s, t]:
                            price[s, t], how[s][t] = c, ("keep" if own == t else "relabel", path[s][mid])
            self.moves[own] = (price, how)
        self.end = np.array([0, *(costs.end.get(r, 0) for r in ROLES)], np.int64)

    def matrix(self, roles: list[int | None]) -> np.ndarray:
        """Cheapest costs from each state to each over the turns."""
        out = np.where(np.eye(4, dtype=bool), 0, NEVER).astype(np.int64)
        for own in roles:
            out = np.minimum((out[:, :, None] + self.moves[own][0][None]).min(1), NEVER)
        return out

    def decode(self, roles: list[int | None], begin: int, end: int) -> list[tuple[str, tuple[int, ...], int]]:
        """(action, states inserted before, state after) of each turn, along the cheapest path from state to state."""
        cost = np.full(4, NEVER, np.int64)
        cost[begin] = 0
        back = []
        for own in roles:
            every = cost[:, None] + self.moves[own][0]
            back.append(every.argmin(0))
            cost = np.minimum(every.min(0), NEVER)
        out, state = [], end
        for own, source in zip(reversed(roles), reversed(back), strict=True):
            before = int(source[state])
            action, states = self.moves[own][1][before][state]
            out.append((action, states, state))
            state = before
        return out[::-1]


ROWS = "part int, at bigint, conv string, turn bigint, role string, text string, cost binary"


def order_turns(turns: DataFrame, automaton: Automaton, conv_col: str, turn_col: str, role_col: str, text_col: str, partitions: int | None = None) -> DataFrame:
    """Turns in order over all partitions, and behind each conversation's turns in a partition a row with their matrix; a checkpoint."""
    rows = turns.select(F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")).distinct()
    order = ["conv", "turn", "role", "text"]
    spread = (rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, at, matrix, conv, some = TaskContext.get().partitionId(), 0, None, None, False
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            out = []
            for c, turn, role, text in zip(*columns, strict=True):
                if some and c != conv:
                    out.append((part, at, conv, None, None, None, matrix.tobytes()))
                    at, some = at + 1, False
                one = automaton.moves[role_state(role)][0]
                matrix = np.minimum((matrix[:, :, None] + one[None]).min(1), NEVER) if some else one
                conv, some = c, True
                out.append((part, at, c, turn, role, text, None))
                at += 1
            if out:
                yield dict(zip(("part", "at", "conv", "turn", "role", "text", "cost"), map(list, zip(*out, strict=True)), strict=True))
        if some:
            yield {"part": [part], "at": [at], "conv": [conv], "turn": [None], "role": [None], "text": [None], "cost": [matrix.tobytes()]}

    return checkpoint(map_batches(spread, run, ROWS))


def bounds(ordered: DataFrame, automaton: Automaton) -> DataFrame:
    """``part, conv, begin, end, cost``: between which states each conversation's stretch in a partition runs.

    A conversation has one matrix a partition, so what comes together here is as many rows as it
    fills partitions.
    """
    matrices = ordered.where("cost IS NOT NULL").select("part", F.struct(F.col("conv").isNull().alias("none"), F.coalesce("conv", F.lit("")).alias("conv")).alias("key"), "cost")

    def run(t: pa.Table) -> pa.Table:
        parts, each = zip(*sorted(zip(t["part"].to_pylist(), t["cost"].to_pylist(), strict=True)), strict=True)
        each = [np.frombuffer(x, np.int64).reshape(4, 4) for x in each]
        rest = [automaton.end]  # cheapest costs from a state behind a stretch to the end
        for m in reversed(each):
            rest.append(np.minimum((m + rest[-1][None]).min(1), NEVER))
        rest.reverse()
        state, begin, end = START, [], []
        for k, m in enumerate(each):
            begin.append(state)
            state = int((m[state] + rest[k + 1]).argmin())
            end.append(state)
        total = int(rest[0][START])
        key = t["key"][0].as_py()
        conv = None if key["none"] else key["conv"]
        n = len(parts)
        return pa.table({"part": pa.array(parts, pa.int32()), "conv": pa.array([conv] * n, pa.string()), "begin": pa.array(begin, pa.int32()), "end": pa.array(end, pa.int32()),
                         "cost": pa.array([total] * n, pa.int64()), "last": pa.array([k == n - 1 for k in range(n)])})

    return matrices.groupBy("key").applyInArrow(run, "part int, conv string, begin int, end int, cost bigint, last boolean")


def repair(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", costs: Costs = Costs(),
           opening: str = "<|{role}|>\n", closing: str = "<|end|>\n", partitions: int | None = None) -> DataFrame:
    """The turns in order with their repairs, and each one's share of the rendered conversation.

    ``part, at`` order the rows of a conversation; ``action`` is keep, relabel or merge; ``inserted`` the
    roles of the empty turns put before; ``cost`` the price of the whole conversation. The shares
    (``rendered``) joined in order are the rendered conversation: a turn closes when the next one opens, the
    last one's closing comes with the last row.
    """
    automaton = Automaton(costs)
    ordered = order_turns(turns, automaton, conv_col, turn_col, role_col, text_col, partitions)
    ends = bounds(ordered, automaton)
    known = ends.select(F.col("part").alias("_part"), F.col("conv").alias("_conv"), "begin", "end", F.col("cost").alias("total"), "last")
    rows = ordered.where("cost IS NULL").drop("cost")
    joined = rows.join(known, (F.col("part") == F.col("_part")) & F.col("conv").eqNullSafe(F.col("_conv"))).drop("_part", "_conv")
    spread = joined.repartition("part", "conv").sortWithinPartitions("part", "conv", "at")

    def settle(held: list[tuple]) -> dict:
        part, at, conv, turn, role, text, begin, end, total, last = map(list, zip(*held, strict=True))
        found = automaton.decode([role_state(r) for r in role], begin[0], end[0])
        state, shown = begin[0], []
        for k, ((action, put, after), t) in enumerate(zip(found, text, strict=True)):
            piece = ""
            if action == "merge":
                piece = "\n" + (t or "")
            else:
                for s in (*put, after):
                    piece += (closing if state != START else "") + opening.format(role=ROLES[s - 1])
                    state = s
                piece += t or ""
            if last[0] and k == len(found) - 1:
                piece += closing
            shown.append(piece)
        return {"part": part, "at": at, "conv": conv, "turn": turn, "role": role, "text": text, "action": [a for a, _, _ in found],
                "new_role": [ROLES[s - 1] for _, _, s in found], "inserted": [[ROLES[s - 1] for s in put] for _, put, _ in found], "cost": total, "rendered": shown}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (row[0], row[2]) != (held[0][0], held[0][2]):
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    return map_batches(spread.select("part", "at", "conv", "turn", "role", "text", "begin", "end", "total", "last"), run,
                       "part int, at bigint, conv string, turn bigint, role string, text string, action string, new_role string, inserted array<string>, cost bigint, rendered string")
