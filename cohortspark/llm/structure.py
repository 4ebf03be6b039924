"""Repair of conversation structure by Four-Russians block tables.

A legal conversation is an optional system turn and then turns of user and assistant in pairs. Turns may be
kept, given a role, deleted, and empty turns inserted, each at a price; of the cheapest repairs that one is taken
whose edits, written as a string of initials, come first in ASCII order.

The costs to go from each of the four states form a vector. Less its minimum it is one of
a few dozen, since states reach each other at bounded prices; so a turn (one of nine symbols: its role's initial, whole
or truncated, or one that must go) is a step in a finite table, and ``BLOCK`` turns are one lookup in a
table of all vectors and all blocks. Costs to go are looked up block by block from the last turn to
the first; then the blocks are expanded backwards against that order, first turn first, where each state's
first cheapest initial is known. Read from the front, the least initial that stays
cheapest gives the least string, so ties are safe.

Rows are ordered by conversation and turn over all partitions. What surely lies within a partition and fits in
``HELD`` bytes is repaired in place. Conversations that a partition begins or ends with, and long ones, are put together
from pieces, one a partition: a piece maps every vector behind it to one before it, then every state before
it to one behind it, and both maps fold over the pieces of a conversation, so none gathers in a task.

Defined cases: null roles and texts count as one space, so they are no legal role and blank. Null
turn numbers come first and are in no gap. Turns of equal number are ordered by role, then text. Repeated rows are
duplicates. A null conversation id is a conversation of its own. An empty role has no initial and is not legal.
Very long texts and conversations stream; only the audit string of a conversation lies in memory as a whole. Empty tables give
empty results; columns beside the four named ones are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .arrow import map_batches

#: Prices of a given role, a deletion and an insertion, and of a truncated turn that stays.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, and the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: The state behind a turn of a role's initial, and behind a turn whose role may be chosen.
BY_ROLE = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "": {}}
CHOSEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Symbols: role initials whole, role initials truncated, a turn that must go.
ROLES = ("s", "u", "a", "")
MUST_GO = 2 * len(ROLES)
SYMBOLS = MUST_GO + 1
#: Turns of a block, and bytes of text of a conversation that a task holds.
BLOCK, HELD = 4, 4_000_000
SPACE = " \t\n\x0b\x0c\r"
#: What inserting up to the end costs.
END = (0, 2 * INSERT, INSERT, 0)
LAST_EDITS = ("", "II", "I", "")


class Tables:
    """All cost vectors, the step of each symbol and of each block, and the edits each step takes."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        ids, steps, edits = {END: 0}, [], []
        order = [END]
        for vector in order:  # grows while it is walked
            row, how = [], []
            for symbol in range(SYMBOLS):
                costs, found = self.step(vector, symbol)
                low = min(costs)
                after = tuple(c - low for c in costs)
                if after not in ids:
                    ids[after] = len(order)
                    order.append(after)
                row.append(ids[after])
                how.append(found)
            steps.append(row)
            edits.append(how)
        self.vectors, self.edits = order, edits
        self.one = np.array(steps, np.int16)
        self.many = np.arange(len(order), dtype=np.int16)[:, None]
        for _ in range(block):  # a symbol before the blocks there are
            self.many = np.concatenate([self.one[self.many, s] for s in range(SYMBOLS)], axis=1)
        self.weights = SYMBOLS ** np.arange(block - 1, -1, -1)

    @staticmethod
    def step(vector: tuple[int, ...], symbol: int) -> tuple[list[int], list[tuple[str, int]]]:
        """Costs to go before a turn, from those behind it; and each state's edits up to and with the turn, and the state behind."""
        role, stays = ROLES[symbol % len(ROLES)], TRUNCATED if symbol >= len(ROLES) else 0
        options: list[list[tuple[int, str, int]]] = []
        for q in range(4):
            mine = [(DELETE + vector[q], "D", q)]
            if symbol != MUST_GO:
                if q in BY_ROLE[role]:
                    mine.append((stays + vector[BY_ROLE[role][q]], "K", BY_ROLE[role][q]))
                mine.append((RENAME + stays + vector[CHOSEN[q]], "R", CHOSEN[q]))
            options.append(mine)
        costs, found = [], []
        for q in range(4):
            mine, state = list(options[q]), q
            for k in (1, 2):
                state = CHOSEN[state]
                mine += [(c + k * INSERT, "I" * k + e, t) for c, e, t in options[state]]
            best = min(mine)  # the cheapest, then the least string
            costs.append(best[0])
            found.append(best[1:])
        return costs, found

    def behind(self, symbols: np.ndarray, vector: int = 0) -> tuple[list[int], int]:
        """The vector behind each block, looked up from the end on; and the one before the first."""
        n, k = len(symbols), self.block
        whole = n // k * k
        for s in symbols[whole:][::-1]:
            vector = int(self.one[vector, s])
        codes = symbols[:whole].reshape(-1, k) @ self.weights
        out = []
        for code in codes[::-1].tolist():
            out.append(vector)
            vector = int(self.many[vector, code])
        return out[::-1], vector

    def transfer(self, symbols: np.ndarray) -> np.ndarray:
        """For every vector behind the symbols the one before them."""
        ids, k = np.arange(len(self.vectors), dtype=np.int16), self.block
        whole = len(symbols) // k * k
        for s in symbols[whole:][::-1]:
            ids = self.one[ids, s]
        for code in (symbols[:whole].reshape(-1, k) @ self.weights)[::-1].tolist():
            ids = self.many[ids, code]
        return ids

    def trace(self, symbols: np.ndarray, state: int = START, vector: int = 0) -> tuple[list[str], int]:
        """Each turn's edits (insertions before it, then its own) and the state behind the last; blocks are expanded one at a time."""
        ends, _ = self.behind(symbols, vector)
        k, out = self.block, []
        for b in range(-(-len(symbols) // k)):
            some = symbols[b * k : (b + 1) * k].tolist()
            vectors = [ends[b] if b < len(ends) else vector]
            for s in some[:0:-1]:
                vectors.append(int(self.one[vectors[-1], s]))
            for s, v in zip(some, reversed(vectors), strict=True):
                edits, state = self.edits[v][s][state]
                out.append(edits)
        return out, state


@cache
def tables(block: int = BLOCK) -> Tables:
    """One set of tables a process."""
    return Tables(block)



ROWS = "conv string, part int, at bigint, sub int, turn bigint, role string, text string, fault string, edit string, new_role string, cost int"
FIELDS = tuple(f.split()[0] for f in ROWS.split(", "))


def _fault(text: str) -> str:
    left = text.rstrip(SPACE)
    return "blank" if not left else "" if left[-1] in ".!?" else "truncated"


def _symbol(role: str, fault: str) -> int:
    if fault in ("blank", "duplicate"):
        return MUST_GO
    initial = role[:1] if role[:1] in ROLES else ""
    return ROLES.index(initial) + (len(ROLES) if fault == "truncated" else 0)


def _edited(turns: list[tuple], edits: list[str], state: int, last: bool) -> Iterator[tuple]:
    """Rows of the repair; ``turns``: ``conv, part, at, turn, role, text, fault``. Insertions have rows of their own."""
    for (conv, part, at, turn, role, text, fault), e in zip(turns, edits, strict=True):
        for i in range(len(e) - 1):
            state = CHOSEN[state]
            yield conv, part, at, i, None, None, "", "", "I", NAMES[state], INSERT
        own, name = e[-1], None
        if own == "K":
            state, name = BY_ROLE[role[:1]][state], role
        elif own == "R":
            state = CHOSEN[state]
            name = NAMES[state]
        price = DELETE if own == "D" else (RENAME if own == "R" else 0) + (TRUNCATED if fault == "truncated" else 0)
        yield conv, part, at, 8, turn, role, text, fault, own, name, price
    if last:
        for i in range(len(LAST_EDITS[state])):
            state = CHOSEN[state]
            yield turns[-1][0], turns[-1][1], turns[-1][2], 9 + i, None, None, "", "", "I", NAMES[state], INSERT


def _columns(rows: list[tuple]) -> dict[str, list]:
    return dict(zip(FIELDS, map(list, zip(*rows, strict=True)), strict=True))


def _in_order(turns: DataFrame, cols: tuple[str, ...], partitions: int | None, block: int, held_bytes: int) -> DataFrame:
    """Turns in order over all partitions, repaired where a conversation surely ends within one; ``edit`` is null elsewhere."""
    conv, turn, role, text = cols
    rows = turns.select(F.col(conv).cast("string").alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    order = ["conv", "turn", "role", "text"]
    spread = (rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)).sortWithinPartitions(*order)

    def settle(held: list[tuple]) -> list[tuple]:
        seen, known = set(), []
        for c, p, at, turn, role, text, fault in held:
            fault = fault if fault == "blank" or (role, text) not in seen else "duplicate"
            seen.add((role, text))
            known.append((c, p, at, turn, role, text, fault))
        edits, _ = tables(block).trace(np.array([_symbol(r[4], r[6]) for r in known], np.int64))
        return list(_edited(known, edits, START, True))

    def open_rows(held: list[tuple]) -> list[tuple]:
        return [(c, p, at, 8, turn, role, text, fault, None, None, None) for c, p, at, turn, role, text, fault in held]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, at, some, conv = TaskContext.get().partitionId(), 0, False, None
        held: list[tuple] = []
        size, is_open = 0, part > 0  # what a partition begins with may have begun before
        for b in batches:
            out: list[tuple] = []
            for c, turn, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if some and c != conv:
                    if held:
                        out += settle(held) if not is_open else open_rows(held)
                    held, size, is_open = [], 0, False
                some, conv = True, c
                held.append((c, part, at, turn, role, text, _fault(text)))
                at, size = at + 1, size + len(text) + 64
                if is_open or size > held_bytes:
                    is_open = True
                    out += open_rows(held)
                    held, size = [], 0
            if out:
                yield _columns(out)
        if held:  # may go on in the next partition
            yield _columns(open_rows(held))

    return checkpoint(map_batches(spread, run, ROWS))


def _each(df: DataFrame, shape: str, fn) -> DataFrame:
    """``fn`` of the symbols (and further values) of each row, whose results are new columns beside ``conv, part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            rows = [(c, p, *fn(np.frombuffer(s, np.uint8).astype(np.int64), *more)) for c, p, s, *more in zip(*(x.to_pylist() for x in b.columns), strict=True)]
            yield dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}

    names = ["conv", "part", *(f.split()[0] for f in shape.split(", "))]
    return map_batches(df, run, f"conv string, part int, {shape}")


def _fold(df: DataFrame, value: str, name: str, fn, backwards: bool) -> DataFrame:
    """Along the pieces of each conversation (one a partition it fills): ``name``, a number carried from piece to piece by ``fn(number, value)``."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("part", "descending" if backwards else "ascending")])
        out, now = [], 0
        for x in t[value].to_pylist():
            out.append(now)
            now = fn(now, x)
        return pa.table({"conv": t["conv"].cast(pa.string()), "part": t["part"].cast(pa.int32()), name: pa.array(out, pa.int32())})

    return df.groupBy("conv").applyInArrow(run, f"conv string, part int, {name} int")


def _beside(a: DataFrame, b: DataFrame) -> DataFrame:
    b = b.withColumnsRenamed({"conv": "_conv", "part": "_part"})
    return a.join(b, a["conv"].eqNullSafe(b["_conv"]) & (a["part"] == b["_part"])).drop("_conv", "_part")


def _put_together(rows: DataFrame, block: int) -> DataFrame:
    """Repairs of conversations that lie in several partitions or are long."""
    first = rows.groupBy("conv", "role", F.md5("text").alias("_digest")).agg(F.min(F.struct("part", "at")).alias("m")).select(F.col("m.part").alias("part"), F.col("m.at").alias("at"), F.lit(True).alias("first"))
    fault = F.when(F.col("fault").isin("blank"), "blank").when(F.col("first").isNull(), "duplicate").otherwise(F.col("fault")).alias("fault")
    known = checkpoint(rows.select("conv", "part", "at", "turn", "role", "text", "fault").join(first, ["part", "at"], "left").select("conv", "part", "at", "turn", "role", "text", fault))
    spread = lambda df, *c: df.repartition("conv", "part").sortWithinPartitions("conv", "part", *c)

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, held = None, bytearray()
        for b in batches:
            for c, p, role, fault in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if key is not None and (c, p) != key:
                    yield {"conv": [key[0]], "part": [key[1]], "symbols": [bytes(held)]}
                    held = bytearray()
                key = (c, p)
                held.append(_symbol(role, fault))
        if key is not None:
            yield {"conv": [key[0]], "part": [key[1]], "symbols": [bytes(held)]}

    short = spread(known.select("conv", "part", F.substring("role", 1, 1).alias("role"), "fault", "at"), "at").select("conv", "part", "role", "fault")
    pieces = checkpoint(map_batches(short, symbols, "conv string, part int, symbols binary"))
    maps = _each(pieces, "map binary", lambda s: (tables(block).transfer(s).tobytes(),))
    vectors = _fold(maps, "map", "vector", lambda v, x: int(np.frombuffer(x, np.int16)[v]), True)
    pieces = checkpoint(_beside(pieces, vectors).select("conv", "part", "symbols", "vector"))
    states = _each(pieces, "map binary", lambda s, v: (bytes(tables(block).trace(s, q, v)[1] for q in range(4)),))
    begins = _fold(states, "map", "state", lambda q, x: x[q], False)
    ends = pieces.groupBy(F.col("conv").alias("_conv")).agg(F.max("part").alias("_last"))
    pieces = _beside(pieces, begins)
    pieces = pieces.join(ends, pieces["conv"].eqNullSafe(ends["_conv"])).select("conv", "part", "symbols", "vector", "state", (F.col("part") == F.col("_last")).alias("last"))
    traced = _each(pieces, "state int, last boolean, edits string", lambda s, v, q, last: (q, last, ",".join(tables(block).trace(s, q, v)[0])))
    head = traced.select("conv", "part", F.lit(-1).cast("bigint").alias("at"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit("").alias("fault"), "state", "last", "edits")
    body = known.select("*", F.lit(None).cast("int").alias("state"), F.lit(None).cast("boolean").alias("last"), F.lit(None).cast("string").alias("edits"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        edits, state, last, k = [], START, False, 0
        for b in batches:
            out: list[tuple] = []
            for *turn, q, z, e in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if e is not None:
                    edits, state, last, k = e.split(","), q, z, 0
                    continue
                rows = list(_edited([tuple(turn)], [edits[k]], state, last and k == len(edits) - 1))
                for r in rows:
                    state = CHOSEN[state] if r[8] in "IR" else BY_ROLE[r[5][:1]][state] if r[8] == "K" else state
                out += rows
                k += 1
            if out:
                yield _columns(out)

    return map_batches(spread(head.unionByName(body), "at"), write, ROWS)


def repair_structure(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                     partitions: int | None = None, block: int = BLOCK, held_bytes: int = HELD) -> DataFrame:
    """One row a turn and one an insertion: ``conv, part, at, sub`` (their order), ``turn, role, text, fault, edit, new_role, cost``.

    ``fault`` is blank, duplicate, truncated or empty; ``edit`` K (kept), R (role given), D (deleted) or I (inserted), and
    ``new_role`` the role after it, null for what is deleted.
    """
    rows = _in_order(turns, (conv_col, turn_col, role_col, text_col), partitions, block, held_bytes)
    apart = rows.where("edit IS NULL")
    if apart.isEmpty():
        return rows
    return rows.where("edit IS NOT NULL").unionByName(checkpoint(_put_together(apart, block)))


def summaries(repaired: DataFrame) -> DataFrame:
    """One row a conversation: what was wrong, what the repair costs, its edits and a digest of the repaired turns.

    A digest of a conversation reads its turns one after another, so each streams through one task; nothing but the
    edits is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now: dict | None = None

        def close() -> dict:
            gaps = now["high"] - now["low"] + 1 - now["distinct"] if now["distinct"] else 0
            return {"conv": [now["conv"]], "gaps": [gaps], **{c: [now[c]] for c in ("blank", "duplicate", "truncated", "illegal", "cost")},
                    "audit": ["".join(now["audit"])], "repaired_sha256": [now["sha"].hexdigest()]}

        for b in batches:
            for conv, turn, role, text, fault, edit, new_role, cost in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if now is None or now["conv"] != conv:
                    if now is not None:
                        yield close()
                    now = {"conv": conv, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [], "sha": hashlib.sha256(), "any": False,
                           "distinct": 0, "low": None, "high": None, "role": None}
                now["cost"] += cost
                now["audit"].append(edit)
                if edit != "I":
                    if fault:
                        now[fault] += 1
                    if now["role"] is not None and now["role"] + role[:1] not in ("su", "ua", "au"):
                        now["illegal"] += 1
                    now["role"] = role[:1]
                    if turn is not None and turn != now["high"]:  # turns come in order
                        now["low"] = turn if now["low"] is None else now["low"]
                        now["high"], now["distinct"] = turn, now["distinct"] + 1
                if edit != "D":
                    now["sha"].update(f"{chr(10) if now['any'] else ''}{new_role}:{text}".encode("utf-8", "surrogatepass"))
                    now["any"] = True
        if now is not None:
            yield close()

    spread = repaired.repartition("conv").sortWithinPartitions("conv", "part", "at", "sub").select("conv", "turn", "role", "text", "fault", "edit", "new_role", "cost")
    return map_batches(spread, run, "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")
