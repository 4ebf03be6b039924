"""Secret scans with column functions alone.

Base patterns find assignments, access keys and hexadecimal strings. Beside them, candidate
strings (long runs of letters, digits and ``+/_-``) are scanned by a sliding window: a fold
over the characters adds the entering one to the counts, takes the leaving one off, and updates
the Shannon entropy from these two counts only. Each character class has a threshold of its own;
windows at or above it merge to spans. Candidates on the allow list give none, nor do spans that
a base span holds already.

Sums of count x log2(count) are whole billionths, so that adding and taking off is exact.

Every step is linear in the text: arrays are worked in short pieces, so that no list grows by copying itself, and
no pattern repeats a group without bound, which would cost stack. Very long texts and texts dense with
secrets take time in proportion.

Defined cases: a null text is empty and has no secrets; empty tables give empty results; repeated
rows are scanned row by row. Other columns pass untouched; one named ``secrets`` gives way to the
result. Positions count code points, the end is exclusive. Spans of equal start stand in the order of their kinds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, which group must have a least length, and that length. A run of
#: signs that is too short holds no longer one, so for the last two the length stands in the pattern.
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE = (("assign", ASSIGN, 2, 12), ("access", ACCESS, 0, 18), ("hex", HEX, 0, 16))

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
WINDOW = 20
BILLION = 10**9


@dataclass(frozen=True)
class CharacterClass:
    """Candidates made of the pattern's characters alone, and bits of entropy that make a window suspicious."""

    name: str
    pattern: str
    bits: float


#: A candidate belongs to the first class it fits.
CLASSES = (CharacterClass("hex", "^[0-9a-fA-F]+$", 3.05), CharacterClass("alnum", "^[A-Za-z0-9]+$", 3.55), CharacterClass("base64", "^.*$", 3.75))

#: Candidates with one of these are no secrets: words, words joined by signs, UUIDs, examples and plain sequences.
ALLOWED = (
    r"^[A-Za-z]+$",
    # Letters, or up to four digits, between signs, letters first: stated by what may not stand there.
    r"^(?![0-9])(?!.*(?:[A-Za-z][0-9]|[0-9][A-Za-z]|[0-9]{5}|[^A-Za-z0-9/_-])).*[/_-][A-Za-z0-9]",
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"[eE][xX][aA][mM][pP][lL][eE]",
    r"0123456789|1234567890|abcdefghij|ABCDEFGHIJ",
)

SPAN = "array<struct<start: int, stop: int>>"
TEXT_SPAN = "array<struct<start: int, stop: int, value: string>>"
#: Elements of an array, and windows of a candidate, that one fold walks.
PIECE = 128
#: Counts of five bits in a long.
PACKED = 12


def weights(window: int = WINDOW) -> list[int]:
    """count x log2(count) in billionths, for counts up to a window."""
    return [round(n * math.log2(n) * BILLION) if n else 0 for n in range(window + 1)]


def largest_sum(bits: float, window: int = WINDOW) -> int:
    """Windows whose weights sum up to this at most have ``bits`` of entropy."""
    return math.floor(window * (math.log2(window) - bits) * BILLION)


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), fn), 0)


def _offsets(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(PIECE))).otherwise(F.array().cast("array<int>"))


def running(values: Column, zero: Column, joined: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array, each with its own value: within pieces, and of the pieces' totals."""

    def grow(some: Column, start: Column) -> Column:
        return F.aggregate(some, F.array(start), lambda acc, v: F.concat(acc, F.array(joined(F.element_at(acc, -1), v))))

    def of(pieces: Column) -> Column:
        before = grow(F.transform(pieces, lambda p: F.aggregate(p, zero, joined)), zero)
        inside = F.zip_with(pieces, F.slice(before, 1, F.size(pieces)), lambda p, start: F.slice(grow(p, start), 2, PIECE))
        return F.flatten(inside)

    return let(values, lambda v: let(F.transform(_offsets(F.size(v)), lambda i: F.slice(v, i + 1, PIECE)), of))


def matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches as spans; those whose group is shorter than ``least`` are dropped after matching."""
    whole, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def spans(found: Column) -> Column:
        lengths = F.zip_with(gaps, found, lambda g, w: F.length(g) + F.coalesce(F.length(w), F.lit(0)))
        part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
        each = F.arrays_zip(running(lengths, F.lit(0), lambda a, b: a + b).alias("stop"), found.alias("value"), part.alias("part"))
        long = F.filter(each, lambda x: F.length(x["part"]) >= least)
        return F.transform(long, lambda x: F.struct((x["stop"] - F.length(x["value"])).alias("start"), x["stop"].alias("stop"), x["value"].alias("value")))

    return F.when(text.rlike(pattern), let(whole, spans)).otherwise(F.array().cast(TEXT_SPAN))


def _bytes(text: Column, start: Column, length: Column | int) -> Column:
    """Part of a text of one byte a sign, found without reading what stands before."""
    return F.substring(text.cast("binary"), start + 1, F.lit(length) if isinstance(length, int) else length).cast("string")


def _merged(spans: Column) -> Column:
    """Spans in order, those that touch as one."""
    goes_on = lambda a, b: F.coalesce(b["start"] <= a["stop"], F.lit(False))
    first = F.filter(spans, lambda s, i: ~goes_on(F.get(spans, i - 1), s))
    last = F.filter(spans, lambda s, i: ~goes_on(s, F.get(spans, i + 1)))
    return F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), b["stop"].alias("stop")))


def entropy_spans(candidate: Column, classes: Sequence[CharacterClass] = CLASSES, window: int = WINDOW) -> Column:
    """Spans of the candidate whose windows reach their class's entropy."""
    if window > 31:
        raise ValueError("windows have 31 signs at most")
    weight = F.array(*(F.lit(w).cast("bigint") for w in weights(window)))
    slots = F.array(*(F.lit(i // PACKED) for i in range(len(ALPHABET))))
    shifts = F.array(*(F.lit(5 * (i % PACKED)) for i in range(len(ALPHABET))))
    limit = F.lit(-1).cast("bigint")
    for c in reversed(classes):
        limit = F.when(candidate.rlike(c.pattern), F.lit(largest_sum(c.bits, window)).cast("bigint")).otherwise(limit)

    def fold(letters: Column, most: Column, offset: Column) -> Column:
        """Windows of a piece. The window slides by pairs of the entering and the leaving letter; -1 leaves nothing."""
        leaving = F.concat(F.array_repeat(F.lit(-1), window), letters)
        moves = F.slice(F.arrays_zip(letters.alias("enter"), leaving.alias("leave")), 1, F.size(letters))
        empty = F.struct(F.lit(0).alias("at"), F.array_repeat(F.lit(0).cast("bigint"), -(-len(ALPHABET) // PACKED)).alias("counts"), F.lit(0).cast("bigint").alias("sum"), F.array().cast(SPAN).alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            enter, leave = x["enter"], x["leave"]
            count = lambda c: F.call_function("shiftright", F.get(acc["counts"], F.get(slots, c)), F.get(shifts, c)).bitwiseAND(F.lit(31)).cast("int")
            one = lambda c, i: F.when(i == F.get(slots, c), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.get(shifts, c))).otherwise(F.lit(0).cast("bigint"))
            counts = F.transform(acc["counts"], lambda n, i: n + one(enter, i) - one(leave, i))
            gain = let(count(enter), lambda n: F.get(weight, n + 1) - F.get(weight, n))
            loss = F.when(leave >= 0, let(count(leave), lambda n: F.get(weight, n - 1) - F.get(weight, n))).otherwise(F.lit(0).cast("bigint"))
            change = F.when(enter == leave, F.lit(0).cast("bigint")).otherwise(gain + loss)
            return let(acc["sum"] + change, lambda total: F.struct((acc["at"] + 1).alias("at"), counts.alias("counts"), total.alias("sum"), grown(acc["spans"], acc["at"] + 1, total).alias("spans")))

        def grown(spans: Column, at: Column, total: Column) -> Column:
            last = F.get(spans, F.size(spans) - 1)
            joined = F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(F.struct(last["start"].alias("start"), (offset + at).alias("stop"))))
            added = F.concat(spans, F.array(F.struct((offset + at - window).alias("start"), (offset + at).alias("stop"))))
            return F.when((at < window) | (total > most), spans).when(last["stop"] >= offset + at - window, joined).otherwise(added)

        return F.aggregate(moves, empty, step, lambda acc: acc["spans"])

    def piece(offset: Column, most: Column) -> Column:
        signs = F.split(_bytes(candidate, offset, PIECE + window - 1), "")
        return let(F.transform(signs, lambda x: F.instr(F.lit(ALPHABET), x) - 1), lambda letters: fold(letters, most, offset))

    return let(limit, lambda most: let(F.flatten(F.transform(_offsets(F.length(candidate) - (window - 1)), lambda o: piece(o, most))), _merged))


def find_secrets(docs: DataFrame, *, text_col: str = "text", classes: Sequence[CharacterClass] = CLASSES, window: int = WINDOW,
                 allowed: Sequence[str] = ALLOWED, allowed_strings: Sequence[str] = ()) -> DataFrame:
    """``docs`` with ``secrets``: ``kind, start, stop, value`` ordered by start, then kind as listed, entropy last."""
    docs = docs.drop("secrets")
    text = F.coalesce(F.col(text_col), F.lit(""))

    def span(rank: int, kind: str, start: Column, stop: Column, value: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), F.lit(kind).alias("kind"), value.alias("value"))

    named = lambda spans, rank, kind: F.transform(spans, lambda s: span(rank, kind, s["start"], s["stop"], s["value"]))
    base = F.flatten(F.array(*(named(matches(text, pattern, group, least), k, kind) for k, (kind, pattern, group, least) in enumerate(BASE))))

    def of_candidate(c: Column) -> Column:
        value = c["value"]
        fine = value.isin(*allowed_strings) if allowed_strings else F.lit(False)
        for pattern in allowed:
            fine = fine | value.rlike(pattern)
        inside = F.transform(entropy_spans(value, classes, window), lambda s: span(
            len(BASE), "entropy", c["start"] + s["start"], c["start"] + s["stop"], _bytes(value, s["start"], s["stop"] - s["start"])))
        return F.when(~fine, inside)

    fresh = F.flatten(F.filter(F.transform(matches(text, CANDIDATE, 0, 1), of_candidate), lambda x: x.isNotNull()))

    def apart(every: Column) -> Column:
        """Without entropy spans that lie in a base span: one that begins no later and ends no earlier."""
        stops = F.transform(every, lambda s: F.when(s["rank"] < len(BASE), s["stop"]).otherwise(0))
        return let(running(stops, F.lit(0), lambda a, b: F.greatest(a, b)), lambda most: F.filter(every, lambda s, i: (s["rank"] < len(BASE)) | (F.get(most, i) < s["stop"])))

    d = docs.withColumn("secrets", let(F.array_sort(F.concat(base, fresh)), apart))
    return d.withColumn("secrets", F.transform("secrets", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"))))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
