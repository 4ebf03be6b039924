"""Spelling variants by Bloom-guided neighbourhoods.

The vocabulary is a word count. Every word's one-edit neighbours (deletions, and replacements by a
later letter; the rest are these seen from the other word) are generated as hashes only: with a
polynomial hash an edit changes a word's hash by one term. They are probed against blocked Bloom
filters of the vocabulary, one shard a word length, a block of 256 bits for sixteen words, one bit in each of
its eight lanes. Only positives become strings and shuffle to an exact join with the
vocabulary, which removes the false ones.

Filters are built by an aggregate (bits of a block are or-ed) and broadcast. What is broadcast at once is
bounded by ``ROUND_BLOCKS``: a larger vocabulary is probed range by range of its blocks, each probe in the round
of its block.

A word's form is its nearest neighbour in count; its root follows forms to the last, by
doubling pointers. Counts at least double from form to form, so few rounds do.

Defined cases: null and empty texts have no words; a null id counts as an empty one where ids matter. Very long texts are
read in stretches, very long words probed in stretches of positions. Repeated rows count again.
Ties between forms go to the smallest in code-point order. Empty tables give empty results; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint, new_folder, remove
from .arrow import map_batches

#: Letters after A-Z are lower-cased; others stand as they are.
LETTERS = "a-zÀ-ÿ"
#: Words of a filter block, and blocks that are broadcast at once (32 bytes each).
BLOCK_WORDS, ROUND_BLOCKS = 16, 1 << 19
#: Longer words share the shard of this length.
LONGEST = 64
#: Counted words a task holds, code points of text it reads and edits it probes at a time.
HELD, STRETCH, PROBES = 1 << 18, 1 << 20, 1 << 21

_R = 0x9E3779B97F4A7C15
_R_BACK = pow(_R, -1, 2**64)


def stretches(text: str, inside: re.Pattern, most: int = STRETCH) -> Iterator[str]:
    """A text in pieces that cut no run of ``inside``; runs longer than a piece stay whole."""
    at = 0
    while at < len(text):
        stop = at + most
        if stop < len(text) and (m := inside.match(text, stop)):
            stop = m.end()
        yield text[at:stop]
        at = stop


def count_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, drop_every: int = 0) -> DataFrame:
    """``word, n``: lower-cased runs of letters and how often they occur.

    With ``drop_every`` a run loses a letter wherever that number divides the CRC-32 of ``id:run``, a
    planted slip of the pen; the letter is the checksum modulo the run's length.
    """
    run_of = re.compile(f"[{LETTERS}]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: dict[str, int] = {}
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                begin = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for piece in stretches(text, run_of):
                    for w, n in Counter(run_of.findall(piece)).items():
                        if len(w) < least_length:
                            continue
                        if drop_every and (h := zlib.crc32(w.encode(), begin)) % drop_every == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1 :]
                            if len(w) < least_length:
                                continue
                        held[w] = held.get(w, 0) + n
                    if len(held) > HELD:
                        yield {"word": list(held), "n": list(held.values())}
                        held = {}
        if held:
            yield {"word": list(held), "n": list(held.values())}

    parts = map_batches(docs.select(F.col(id_col).cast("string"), F.col(text_col)), run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _values(codes: np.ndarray) -> np.ndarray:
    return _mixed(codes.astype(np.uint64) + np.uint64(_R))


def _powers(n: int) -> np.ndarray:
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, _R, np.uint64))))[:n]


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length)


def _by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    yield from groups.items()


class Shards:
    """Where the words of each length lie: blocks from ``first`` on, ``blocks`` of them."""

    def __init__(self, counts: dict[int, int]):
        self.first, self.blocks, self.size = {}, {}, 0
        for length in sorted(counts):
            self.first[length], self.blocks[length] = self.size, -(-counts[length] // BLOCK_WORDS)
            self.size += self.blocks[length]

    def places(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Block and lane bits (five bits a lane) of hashes of words of a length; None if no word is that long."""
        shard = min(length, LONGEST)
        if shard not in self.blocks:
            return None
        h = _mixed(hashes + np.uint64(length))
        block = ((h >> np.uint64(40)) * np.uint64(self.blocks[shard])) >> np.uint64(24)
        return block.astype(np.int64) + self.first[shard], h & np.uint64((1 << 40) - 1)


def build_filters(vocabulary: DataFrame, shards: Shards) -> DataFrame:
    """``block`` and its eight lanes, for blocks that hold a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            words = b.column(0).to_pylist()
            for length, rows in _by_length(words):
                hashes = (_values(_codes([words[i] for i in rows], length)) * _powers(length)).sum(1, dtype=np.uint64)
                block, bits = shards.places(hashes, length)
                yield {"block": block, "bits": bits.view(np.int64)}

    placed = map_batches(vocabulary.select("word"), run, "block bigint, bits bigint")
    lane = lambda i: F.call_function("shiftleft", F.lit(1), F.shiftright("bits", 5 * i).bitwiseAND(F.lit(31)).cast("int"))
    return placed.groupBy("block").agg(*(F.bit_or(lane(i)).alias(f"lane{i}") for i in range(8)))


class Prober:
    """Edits of words that the filter of a range of blocks holds."""

    def __init__(self, shards: Shards, start: int, lanes: np.ndarray, letters: np.ndarray):
        self.shards, self.start, self.lanes, self.letters = shards, start, lanes, letters

    def held(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Indices of the hashes that are positive."""
        placed = self.shards.places(hashes, length)
        if placed is None:
            return np.empty(0, np.int64)
        block, bits = placed
        block = block - self.start
        alive = np.flatnonzero((block >= 0) & (block < self.lanes.shape[1]))
        for i in range(8):
            if not len(alive):
                break
            bit = (bits[alive] >> np.uint64(5 * i) & np.uint64(31)).astype(np.uint32)
            alive = alive[(self.lanes[i, block[alive]] >> bit & np.uint32(1)).astype(bool)]
        return alive

    def edits(self, words: list[str]) -> Iterator[tuple[int, str]]:
        """(index of the word, neighbour that may be in the vocabulary)."""
        values = _values(self.letters)
        for length, rows in _by_length(words):
            powers = _powers(length)
            at_once = max(1, PROBES // (length * max(1, len(self.letters))))
            for k in range(0, len(rows), at_once):
                some = rows[k : k + at_once]
                codes = _codes([words[i] for i in some], length)
                own = _values(codes)
                upto = np.cumsum(own * powers, axis=1, dtype=np.uint64)
                whole = upto[:, -1:]
                # Without letter i; of equal letters in a row only the first.
                before = np.concatenate((np.zeros((len(some), 1), np.uint64), upto[:, :-1]), axis=1)
                fresh = np.flatnonzero(np.concatenate((np.ones((len(some), 1), bool), codes[:, 1:] != codes[:, :-1]), axis=1))
                for j in fresh[self.held((before + (whole - upto) * np.uint64(_R_BACK)).ravel()[fresh], length - 1)].tolist():
                    row, i = divmod(j, length)
                    w = words[some[row]]
                    yield some[row], w[:i] + w[i + 1 :]
                # A later letter for letter i.
                for i0 in range(0, length, step := max(1, PROBES // max(1, len(some) * len(self.letters)))):
                    part = slice(i0, i0 + step)
                    row, i, a = np.nonzero(self.letters[None, None, :] > codes[:, part, None])
                    hashes = whole[row, 0] + (values[a] - own[row, i + i0]) * powers[i + i0]
                    for j in self.held(hashes, length).tolist():
                        at, w = int(i[j]) + i0, words[some[row[j]]]
                        yield some[row[j]], w[:at] + chr(self.letters[a[j]]) + w[at + 1 :]


def near_words(vocabulary: DataFrame, round_blocks: int = ROUND_BLOCKS) -> DataFrame:
    """``word, n, near, near_n``: pairs of words one edit apart, each once, whichever way round."""
    spark = vocabulary.sparkSession
    shard = F.least(F.length("word"), F.lit(LONGEST))
    shards = Shards({r["shard"]: r["n"] for r in vocabulary.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()})
    # No more letters than the pattern has.
    letters = np.sort(np.array([ord(r[0]) for r in vocabulary.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()], np.uint32))
    blocks = checkpoint(build_filters(vocabulary, shards)) if shards.size else None
    found = None
    for start in range(0, max(1, shards.size), round_blocks):
        lanes = np.zeros((8, min(round_blocks, shards.size - start)), np.uint32)
        if shards.size:
            t = blocks.where((F.col("block") >= start) & (F.col("block") < start + round_blocks)).toArrow()
            for i in range(8):
                lanes[i, t["block"].to_numpy() - start] = t[f"lane{i}"].to_numpy().view(np.uint32)
        sent = spark.sparkContext.broadcast(Prober(shards, start, lanes, letters))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[dict]:
            for b in batches:
                words, counts = b.column(0).to_pylist(), b.column(1).to_pylist()
                out: dict[str, list] = {"word": [], "n": [], "guess": []}
                for i, guess in sent.value.edits(words):
                    out["word"].append(words[i])
                    out["n"].append(counts[i])
                    out["guess"].append(guess)
                    if len(out["n"]) >= HELD:
                        yield out
                        out = {"word": [], "n": [], "guess": []}
                yield out

        some = map_batches(vocabulary.select("word", "n"), run, "word string, n bigint, guess string")
        found = some if found is None else found.unionByName(some)
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.join(known, F.col("guess") == F.col("near")).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form: pointers double until none moves."""
    spark, folder = forms.sparkSession, new_folder(forms.sparkSession, "roots")
    now = checkpoint(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), folder)
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = now.select("word", "root").join(up, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved"))
        before, folder = folder, new_folder(spark, "roots")
        now = checkpoint(after, folder)
        remove(spark, before)
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def group_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3, times: int = 2,
                   drop_every: int = 0, round_blocks: int = ROUND_BLOCKS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the vocabulary.

    ``form`` is the near word of largest count if that is ``times`` the word's own, ``root`` the end of the chain
    of forms (the word itself without one), ``n_near`` how many words are one edit away.
    """
    if times < 2:
        raise ValueError("forms must at least double the count, or chains might close")
    vocabulary = checkpoint(count_words(docs, id_col=id_col, text_col=text_col, least_length=least_length, least_count=least_count, drop_every=drop_every))
    pairs = near_words(vocabulary, round_blocks)
    both: Column = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    each = checkpoint(pairs.select(both.alias("p")).select("p.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.max("n").alias("n"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")))
    strong = -F.col("best.less") >= times * F.col("n")
    named = each.select("word", "n_near", F.when(strong, F.col("best.form")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n"))
    ends = roots(named.where(F.col("form").isNotNull()))
    out = vocabulary.join(named, "word", "left").join(ends, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
