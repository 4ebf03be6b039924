"""Benchmark decontamination: a generalised suffix automaton of the normalised test items.

Training words stream through the automaton, which keeps the longest suffix that occurs in
any item. Words inside an occurring window are hit; spans of them are cut out, and a document
hit beyond a share of its words goes whole.

The automaton is broadcast, so its size is bounded: the items are dealt to shards of at most
``SHARD_BYTES`` of text (one item at least), and documents pass the shards one after another.
Nothing is shuffled.

Defined cases: a null text has no words and no hits. An item without words or without an id is
no item. Repeated items count once; repeated rows are judged row by row. Empty tables give
empty results, an empty benchmark gives no hits. Columns beside the named ones pass untouched,
whatever their names; one that is named as a result gives way to it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .arrow import map_batches

#: Text bytes of the items in one broadcast automaton.
SHARD_BYTES = 4_000_000

#: Byte for byte: letters A-Z in lower case, digits, a-z and everything beyond ASCII as they are, the rest a space.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))

FOUND = "n_words bigint, hit array<struct<start: bigint, stop: bigint, longest: bigint>>, items array<bigint>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split() if text else []


class Automaton:
    """All substrings of the items' word sequences; ``window`` words make an occurrence.

    ``owners`` has the items of each class of window-long strings, ``whole`` the items shorter
    than a window which end there.
    """

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(t)]) for i, t in items]
        texts = [(i, w) for i, w in texts if w]
        self.shortest = min([window, *(len(w) for _, w in texts)]) if texts else 0
        for _, words in texts:
            last = 0
            for c in words:
                last = self._extend(last, c)
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        self.top = [0] * len(self.next)
        for v in order:
            up = self.link[v]
            self.top[v] = v if self.length[up] < window else self.top[up]
        self.owners: dict[int, set[int]] = {}
        own: dict[int, list[tuple[int, int]]] = {}
        for i, words in texts:
            state = 0
            for k, c in enumerate(words, 1):
                state = self.next[state][c]
                if k >= window:
                    self.owners.setdefault(self.top[state], set()).add(i)
            if len(words) < window:
                own.setdefault(state, []).append((len(words), i))
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for v in order:
            if found := own.get(v, []) + self.whole.get(self.link[v], []):
                self.whole[v] = found

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the strings that end ``p`` and then ``c``."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int, int]], set[int]]:
        """Hit spans of words as (start, stop, longest match that ends in it), and the items found."""
        hits, items = [], set()
        if not self.shortest or len(words) < self.shortest:
            return hits, items
        known = self.vocabulary
        ids = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        # A match holds only known words, so only long enough runs of them need the automaton.
        gaps = np.concatenate(([-1], np.flatnonzero(ids < 0), [len(ids)]))
        for g in np.flatnonzero(np.diff(gaps) > self.shortest):
            self._walk(ids, int(gaps[g]) + 1, int(gaps[g + 1]), hits, items)
        return hits, items

    def _walk(self, ids: np.ndarray, begin: int, end: int, hits: list, items: set) -> None:
        edges, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for at, c in enumerate(ids[begin:end].tolist(), begin):
            while state and c not in edges[state]:
                state = link[state]
                matched = length[state]
            if c in edges[state]:
                state = edges[state][c]
                matched += 1
            reach = 0
            if matched >= window:
                reach = window
                items |= self.owners[self.top[state]]
            for n, item in self.whole.get(state, ()):
                if n <= matched:
                    reach = max(reach, n)
                    items.add(item)
            if reach:
                start, longest = at + 1 - reach, matched
                while hits and hits[-1][1] >= start:
                    a, _, b = hits.pop()
                    start, longest = min(start, a), max(longest, b)
                hits.append((start, at + 1, longest))


#: The automaton this worker has built last, by the name its broadcast was given.
_BUILT: dict[str, Automaton] = {}


def _automaton(name: str, sent, window: int) -> Automaton:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Automaton(sent.value, window)
    return _BUILT[name]


def _merged(spans: list[tuple[int, int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for a, b, n in sorted(spans):
        if out and a <= out[-1]["stop"]:
            out[-1]["stop"], out[-1]["longest"] = max(out[-1]["stop"], b), max(out[-1]["longest"], n)
        else:
            out.append({"start": a, "stop": b, "longest": n})
    return out


def shards(benchmark: DataFrame, id_col: str, text_col: str, shard_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in lists of about ``shard_bytes`` of text each."""
    items = benchmark.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = -(-total // shard_bytes)
    for k in range(n):
        yield [(r.i, r.t) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


def find_matches(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 window: int = 10, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, the merged ``hit`` spans of words and the ``items`` found."""
    docs = docs.drop("n_words", "hit", "items")
    found = docs.withColumns({"n_words": F.lit(-1).cast("bigint"), "hit": F.lit(None).cast("array<struct<start: bigint, stop: bigint, longest: bigint>>"), "items": F.lit(None).cast("array<bigint>")})
    given = docs.columns
    at, first = given.index(text_col), len(given)
    lists = list(shards(benchmark, item_col, item_text_col, shard_bytes)) or [[]]
    for k, items in enumerate(lists):
        sent, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

        def scan(batches: Iterator[pa.RecordBatch], sent=sent, name=name) -> Iterator[dict]:
            automaton = _automaton(name, sent, window)
            for b in batches:
                n, hit, owners = [], [], []
                for text, old, seen in zip(*(b.column(i).to_pylist() for i in (at, first + 1, first + 2)), strict=True):
                    words = words_of(text)
                    spans, items = automaton.scan(words)
                    n.append(len(words))
                    hit.append(_merged([*((x["start"], x["stop"], x["longest"]) for x in old or ()), *spans]))
                    owners.append(sorted({*(seen or ()), *items}))
                yield {c: b.column(i) for i, c in enumerate(given)} | {"n_words": n, "hit": hit, "items": owners}

        found = map_batches(found, scan, found.schema)
        if k + 1 < len(lists):  # one automaton at a time in a worker's memory
            found = checkpoint(found)
    return found


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans, from the first letter to the last."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(NORMAL))]
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", window: int = 10, max_span: int = 0, max_coverage: float = 0.5, **named) -> DataFrame:
    """``docs`` with ``clean_text`` and ``drop``.

    Spans of more than ``max_span`` hit words are cut out of the text; a document with more than
    ``max_coverage`` of its words hit is to be dropped.
    """
    found = find_matches(docs.drop("clean_text", "drop"), benchmark, text_col=text_col, window=window, **named)
    given = found.columns
    at, spans = given.index(text_col), given.index("hit")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            long = [[(x["start"], x["stop"]) for x in h if x["stop"] - x["start"] > max_span] for h in b.column(spans).to_pylist()]
            texts = [cut_text(t, s) if s else t for t, s in zip(b.column(at).to_pylist(), long, strict=True)]
            yield {c: b.column(i) for i, c in enumerate(given)} | {"clean_text": texts}

    hit = F.aggregate("hit", F.lit(0).cast("bigint"), lambda n, x: n + x["stop"] - x["start"])
    return map_batches(found, cut, found.select("*", F.lit(None).cast("string").alias("clean_text")).schema).withColumn("drop", hit > max_coverage * F.col("n_words"))
