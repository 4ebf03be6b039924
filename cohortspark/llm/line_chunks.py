"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of two lines is taken at every line, and in every stretch of ``lines`` lines the pair
with the smallest hash is marked. So marks follow the content: lines put in or taken out move only the marks
around them, and two equal stretches, wherever they stand, have the same pair marked. Only marked pairs
are exchanged; a stretch of ``lines`` lines around a marked pair that stands elsewhere is a chunk to be looked at. A line is
removed if it lies in a chunk that stands before (in a smaller document id, or earlier in the same), once the
bytes of both have been compared. Hence every repeated passage of ``lines`` lines or more is found whole, and nothing
else: what is left does not depend on the marks.

Texts are gathered in blocks. A block sends one number for each distinct marked pair; only chunks around a pair that stands
twice send their bytes, and bytes are what is grouped. So a chunk that all documents share counts once a block.

Defined cases: a null text stays null and has no lines; an empty text is one empty line. Documents of
fewer lines than a chunk keep them. Chunks without a sign beyond blanks are kept. A null id counts as larger than
all others. Rows that repeat an id are one document: what is first in one of them stays in all. Very long texts are a block
of their own, held whole in a task. Empty tables give empty results; other columns pass untouched, those named as results give
way to them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .arrow import map_batches
from .blocks import BLOCK_BYTES, block_rows, gather_blocks, with_lists

#: Lines of the shortest passage that is removed.
LINES = 3
FACTOR = 0x9E3779B97F4A7C15
LAST = (1 << 63) - 1
#: Signs that do not make a chunk worth a look.
BLANK = bytes(range(33))

RESULTS = ("n_lines", "n_removed", "clean_text")


def marks(texts: list[list[bytes]], least: int, digest_bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """First lines of the marked pairs, and their hashes; lines of all texts are numbered through."""
    counts = [len(x) for x in texts]
    n, w = sum(counts), max(1, least - 1)
    if n <= w:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(texts)), np.uint64, n)
    rolled = h[:-1] * np.uint64(FACTOR) + h[1:]
    rolled = ((rolled ^ (rolled >> np.uint64(31))) * np.uint64(FACTOR)) >> np.uint64(64 - digest_bits)
    first = np.flatnonzero(doc[:-w] == doc[w:])  # stretches of w pairs within a text
    stretches = np.lib.stride_tricks.sliding_window_view(rolled, w)[first, ::-1]  # of equal ones the last
    at = np.unique(first + w - 1 - stretches.argmin(1))
    return at, rolled[at].view(np.int64)


class BlockChunks:
    """The lines of a block's documents and their marked pairs."""

    def __init__(self, texts: list[str | None], ids: list[int | None], least: int, digest_bits: int):
        self.lines = [None if t is None else t.encode("utf-8", "surrogatepass").split(b"\n") for t in texts]
        self.ids, self.least = [LAST if i is None else i for i in ids], least
        self.at, self.hashes = marks([x or [] for x in self.lines], least, digest_bits)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the marked pairs, and how often each stands here."""
        return np.unique(self.hashes, return_counts=True)

    def chunks(self, repeated: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
        """(document, first line, bytes) of the chunks around marked pairs that are repeated."""
        k, counts = self.least, np.array([len(x or ()) for x in self.lines])
        doc, begin = np.repeat(np.arange(len(counts)), counts), np.cumsum(counts) - counts
        some = self.at[np.isin(self.hashes, repeated)]
        starts = np.unique((some[:, None] - np.arange(max(1, k - 1))[None, :]).ravel())
        starts = starts[(starts >= 0) & (starts <= len(doc) - k)]
        starts = starts[doc[starts] == doc[starts + k - 1]]
        for d, a in zip(doc[starts].tolist(), (starts - begin[doc[starts]]).tolist(), strict=True):
            if not (chunk := b"\n".join(self.lines[d][a : a + k])).translate(None, BLANK) == b"":
                yield d, a, chunk


def _firsts(chunks: list[tuple[int, int, bytes]], ids: list[int]) -> dict[bytes, tuple[int, int]]:
    """Where each distinct chunk stands first."""
    first: dict[bytes, tuple[int, int]] = {}
    for d, a, chunk in chunks:
        place = (ids[d], a)
        if place < first.setdefault(chunk, place):
            first[chunk] = place
    return first


def remove_chunks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES, block_bytes: int = BLOCK_BYTES, digest_bits: int = 64) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_removed`` and ``clean_text`` without the lines of chunks that stand before."""
    docs = docs.drop(*RESULTS)
    given = docs.columns
    id_at, text_at = given.index(id_col), given.index(text_col)
    blocks = gather_blocks(docs, text_col, block_bytes)
    of = lambda rows: BlockChunks(rows.field(text_at).to_pylist(), rows.field(id_at).to_pylist(), lines, digest_bits)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for rows, (block,) in block_rows(batch):
                pairs, times = of(rows).pairs()
                yield {"block": [block] * len(pairs), "pair": pairs, "twice": times > 1}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for rows, (block, asked) in block_rows(batch):
                if not asked:
                    continue
                found = of(rows)
                first = _firsts(list(found.chunks(np.array([x["pair"] for x in asked], np.int64))), found.ids)
                yield {"block": [block] * len(first), "id": [i for i, _ in first.values()], "start": [a for _, a in first.values()], "chunk": list(first)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for rows, (_, asked, before) in block_rows(batch):
                found = of(rows)
                gone: list[set[int]] = [set() for _ in found.lines]
                if asked:
                    every = list(found.chunks(np.array([x["pair"] for x in asked], np.int64)))
                    first = _firsts(every, found.ids)
                    elsewhere = {(x["id"], x["start"]) for x in before or ()}
                    for d, a, chunk in every:
                        if (found.ids[d], a) > first[chunk] or first[chunk] in elsewhere:
                            gone[d].update(range(a, a + lines))
                kept = [t if not g else b"\n".join(y for k, y in enumerate(x) if k not in g).decode("utf-8", "surrogatepass") for t, x, g in zip(rows.field(text_at).to_pylist(), found.lines, gone, strict=True)]
                yield {c: rows.field(i) for i, c in enumerate(given)} | {"n_lines": [len(x or ()) for x in found.lines], "n_removed": [len(g) for g in gone], "clean_text": kept}

    pairs = checkpoint(map_batches(blocks.select("rows", "block"), ask, "block bigint, pair bigint, twice boolean"))
    repeated = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.bool_or("twice").alias("twice")).where("n > 1 OR twice").select("pair")
    asked = checkpoint(pairs.join(repeated, "pair", "left_semi").select("block", "pair"))
    sent = checkpoint(map_batches(with_lists(blocks, asked=asked), send, "block bigint, id bigint, start bigint, chunk binary"))
    first = sent.groupBy("chunk").agg(F.min(F.struct("id", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    before = checkpoint(sent.join(first, "chunk").where(F.col("first") < F.struct("id", "start")).select("block", "id", "start"))
    shape = docs.select("*", F.lit(None).cast("bigint").alias("n_lines"), F.lit(None).cast("bigint").alias("n_removed"), F.lit(None).cast("string").alias("clean_text")).schema
    return map_batches(with_lists(blocks, asked=asked, before=before), cut, shape)
