"""Substring dedup by recompression.

Rounds rename a document's words: first maximal runs of one word, then pairs whose first symbol
is dealt left and whose second is dealt right. A symbol's name is a hash of its content, so all
tasks give equal content equal names, and whether two symbols join depends on their own names
alone. Every symbol also carries the interval of words that its parse depends on: wherever these
words stand, the same symbol stands in them.

So a window that holds the interval of a symbol which only its own document has cannot stand in
another document. Spark counts the symbols of all documents; the windows left over, nearly all
of them true repeats, are verified by 96-bit digests of their words' bytes and learn whether
a smaller document has them. Words under such a window are removed.

Documents are gathered in blocks, which are written once as a table bucketed by block, so the
three passes over the text move no text. Tasks exchange sorted digests per block and bucket and
get bits back. A word, line or passage that all documents share counts once a block.

Defined cases: a null text has no words. Documents shorter than a window lose nothing. Rows with
the same id don't make each other lose anything; a null id counts as larger than all others.
An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint, new_folder
from .arrow import map_batches, pieces

#: Bytes of text in a block, one document at least.
BLOCK_BYTES = 4_000_000
#: Bytes of text for which there is one bucket of digests.
BUCKET_BYTES = 24_000_000
#: Rounds of pairs. A symbol then depends on about ten words; more rounds make fewer symbols and more windows to verify.
LEVELS = 3

FAR = np.int64(1) << 40
NO_ID = np.iinfo(np.int64).max
BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
PRIME = 0x9E3779B97F4A7C15 | 1
LETTERS = np.random.default_rng(20240229).integers(1, 2**64, 256, np.uint64)


def hash_mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of PRIME and of its inverse modulo 2**64."""
    out = []
    for base in (PRIME, pow(PRIME, -1, 2**64)):
        p = np.full(n + 1, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Words:
    """The words of a block's texts: their bytes in ``data`` and where they start and stop, and their document."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        self.data = (np.frombuffer(raw, np.uint8) if raw else np.empty(0, np.uint8))[at[0] : at[-1]]
        at = at - at[0]
        inside = ~BLANK[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edge = at[(at > 0) & (at < len(self.data))]
        first[edge], last[edge - 1] = inside[edge], inside[edge - 1]
        self.start, self.stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.doc = np.searchsorted(at, self.start, "right") - 1
        self.n_docs, self.inside = len(texts), inside

    def __len__(self) -> int:
        return len(self.start)

    def names(self) -> np.ndarray:
        """A hash of each word."""
        up, down = powers(len(self.data))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(LETTERS[self.data] * up[:-1])))
        return hash_mix((sums[self.stop] - sums[self.start]) * down[self.start] + (self.stop - self.start).astype(np.uint64))

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words, each with a space behind it, and where they start and stop in that."""
        size = self.stop - self.start
        stop = np.cumsum(size + 1) - 1
        out = np.full(int(size.sum()) + len(size), 32, np.uint8)
        out[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = self.data[self.inside]
        return out, stop - size, stop


def parse(names: np.ndarray, doc: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after a round of runs and ``levels`` rounds of pairs: name, document, and the words [low, high) its parse depends on.

    What depends on a document's edge has an interval no window can hold.
    """
    n = len(names)
    if not n:
        return names, doc, doc, doc
    fresh = np.ones(n, bool)
    fresh[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(fresh)
    count = np.diff(np.append(start, n))
    name, d = names[start], doc[start]
    name = np.where(count > 1, hash_mix(name + count.astype(np.uint64) * np.uint64(PRIME)), name)
    other = np.ones(len(d) + 1, bool)
    other[1:-1] = d[1:] != d[:-1]
    low = np.where(other[:-1], -FAR, start - 1)
    high = np.where(other[1:], FAR, start + count + 1)
    for level in range(1, levels + 1):
        left = (hash_mix(name ^ np.uint64(level * 0xD1B54A32D192ED03 % 2**64)) >> np.uint64(17)) & np.uint64(1) == 1
        other = np.ones(len(d) + 1, bool)
        other[1:-1] = d[1:] != d[:-1]
        pair = np.zeros(len(name) + 1, bool)  # the symbol before and this one join
        pair[1:-1] = left[:-1] & ~left[1:] & ~other[1:-1]
        heads = pair[1:]
        after = np.append(high[1:], FAR)
        before = np.insert(low[:-1], 0, -FAR)
        high = np.where(left, np.where(other[1:], FAR, np.maximum(high, after)), high)
        low = np.where(~left & ~pair[:-1], np.where(other[:-1], -FAR, np.minimum(low, before)), low)
        behind = np.append(name[1:], np.uint64(0))
        name = np.where(heads, hash_mix(name * np.uint64(PRIME) + behind + np.uint64(level)), name)
        keep = ~pair[:-1]
        name, d, low, high = name[keep], d[keep], low[keep], high[keep]
    return name, d, low, high


class Block:
    """One block's words, symbols and windows."""

    def __init__(self, texts: pa.Array, ids: pa.Array, window: int):
        self.words, self.window = Words(texts), window
        self.ids = pc.fill_null(ids, NO_ID).to_numpy(zero_copy_only=False)
        self.name, doc, self.low, self.high = parse(self.words.names(), self.words.doc)
        held = np.flatnonzero(self.high - self.low <= window)
        self.order = held[np.argsort(self.name[held], kind="stable")]
        sorted_names = self.name[self.order]
        self.group = np.cumsum(np.concatenate((np.zeros(1, np.int64), sorted_names[1:] != sorted_names[:-1])))[: len(sorted_names)]
        first = np.flatnonzero(np.diff(self.group, prepend=-1))
        self.unique = sorted_names[first]
        d = doc[self.order]
        self.several = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first) if len(first) else np.empty(0, bool)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """First words of the windows that hold no symbol of their document alone."""
        n, w = len(self.words), self.window
        if n < w:
            return np.empty(0, np.int64)
        alone = self.order[~(shared | self.several)[self.group]]
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, np.maximum(self.high[alone] - w, 0), 1)
        np.add.at(change, self.low[alone] + 1, -1)
        doc = self.words.doc
        return np.flatnonzero((np.cumsum(change)[: n - w + 1] <= 0) & (doc[: n - w + 1] == doc[w - 1 :]))

    def digests(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows as (64 bits, 32 bits, smallest id here), ordered, and which of them each start has."""
        text, a, b = self.words.joined()
        view, digest = text.tobytes(), xxhash.xxh3_128_digest
        both = b"".join([digest(view[i:j]) for i, j in zip(a[starts].tolist(), b[starts + self.window - 1].tolist(), strict=True)])
        halves = np.array(np.ndarray(len(both) // 8, ">u8", both) if both else [], np.uint64).reshape(-1, 2)
        one, two = halves[:, 0], halves[:, 1].astype(np.uint32)
        order = np.lexsort((two, one))
        s, t = one[order], two[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
        first = np.flatnonzero(new)
        low = np.minimum.reduceat(self.ids[self.words.doc[starts[order]]], first) if len(first) else np.empty(0, np.int64)
        of = np.empty(len(s), np.int64)
        of[order] = np.cumsum(new) - 1
        return s[first], t[first], low, of


def _slices(sorted_keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The stretch of sorted 64-bit keys in each bucket that has some."""
    bucket = ((sorted_keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    edge = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(edge, np.append(edge, len(bucket))[1:], strict=True):
        yield int(bucket[a]), slice(a, b)


def _bits(found: list[dict] | None, n: int) -> np.ndarray:
    """The bits of all buckets in order, as sent by ``_slices``."""
    parts = [np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=x["n"]) for x in sorted(found or (), key=lambda x: x["bucket"])]
    out = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
    if len(out) != n:
        raise ValueError(f"{len(out)} bits for {n} digests")
    return out


def gather_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Documents in blocks: ``block, ids, texts, size``, as a table bucketed by block in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            for b in pieces(batch, "text", block_bytes):
                one = pa.array([0, b.num_rows], pa.int32())
                size = pc.sum(pc.fill_null(pc.binary_length(b.column(1)), 0)).as_py()
                yield {"block": [n], "ids": pa.ListArray.from_arrays(one, b.column(0)), "texts": pa.ListArray.from_arrays(one, b.column(1)), "size": [size]}
                n += 1

    spark = docs.sparkSession
    rows = map_batches(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")), run, "block bigint, ids array<bigint>, texts array<string>, size bigint")
    folder = new_folder(spark, "blocks")
    name = f"blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, "block").option("path", folder).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def _answer(asked: DataFrame, reply) -> DataFrame:
    """Bits for what the blocks have sent to the buckets, a checkpoint."""

    def run(t: pa.Table) -> pa.Table:
        lengths, bits = reply(t)
        edges = np.cumsum(lengths) - lengths
        out = [np.packbits(bits[a : a + n]).tobytes() for a, n in zip(edges, lengths, strict=True)]
        return pa.table({"block": t["block"], "bucket": t["bucket"], "n": pa.array(lengths, pa.int32()), "bits": pa.array(out, pa.binary())})

    return checkpoint(asked.groupBy("bucket").applyInArrow(run, "block bigint, bucket bigint, n int, bits binary"))


def _numbers(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def _shared(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Names that two blocks have."""
    each = _numbers(t["names"], np.uint64)
    keys = np.concatenate(each)
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    out = np.empty(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return np.array([len(x) for x in each]), out


def _earlier(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Windows that another block has in a smaller document."""
    each = _numbers(t["one"], np.uint64)
    one, two, low = np.concatenate(each), np.concatenate(_numbers(t["two"], np.uint32)), np.concatenate(_numbers(t["low"], np.int64))
    order = np.lexsort((two, one))
    s, u = one[order], two[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (u[1:] != u[:-1])
    least = np.minimum.reduceat(low[order], np.flatnonzero(new))
    out = np.empty(len(s), bool)
    out[order] = least[np.cumsum(new) - 1] < low[order]
    return np.array([len(x) for x in each]), out


def _with_bits(blocks: DataFrame, **tables: DataFrame) -> DataFrame:
    for name, t in tables.items():
        blocks = blocks.join(t.groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "bits")).alias(name)), "block", "left")
    return blocks.select("ids", "texts", "block", *tables)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``id, n_words, n_removed, kept`` of every row; ``kept`` has the kept words with one space between.

    Removed are the words of every window of ``window`` words that also starts in a document
    with a smaller id.
    """
    blocks = gather_blocks(docs, id_col, text_col, block_bytes)
    buckets = max(1, -(-(blocks.agg(F.sum("size")).first()[0] or 0) // bucket_bytes))

    def ask_names(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for ids, texts, block in zip(*(b.column(i) for i in range(3)), strict=True):
                found = Block(texts.values, ids.values, window)
                sent = list(_slices(found.unique, buckets))
                yield {"block": [block.as_py()] * len(sent), "bucket": [k for k, _ in sent], "names": [found.unique[s].tobytes() for _, s in sent]}

    def ask_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for ids, texts, block, shared in zip(*(b.column(i) for i in range(4)), strict=True):
                found = Block(texts.values, ids.values, window)
                one, two, low, _ = found.digests(found.candidates(_bits(shared.as_py(), len(found.unique))))
                sent = list(_slices(one, buckets))
                yield {"block": [block.as_py()] * len(sent), "bucket": [k for k, _ in sent]} | {
                    name: [x[s].tobytes() for _, s in sent] for name, x in (("one", one), ("two", two), ("low", low))}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for ids, texts, _, shared, earlier in zip(*(b.column(i) for i in range(5)), strict=True):
                found = Block(texts.values, ids.values, window)
                starts = found.candidates(_bits(shared.as_py(), len(found.unique)))
                one, _, low, of = found.digests(starts)
                starts = starts[(found.ids[found.words.doc[starts]] > low[of]) | _bits(earlier.as_py(), len(one))[of]]
                yield {"id": ids.values} | _kept(found.words, starts, window)

    shared = _answer(map_batches(blocks.select("ids", "texts", "block"), ask_names, "block bigint, bucket bigint, names binary"), _shared)
    windows = map_batches(_with_bits(blocks, shared=shared), ask_windows, "block bigint, bucket bigint, one binary, two binary, low binary")
    earlier = _answer(windows, _earlier)
    return map_batches(_with_bits(blocks, shared=shared, earlier=earlier), cut, "id bigint, n_words bigint, n_removed bigint, kept string")


def _kept(words: Words, starts: np.ndarray, window: int) -> dict:
    change = np.zeros(len(words) + 1, np.int64)
    change[starts] += 1
    change[starts + window] -= 1
    keep = np.cumsum(change)[:-1] == 0
    text, a, b = words.joined()
    text = text[np.repeat(keep, b - a + 1)]
    size = np.bincount(words.doc, (b - a + 1) * keep, words.n_docs).astype(np.int64)
    stop = np.cumsum(size)
    n = np.bincount(words.doc, minlength=words.n_docs)
    left = np.bincount(words.doc, keep, words.n_docs).astype(np.int64)
    return {"n_words": n, "n_removed": n - left, "kept": [text[e - k : max(e - 1, e - k)].tobytes().decode("utf-8", "surrogatepass") for e, k in zip(stop.tolist(), size.tolist(), strict=True)]}
