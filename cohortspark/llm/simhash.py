"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint takes each bit by majority over the hashes of a text's word shingles. Equal
fingerprints fall together first. Distinct ones meet in tables keyed by some of their bits: with
``blocks`` blocks of bits and at most ``radius`` differences, ``blocks - radius`` blocks agree in
full, so tables keyed by every such choice lose no link (``block_keys``). Wider fingerprints
meet by bands of bits (``band_keys``), which find a pair with a chance that grows with its similarity. Texts that are to share
most of their shingles meet by bands of minimum hashes of their shingle sets instead (``band_hashes``): two sets of
similarity s meet with the chance 1 - (1 - s ** rows) ** bands, which hardly any unlike pair
does, so that the work grows with the texts and their links alone.

Within a table rows are sorted by key and stored as bit planes, one plane a bit position, one
lane a row. A shift by s lanes compares every row with its s-th follower at once: differing
planes go through carry-save adders into vertical counters, and words whose lanes all exceed the
radius, or belong to different keys or hang together already, leave the comparison. Only links that join two parts of a
bucket are kept, so a bucket gives fewer links than rows. Buckets beyond ``BUCKET`` rows are dealt
into parts that are compared pair by pair, so no task holds an unbounded bucket.

``similar_documents`` takes such links only to form groups of candidates (the rows of a bucket too large for one place are one
group anyway). Within a group all shingle sets meet: shingles that two sets have are columns of a 0/1 matrix, whose product
with itself counts what any two have in common, so the exact Jaccard similarity of all pairs comes from one product, and
what leaves is the components alone. A group beyond ``SIDE`` sets is cut into parts that share some rows, and only what
hangs on none of them is then held against the rest, part by part; so its size costs once, and no link is lost.

Defined cases: a null text counts as empty; a text without words has the fingerprint zero, which
links like any other. Repeated rows share a fingerprint. A component's id is its smallest
document id; null ids are passed over, and a component of null ids alone has the id null. Very long texts are hashed
and counted some shingles at a time. An empty table gives an empty result; columns beside id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.morphology import connected, joined
from ..session import checkpoint
from .arrow import map_batches
from .bitmap import maybe_in

#: Rows of one bucket that are compared in one place.
BUCKET = 4096
#: Rows that are turned into bit planes together.
LANES = 1 << 15
#: Classes of a candidate group, and shingles, that are held in one place; shingles of a matrix.
SIDE, HELD, COLUMNS = 512, 1 << 22, 1 << 13
#: Elements of a group's sets that are brought together at a time.
MET = 1 << 18
#: Shingle hashes whose bits are counted, and that are hashed for minima, at a time.
COUNTED, HASHED = 1 << 16, 1 << 12
#: Bands of minimum hashes and rows of a band: pairs of similarity 0.8 meet with a chance of 0.9993.
BANDS, ROWS = 24, 6


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 with seed 42 of every shingle, repeats included; of the whole sequence if it is shorter."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined, hashed = b" ".join(found), xxhash.xxh64_intdigest
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in found)]
    n = max(1, len(found) - words + 1)
    starts = [0, *(e + 1 for e in ends)]
    return np.fromiter((hashed(joined[a:b], 42) for a, b in zip(starts[:n], ends[min(words, len(found)) - 1 :], strict=False)), np.uint64, n)


def _spread(h: np.ndarray, k: int) -> np.ndarray:
    """Further hashes from one; the 0th is itself."""
    if k == 0:
        return h
    h = h + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(hashes: np.ndarray, width: int = 1) -> list[int]:
    """``width`` words of 64 bits, signed; a bit is 1 if set in over half of the hashes."""
    out = []
    for k in range(width):
        count = np.zeros(64, np.int64)
        for i in range(0, len(hashes), COUNTED):
            h = _spread(hashes[i : i + COUNTED], k)
            count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits((2 * count > len(hashes)).astype(np.uint8), bitorder="little").view(np.int64)[0]))
    return out


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, width: int = 1) -> DataFrame:
    """``doc`` and the fingerprint's words as ``fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            yield {"doc": b.column(0), "fp": [fingerprint(shingle_hashes(t, words), width) for t in b.column(1).to_pylist()]}

    return map_batches(docs.select(F.col(id_col).cast("bigint"), F.col(text_col)), run, "doc bigint, fp array<bigint>")


def block_keys(radius: int, blocks: int) -> list[list[tuple[int, int, int]]]:
    """Tables for one-word fingerprints as lists of (word, first bit, bits); they lose no pair within ``radius``."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    return [[(0, cuts[i], cuts[i + 1] - cuts[i]) for i in chosen] for chosen in combinations(range(blocks), blocks - radius)]


def band_keys(width: int, bits: int = 12, strides: tuple[int, ...] = (1, 5)) -> list[list[tuple[int, int, int]]]:
    """Tables for wide fingerprints, of ``bits`` bits in 4-bit pieces that are dealt anew for every (odd) stride.

    Two texts whose fingerprints differ in a share d of the bits meet with the chance
    1 - (1 - (1 - d) ** bits) ** tables. Larger corpora want more bits, so that buckets stay
    short, and more strides to make up for them.
    """
    n, k = 16 * width, bits // 4
    pieces = [[i * stride % n for i in range(at, at + k)] for stride in strides for at in range(0, n - k + 1, k)]
    return [[(p // 16, p % 16 * 4, 4) for p in table] for table in pieces]


def band_hashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key a band: the minima of ``rows`` hashes of the set, hashed; none of an empty set."""
    if not len(shingles):
        return np.empty(0, np.uint64)
    n = bands * rows
    odd = _spread(np.arange(1, n + 1, dtype=np.uint64), 1) | np.uint64(1)
    low = np.full(n, np.uint64(2**64 - 1))
    for i in range(0, len(shingles), HASHED):
        some = shingles[i : i + HASHED]
        low = np.minimum(low, ((some ^ (some >> np.uint64(29)))[:, None] * odd[None, :]).min(0))
    key = np.arange(bands, dtype=np.uint64)
    for column in low.reshape(bands, rows).T:
        key = _spread(key * np.uint64(0x9E3779B97F4A7C15) ^ column, 1)
    return key


def _key(fp: Column, table: int, parts: list[tuple[int, int, int]]) -> Column:
    key = F.lit(table).cast("bigint")
    for word, first, bits in parts:
        piece = F.shiftrightunsigned(fp[word], first).bitwiseAND(F.lit((1 << bits) - 1))
        key = F.shiftleft(key, bits).bitwiseOR(piece)
    return key


def _csa(a, b, c):
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


class Planes:
    """Rows of fingerprints as bit planes; lane i of a plane is row i."""

    def __init__(self, fps: np.ndarray):
        n, width = fps.shape
        padded = np.zeros((-(-n // 64) * 64, width), np.uint64)
        padded[:n] = fps
        bits = np.unpackbits(padded.view(np.uint8).reshape(len(padded), 8 * width), axis=1, bitorder="little")
        self.planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)

    def close(self, shift: int, lanes: np.ndarray, radius: int) -> np.ndarray:
        """Rows i, of those marked in ``lanes``, that differ from row i + shift in at most ``radius`` bits."""
        planes, (q, r) = self.planes, divmod(shift, 64)
        bits = np.zeros(planes.shape[1] * 64, np.uint8)
        bits[: len(lanes)] = lanes
        mask = np.packbits(bits, bitorder="little").view(np.uint64)
        live = np.flatnonzero(mask)
        mask, most = mask[live], planes.shape[1] - 1
        near, far = np.minimum(live + q, most), np.minimum(live + q + 1, most)
        high = max(3, radius.bit_length())
        counters = [np.zeros(len(live), np.uint64) for _ in range(high)]
        over = np.zeros(len(live), np.uint64)
        for p in range(0, len(planes), 8):
            group = planes[p : p + 8]
            other = group[:, near]
            if r:
                other = (other >> np.uint64(r)) | (group[:, far] << np.uint64(64 - r))
            d = group[:, live] ^ other
            ones, a = _csa(counters[0], d[0], d[1])
            ones, b = _csa(ones, d[2], d[3])
            twos, e = _csa(counters[1], a, b)
            ones, a = _csa(ones, d[4], d[5])
            ones, b = _csa(ones, d[6], d[7])
            twos, f = _csa(twos, a, b)
            fours, carry = _csa(counters[2], e, f)
            counters[:3] = ones, twos, fours
            for i in range(3, high):
                counters[i], carry = counters[i] ^ carry, counters[i] & carry
            over |= carry
            more, equal = over.copy(), ~np.zeros(len(live), np.uint64)
            for i in range(high - 1, -1, -1):
                if radius >> i & 1:
                    equal &= counters[i]
                else:
                    more |= equal & counters[i]
                    equal &= ~counters[i]
            mask &= ~more
            stay = mask != 0
            if not stay.any():
                return np.empty(0, np.int64)
            if 4 * stay.sum() < 3 * len(stay):  # blocks of lanes all beyond the radius are given up
                live, near, far, mask, over = live[stay], near[stay], far[stay], mask[stay], over[stay]
                counters = [c[stay] for c in counters]
        lane = np.unpackbits(mask.view(np.uint8), bitorder="little").nonzero()[0]
        return live[lane >> 6] * 64 + (lane & 63)


def bucket_links(sizes: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between rows of the same bucket, a spanning forest of each; buckets lie one after another."""
    links: list[tuple[int, int]] = []
    starts = np.cumsum(sizes) - sizes
    bound = 2
    while (some := sizes[sizes >= bound]).size:  # buckets of like size together, so a shift finds few lanes idle
        chosen = np.flatnonzero((sizes >= bound) & (sizes < 4 * bound))
        bound *= 4
        if not chosen.size:
            continue
        some = sizes[chosen]
        inner = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        rows = np.repeat(starts[chosen], some) + inner
        left = np.repeat(some, some) - inner
        planes, root = Planes(fps[rows]), np.arange(len(rows))
        place, parts = np.arange(len(rows)), len(rows)
        for shift in range(1, int(some.max())):
            if parts == len(some):  # every bucket hangs together
                break
            apart = (left > shift) & (root != root[np.minimum(place + shift, len(rows) - 1)])
            a = planes.close(shift, apart, radius) if apart.any() else []
            if not len(a):
                continue
            for x in a.tolist():
                u, v = x, x + shift
                while root[u] != u:
                    u = root[u]
                while root[v] != v:
                    v = root[v]
                if u != v:
                    root[max(u, v)] = min(u, v)
                    links.append((int(rows[x]), int(rows[x + shift])))
                    parts -= 1
            while (root[root] != root).any():
                root = root[root]
    return links


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[dict]:
    """Rows come sorted by bucket; a bucket may run on into the next batch."""

    def settle(keys: np.ndarray, nodes: np.ndarray, fps: np.ndarray) -> Iterator[dict]:
        edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        found = np.array(bucket_links(np.diff(np.append(edge, len(keys))), fps, radius), np.int64).reshape(-1, 2)
        yield {"u": nodes[found[:, 0]], "v": nodes[found[:, 1]]}

    rest = None
    for b in batches:
        if not b.num_rows:
            continue
        rows = [b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).flatten().to_numpy().view(np.uint64).reshape(b.num_rows, -1)]
        rows = rows if rest is None else [np.concatenate(x) for x in zip(rest, rows, strict=True)]
        keys = rows[0]
        last = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
        edge = np.append(np.flatnonzero(np.concatenate((np.ones(min(last, 1), bool), keys[1:last] != keys[: max(last - 1, 0)]))), last)
        at = 0
        while at < last:
            stop = int(edge[max(np.searchsorted(edge, at + LANES, "right") - 1, np.searchsorted(edge, at) + 1)])
            yield from settle(*(x[at:stop] for x in rows))
            at = stop
        rest = [x[last:].copy() for x in rows]
    if rest is not None:
        yield from settle(*rest)


def _dealt(rows: DataFrame, radius: int) -> DataFrame:
    """Links of rows ``deal, node, fp``."""
    spread = rows.repartition("deal").sortWithinPartitions("deal", "node")
    return map_batches(spread, lambda b: _compare(b, radius), "u bigint, v bigint").distinct()


def links(classes: DataFrame, tables: list[list[tuple[int, int, int]]], radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links ``u, v`` between classes (``node, fp``) within ``radius`` that share a table's key; enough to join what is joined."""
    keys = F.array(*(_key(F.col("fp"), i, t) for i, t in enumerate(tables)))
    rows = classes.select("node", "fp", F.explode(keys).alias("key"))
    large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket)
    marked = rows.join(large, "key", "left")
    parts = F.ceil(F.col("n") / bucket).cast("int")
    mine = F.pmod(F.xxhash64("node"), parts).cast("int")
    pairs = F.when(F.col("n").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(
        F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.least(mine, j).cast("bigint") * 1_000_000 + F.greatest(mine, j)))
    dealt = marked.select("key", F.explode(pairs).alias("pair"), "node", "fp")
    # Two buckets of one hash are compared as one, which only adds true links.
    return _dealt(dealt.select(F.xxhash64("key", "pair").alias("deal"), "node", "fp"), radius)


def shared_keys(classes: DataFrame) -> DataFrame:
    """``key, node, n``: the keys (of ``node, keys``) that ``n`` nodes have, two at least."""
    rows = classes.select("node", F.explode("keys").alias("key"))
    return rows.join(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "key").select("key", "node", "n")


def candidate_links(shared: DataFrame, classes: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links ``u, v`` of nodes that share a key: a spanning forest of what is within ``radius``; in a large bucket all to its first node."""
    small = shared.where(F.col("n") <= bucket).select("key", "node").join(classes.select("node", "fp"), "node")
    near = _dealt(small.select(F.col("key").alias("deal"), "node", "fp"), radius)
    large = shared.where(F.col("n") > bucket)
    star = large.join(large.groupBy("key").agg(F.min("node").alias("u")), "key").select("u", F.col("node").alias("v"))
    return near.unionByName(star).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 4, width: int = 1, radius: int = 4,
                    tables: list[list[tuple[int, int, int]]] | None = None, bucket: int = BUCKET) -> DataFrame:
    """``doc``, ``fp`` and ``component`` (the smallest document id reachable by links) of every row.

    ``tables`` says where fingerprints meet; by default where no link within ``radius`` is lost.
    """
    if tables is None:
        if width != 1:
            raise ValueError("name the tables of wide fingerprints")
        tables = block_keys(radius, radius + 2)
    marked = checkpoint(fingerprints(docs, id_col=id_col, text_col=text_col, words=words, width=width))
    classes = checkpoint(marked.groupBy("fp").agg(F.min("doc").alias("low")).select(F.monotonically_increasing_id().alias("node"), "fp", "low"))
    roots = connected(links(classes.select("node", "fp"), tables, radius, bucket), ())
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = rooted.groupBy("root").agg(F.min("low").alias("component"))
    named = rooted.join(low, "root").select("fp", "component")
    return marked.join(named, "fp").select("doc", "fp", "component")


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes, sorted."""
    return np.unique(shingle_hashes(text, words))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes(), usedforsecurity=False).digest()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of sets as sorted arrays; empty sets are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def common(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements any two of the (sorted) sets share; ranges of elements are looked at one after another."""
    out, lengths = np.zeros((len(sets), len(sets)), np.float32), [len(x) for x in sets]
    lots = max(1, sum(lengths) // MET)
    edges = np.array([2**64 * k // lots for k in range(1, lots)], np.uint64)
    cuts = [[0, *np.searchsorted(x, edges).tolist(), len(x)] for x in sets]
    for k in range(lots):
        _add_common(out, [x[c[k] : c[k + 1]] for x, c in zip(sets, cuts, strict=True)])
    np.fill_diagonal(out, lengths)
    return out


def _add_common(out: np.ndarray, sets: list[np.ndarray]) -> None:
    n, lengths = len(sets), [len(x) for x in sets]
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times > 1
    place = np.cumsum(often) - 1
    row, kept = np.repeat(np.arange(n), lengths), often[column]
    row, column = row[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(often.sum()), COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        x = np.zeros((n, min(COLUMNS, int(often.sum()) - first)), np.float32)
        x[row[a:b], column[a:b] - first] = 1
        out += x @ x.T


def alike(sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with a Jaccard similarity of ``least`` or more."""
    both = common(sets).astype(np.float64)
    size = np.diag(both)
    u, v = np.nonzero(np.triu(both >= least * (size[:, None] + size[None, :] - both) - 1e-6, 1))
    return u, v


def _compare_sets(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[dict]:
    """Rows ``deal, whole, node, root, shingles`` sorted by deal to links ``u, v`` that join its nodes to the smallest they hang on."""

    def settle(rows: list[tuple]) -> dict:
        nodes = np.array([r[2] for r in rows], np.int64)
        roots = np.array([r[2] if r[3] is None else r[3] for r in rows], np.int64)
        u, v = alike([np.frombuffer(r[4], np.uint64) for r in rows], least)
        _, part = np.unique(roots, return_inverse=True)  # what hangs together already is one
        low = joined(int(part.max()) + 1, part[u], part[v])
        first = np.full(len(low), np.iinfo(np.int64).max)
        np.minimum.at(first, part, roots)
        top = first[low]
        moved = np.flatnonzero(top != first)
        return {"u": top[moved], "v": first[moved], "whole": [rows[0][1]] * len(moved)}

    held: list[tuple] = []
    for b in batches:
        for i in range(b.num_rows):  # a row at a time: a batch of sets is large
            row = tuple(c[i].as_py() for c in b.columns)
            if held and row[0] != held[0][0]:
                if len(held) > 1:
                    yield settle(held)
                held = []
            held.append(row)
    if len(held) > 1:
        yield settle(held)


def _joined_sets(dealt: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links of the nodes in each deal (``deal, whole, node, root``)."""
    rows = dealt.join(sets, "node").select("deal", "whole", "node", "root", "shingles").repartition("deal").sortWithinPartitions("deal", "node")
    return checkpoint(map_batches(rows, lambda b: _compare_sets(b, least), "u bigint, v bigint, whole boolean"))


def _first_parts(placed: DataFrame, pivots: int) -> DataFrame:
    """Each node in its part, and a large group's first nodes in every part."""
    own = placed.select("group", "node", "parts", F.pmod(F.xxhash64("node"), F.col("parts")).alias("part"))
    first = placed.where("parts > 1").withColumn("at", F.row_number().over(W.partitionBy("group").orderBy("node"))).where(F.col("at") <= pivots)
    more = first.select("group", "node", "parts", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    every = own.unionByName(more).distinct()
    return every.select(F.xxhash64("group", "part").alias("deal"), (F.col("parts") == 1).alias("whole"), "node", F.lit(None).cast("bigint").alias("root"))


def _parts_apart(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """Large groups that do not hang together: what is not of a group's most frequent root is held against all, part by part."""
    now = placed.where("parts > 1").join(roots, "node", "left").select("group", "node", "n", "parts", F.coalesce("root", "node").alias("root"))
    per = now.groupBy("group", "root").agg(F.count(F.lit(1)).alias("m")).groupBy("group").agg(F.count(F.lit(1)).alias("roots"), F.max_by("root", F.struct("m", "root")).alias("main"), F.max("m").alias("most"))
    mixed = now.join(per.where("roots > 1"), "group")
    # Two parts meet, so each has half the size.
    share = lambda m: F.ceil(2 * F.col("parts") * m / F.col("n")).cast("int")
    many, few = share(F.col("most")), share(F.col("n") - F.col("most"))
    main = F.col("root") == F.col("main")
    mine = F.pmod(F.xxhash64("node"), F.when(main, many).otherwise(few)).cast("int")
    met = F.when(main, F.transform(F.sequence(F.lit(0), few - 1), lambda j: F.struct(mine.alias("a"), j.alias("b")))).otherwise(F.concat(
        F.transform(F.sequence(F.lit(0), many - 1), lambda j: F.struct(j.alias("a"), mine.alias("b"))),
        F.transform(F.sequence(F.lit(0), few - 1), lambda j: F.struct((-1 - F.least(mine, j)).alias("a"), F.greatest(mine, j).alias("b")))))
    return mixed.select("group", "node", "root", F.explode(met).alias("met")).select(F.xxhash64("group", "met").alias("deal"), F.lit(False).alias("whole"), "node", "root")


def similar_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, width: int = 4, radius: int = 55, least: float = 0.8,
                      bands: int = BANDS, rows: int = ROWS, bucket: int = BUCKET, side: int = SIDE) -> DataFrame:
    """``doc``, ``text_hash`` (xxhash64) and ``component`` of every row, by links of a Jaccard similarity of ``least`` or more.

    ``component`` is the smallest document id reachable by such links. Candidates are the pairs whose fingerprints are within
    ``radius`` and whose sets meet in a band; whatever hangs together by them is compared. Fingerprints and similarities are
    those of the distinct shingles.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("text_key", F.unhex(F.md5("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            found = [shingle_set(t, words) for t in b.column(1).to_pylist()]
            yield {"doc": b.column(0), "text_hash": b.column(2), "text_key": b.column(3), "digest": [_digest(x) for x in found], "fp": [fingerprint(x, width) for x in found],
                   "keys": [band_hashes(x, bands, rows).view(np.int64) for x in found], "size": [len(x) for x in found]}

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            yield {"node": b.column(0), "shingles": [shingle_set(t, words).tobytes() for t in b.column(1).to_pylist()]}

    marked = checkpoint(map_batches(texts.select("doc", "text", F.xxhash64("text").alias("text_hash"), "text_key"), run,
                                    "doc bigint, text_hash bigint, text_key binary, digest binary, fp array<bigint>, keys array<bigint>, size bigint"))
    low = marked.groupBy("digest").agg(F.min("doc").alias("low"), F.min("text_key").alias("text_key"), F.first("fp").alias("fp"), F.first("keys").alias("keys"), F.first("size").alias("size"))
    classes = checkpoint(low.select(F.monotonically_increasing_id().alias("node"), "digest", "low", "text_key", "fp", "keys", "size"))

    shared = checkpoint(shared_keys(classes.select("node", "keys")))
    groups = connected(candidate_links(shared, classes, radius, bucket), ())
    groups = groups.select("node", F.col("root").alias("group")).unionByName(groups.select(F.col("root").alias("node"), F.col("root").alias("group"))).distinct()
    placed = checkpoint(groups.join(classes.select("node", "text_key", "size"), "node"))
    sizes = placed.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.greatest(F.ceil(F.count(F.lit(1)) / side), F.ceil(F.sum("size") / HELD)).alias("parts"))
    placed = checkpoint(placed.join(sizes, "group").select("node", "group", "text_key", "n", "parts"))
    # One row a text, of the texts that have a candidate; a class is known by one of its texts.
    once = maybe_in(texts, F.col("text_key"), placed.select("text_key")).groupBy("text_key").agg(F.first("text").alias("text"))
    sets = checkpoint(map_batches(once.join(placed, "text_key").select("node", "text"), unfold, "node bigint, shingles binary"))

    links = _joined_sets(_first_parts(placed, max(1, side // 8)), sets, least)
    roots = links.where("whole").select(F.col("v").alias("node"), F.col("u").alias("root"))
    cut = links.where("NOT whole").select("u", "v")
    if not placed.where("parts > 1").isEmpty():
        large = checkpoint(connected(cut, ()))
        more = _joined_sets(_parts_apart(placed, large), sets, least).select("u", "v")
        if not more.isEmpty():  # links of roots
            above = connected(more.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), ()).select(F.col("node").alias("root"), F.col("root").alias("top"))
            every = large.unionByName(above.select(F.col("root").alias("node"), F.col("top").alias("root"))).join(above, "root", "left")
            large = every.select("node", F.coalesce("top", "root").alias("root")).distinct()
        roots = roots.unionByName(large.select("node", "root"))
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component")), "root").select("digest", "component")
    return marked.join(named, "digest").select("doc", "text_hash", "component")
