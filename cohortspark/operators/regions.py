"""Regions: naming, polygon area, rasterising, overlap, registration by shift and angle."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions.text import canonical_name
from ..session import checkpoint
from .morphology import mask_runs
from .skew import large_groups, rows_in_small_groups, together
from .summarise import attach

# Fixed values.
NAMES = {"tissue": "Tissue", "tisssue": "Tissue", "hippocampus": "Hippocampus", "isocortex": "Isocortex",
         "isocortes": "Isocortex", "cortex": "Isocortex"}
MIN_REGION_MM2 = 0.5
OUTLINE_MM2 = 10.0
#: Pixels of a pair of masks that is registered together with others, and cells of their transforms at a time.
PIXELS, CELLS = 1 << 16, 1 << 19
#: What the registration finds of a pair at an angle: the shift, pixels in common, pixels of both masks, and the Dice at rest.
FOUND = ("angle", "dy", "dx", "_k", "_nm", "_nf", "_rest")


def ring_area(ring: Column) -> Column:
    """Absolute shoelace area of a ring of ``[x, y]`` points (closed or not)."""
    nxt = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, nxt, lambda a, b: a[0] * b[1] - b[0] * a[1])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def poly_area(rings: Column) -> Column:
    """Outline minus holes."""
    holes = F.aggregate(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), F.lit(0.0), lambda s, r: s + ring_area(r))
    return ring_area(rings[0]) - holes


def resolve_regions(features: DataFrame, by: str, pixel_um: Column) -> DataFrame:
    """Canonical region of each polygon. An unnamed feature is the tissue outline only if
    both cortical regions are named, no tissue is, and it is the largest unnamed one and
    large enough. Unresolved features keep a NULL region."""
    f = features.withColumn("region", canonical_name(F.col("raw_name"), NAMES)).withColumn("area_mm2", poly_area(F.col("rings")) * pixel_um * pixel_um / 1e6)
    has = lambda n: F.coalesce(F.bool_or(F.col("region") == n), F.lit(False))
    size = f.where(F.col("region").isNull()).groupBy(by, "feature_no").agg(F.sum("area_mm2").alias("a"))
    big = size.groupBy(by).agg(F.max(F.struct(F.col("a"), -F.col("feature_no"))).alias("_m")).select(by, (-F.col("_m")["col2"]).alias("_no"), F.col("_m")["a"].alias("_a"))
    flags = f.groupBy(by).agg((has("Hippocampus") & has("Isocortex") & ~has("Tissue")).alias("_ok"))
    d = attach(attach(f, flags, [by]), big, [by])
    outline = F.col("_ok") & (F.col("feature_no") == F.col("_no")) & (F.col("_a") > OUTLINE_MM2)
    return d.withColumn("region", F.when(F.col("region").isNull() & F.coalesce(outline, F.lit(False)), "Tissue").otherwise(F.col("region"))).drop("_ok", "_no", "_a")


def region_areas(resolved: DataFrame, by: Sequence[str], min_mm2: float = MIN_REGION_MM2) -> DataFrame:
    """Area of same-named parts together, what overlaps once; degenerate regions carry a reason."""
    named = resolved.where(F.col("region").isNotNull())
    keys = [*by, "region"]
    g = named.groupBy(*keys).agg(F.sum("area_mm2").alias("_sum"), F.count(F.lit(1)).alias("n_parts"), F.max(F.try_divide("area_mm2", poly_area(F.col("rings")))).alias("_scale"))
    several = named.join(g.where("n_parts > 1").select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]), _equal(keys, "_g"), "left_semi")
    d = attach(g, union_area(several, keys), keys)
    d = d.select(*keys, F.coalesce(F.col("area") * F.col("_scale"), F.col("_sum")).alias("area_mm2"), "n_parts")
    return d.withColumn("reason", F.when(F.col("area_mm2") < min_mm2, "degenerate").otherwise(""))


def _equal(keys: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"{prefix}{i}"))
    return cond


def polygon_edges(polygons: DataFrame, by: Sequence[str], rings: str = "rings") -> DataFrame:
    """One row per edge of every ring; ``part`` tells the polygons apart."""
    r = polygons.select(*by, rings).withColumn("part", F.monotonically_increasing_id()).select(*by, "part", F.explode(rings).alias("r"))
    nxt = F.concat(F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0))), F.slice("r", 1, 1))
    e = r.select(*by, "part", F.explode(F.zip_with("r", nxt, lambda a, b: F.struct(a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by")))).alias("e"))
    return e.select(*by, "part", "e.ax", "e.ay", F.col("e.bx").alias("bx"), F.col("e.by").alias("by_"))


def _covered(crossings: DataFrame, line: Sequence[str], x: str, *more: str) -> DataFrame:
    """Stretches of each line inside at least one part, from ``x`` to ``_x`` (and the same of other columns).

    Each part's crossings, sorted, are its entries and exits in turn; the number of parts one is in is their running
    sum.
    """
    own = W.partitionBy(*line, "part").orderBy(x, *more)
    across = W.partitionBy(*line).orderBy(F.col(x), F.col("_turn").desc())
    d = crossings.withColumn("_turn", F.when(F.row_number().over(own) % 2 == 1, 1).otherwise(-1))
    d = d.withColumns({"_depth": F.sum("_turn").over(across.rowsBetween(W.unboundedPreceding, 0)), **{f"_{c}": F.lead(c).over(across) for c in (x, *more)}})
    return d.where((F.col("_depth") > 0) & F.col(f"_{x}").isNotNull()).drop("_turn", "_depth")


def union_area(polygons: DataFrame, by: Sequence[str], rings: str = "rings") -> DataFrame:
    """``by, area`` of the union of a group's polygons, exact, by a plane sweep.

    The heights of all corners and of all crossings of edges cut the plane into slabs, in which edges keep their order from
    left to right; what is covered there is a row of trapezoids. Edges meet only where their bands of heights do.
    """
    e = checkpoint(polygon_edges(polygons, by, rings).where(F.col("ay") != F.col("by_")))
    up = F.col("ay") < F.col("by_")
    e = e.select(*by, "part", *[F.when(up, a).otherwise(b).alias(n) for n, a, b in (("x0", F.col("ax"), F.col("bx")), ("y0", F.col("ay"), F.col("by_")), ("x1", F.col("bx"), F.col("ax")), ("y1", F.col("by_"), F.col("ay")))])
    slope = (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    e = e.withColumn("_slope", slope)
    # Bands as high as a group's edges on average, so that an edge lies in few.
    mean = e.groupBy(*by).agg(F.avg(F.col("y1") - F.col("y0")).alias("_band"))
    b = attach(e, mean, by).withColumn("_at", F.explode(F.sequence(F.floor(F.col("y0") / F.col("_band")), F.floor(F.col("y1") / F.col("_band"))))).drop("_band")
    o = b.select(*[F.col(c).alias(f"o_{c}") for c in b.columns])
    cond = F.col("_at") == F.col("o__at")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    ahead = F.struct("x0", "y0", "x1", "y1") < F.struct(*[F.col(f"o_{c}").alias(c) for c in ("x0", "y0", "x1", "y1")])
    y = F.try_divide(F.col("o_x0") - F.col("x0") + F.col("_slope") * F.col("y0") - F.col("o__slope") * F.col("o_y0"), F.col("_slope") - F.col("o__slope"))
    low, high = F.greatest("y0", "o_y0"), F.least("y1", "o_y1")
    met = b.join(o, cond & ahead & (low < high)).select(*by, y.alias("y"), low.alias("_l"), high.alias("_h")).where((F.col("y") > F.col("_l")) & (F.col("y") < F.col("_h")))
    heights = e.select(*by, F.explode(F.array("y0", "y1")).alias("y")).unionByName(met.select(*by, "y")).distinct()
    slabs = heights.withColumn("top", F.lead("y").over(W.partitionBy(*by).orderBy("y"))).where(F.col("top").isNotNull())
    s = slabs.select(*[F.col(c).alias(f"o_{c}") for c in by], "y", "top")
    inside = (F.col("y0") <= F.col("y")) & (F.col("top") <= F.col("y1"))
    for c in by:
        inside = inside & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    at = lambda h: F.col("x0") + F.col("_slope") * (h - F.col("y0"))
    spans = e.join(s, inside).select(*by, "part", "y", "top", at((F.col("y") + F.col("top")) / 2).alias("mid"), at(F.col("y")).alias("low"), at(F.col("top")).alias("high"))
    piece = (F.col("_low") - F.col("low") + F.col("_high") - F.col("high")) / 2 * (F.col("top") - F.col("y"))
    return _covered(spans, [*by, "y", "top"], "mid", "low", "high").groupBy(*by).agg(F.sum(piece).alias("area"))


def rasterise(polygons: DataFrame, by: Sequence[str]) -> DataFrame:
    """Pixel centres inside at least one of a group's polygons, as runs ``by, y, x0, x1``; each is filled even-odd, so holes stay.

    Each edge yields one crossing per raster row it spans. No pixel ever meets an edge that does not cross its row.
    """
    e = polygon_edges(polygons, by).where(F.col("ay") != F.col("by_"))
    lo, hi = F.least("ay", "by_"), F.greatest("ay", "by_")
    first, last = F.ceil(lo - 0.5).cast("int"), F.ceil(hi - 0.5).cast("int") - 1
    rows = e.withColumns({"_f": first, "_l": last}).where(F.col("_f") <= F.col("_l")).withColumn("y", F.explode(F.sequence("_f", "_l")))
    x = F.col("ax") + (F.col("y") + 0.5 - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by_") - F.col("ay"))
    c = _covered(rows.select(*by, "part", "y", x.alias("x")), [*by, "y"], "x")
    runs = c.select(*by, "y", F.ceil(F.col("x") - 0.5).cast("int").alias("x0"), (F.ceil(F.col("_x") - 0.5) - 1).cast("int").alias("x1")).where("x0 <= x1")
    # Stretches that follow each other without a gap are one run.
    w = W.partitionBy(*by, "y").orderBy("x0")
    fresh = runs.withColumn("_s", F.coalesce((F.lag("x1").over(w) + 1 < F.col("x0")).cast("int"), F.lit(1))).withColumn("_g", F.sum("_s").over(w))
    return fresh.groupBy(*by, "y", "_g").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("_g")


def intersect_mask(region: DataFrame, tissue: DataFrame, by: Sequence[str], pixel: Sequence[str] = ("x", "y")) -> DataFrame:
    """Region pixels inside the tissue; per region: drawn, kept, fraction and reason."""
    key = [c for c in by if c in tissue.columns]
    t = tissue.select(*key, *pixel).distinct().withColumn("_in", F.lit(1))
    d = region.select(*by, *pixel).join(t, [*key, *pixel], "left")
    g = d.groupBy(*by).agg(F.count(F.lit(1)).alias("drawn_px"), F.count("_in").alias("kept_px"))
    return g.withColumn("kept_frac", F.col("kept_px") / F.col("drawn_px")).withColumn("reason", F.when(F.col("kept_px") == 0, "does not meet the tissue mask").otherwise(""))


def dice(a: DataFrame, b: DataFrame, by: Sequence[str], keys: DataFrame | None = None, pixel: Sequence[str] = ("x", "y")) -> DataFrame:
    """2|A n B| / (|A| + |B|) per key. Keys of ``keys`` with both masks empty give 0."""
    both = a.select(*by, *pixel).withColumn("_a", F.lit(1)).join(b.select(*by, *pixel).withColumn("_b", F.lit(1)), [*by, *pixel], "full_outer")
    g = both.groupBy(*by).agg(F.count("_a").alias("n_a"), F.count("_b").alias("n_b"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_both"))
    g = g.withColumn("dice", 2 * F.col("n_both") / (F.col("n_a") + F.col("n_b")))
    if keys is None:
        return g
    return attach(keys.select(*by), g, by).fillna(0, subset=["n_a", "n_b", "n_both", "dice"])


def rotate(x: Column, y: Column, angle_deg: Column, cx: float, cy: float) -> tuple[Column, Column]:
    """Rotation about a centre."""
    t = F.radians(angle_deg)
    dx, dy = x - cx, y - cy
    return F.cos(t) * dx - F.sin(t) * dy + cx, F.sin(t) * dx + F.cos(t) * dy + cy


def turned(mask: np.ndarray, x0: int, y0: int, angle_deg: float, cx: float, cy: float) -> tuple[np.ndarray, int, int]:
    """A mask (its first pixel at ``x0, y0``) rotated about a centre, and where the result begins. More axes before the last two are more masks.

    Every pixel of the result looks up the one it comes from, so rotation tears no holes.
    """
    t = math.radians(angle_deg)
    c, s = math.cos(t), math.sin(t)
    h, w = mask.shape[-2:]
    corners = [(c * (x - cx) - s * (y - cy) + cx, s * (x - cx) + c * (y - cy) + cy) for x in (x0 - 1, x0 + w) for y in (y0 - 1, y0 + h)]
    left, top = (math.floor(min(v)) for v in zip(*corners, strict=True))
    right, bottom = (math.ceil(max(v)) for v in zip(*corners, strict=True))
    x, y = np.meshgrid(np.arange(left, right + 1), np.arange(top, bottom + 1))
    sx = np.floor(c * (x - cx) + s * (y - cy) + cx + 0.5).astype(np.int64) - x0
    sy = np.floor(c * (y - cy) - s * (x - cx) + cy + 0.5).astype(np.int64) - y0
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    out = np.zeros((*mask.shape[:-2], *x.shape), bool)
    out[..., inside] = mask[..., sy[inside], sx[inside]]
    return out, left, top


def overlaps(fixed: np.ndarray, moving: np.ndarray) -> np.ndarray:
    """Common pixels at every shift that lets the masks meet, by one correlation; row ``moving rows - 1`` is no shift down."""
    shape = [a + b - 1 for a, b in zip(fixed.shape[-2:], moving.shape[-2:], strict=True)]
    f = np.fft.rfft2(fixed.astype(float), shape) * np.fft.rfft2(moving[..., ::-1, ::-1].astype(float), shape)
    return np.rint(np.fft.irfft2(f, shape)).astype(np.int64)


def _search(fix: np.ndarray, fx: int, fy: int, mov: np.ndarray, mx: int, my: int, angles: Sequence[float], shift: int | None, cx: float, cy: float) -> list[np.ndarray]:
    """The best shift at each angle, ties to the smallest motion: the pair's number and then ``FOUND``, for pairs of masks (pair, row, column) in common frames."""
    (fh, fw), (mh, mw) = fix.shape[1:], mov.shape[1:]
    x0, y0, x1, y1 = max(fx, mx), max(fy, my), min(fx + fw, mx + mw), min(fy + fh, my + mh)
    both = np.zeros(len(fix), np.int64)
    if x0 < x1 and y0 < y1:
        both = (fix[:, y0 - fy : y1 - fy, x0 - fx : x1 - fx] & mov[:, y0 - my : y1 - my, x0 - mx : x1 - mx]).sum((1, 2))
    n_fix = fix.sum((1, 2))
    rest, found = 2 * both / (n_fix + mov.sum((1, 2))), []
    for angle in angles:
        new, left, top = turned(mov, mx, my, angle, cx, cy)
        k = overlaps(fix, new)
        dy, dx = (np.arange(n) - (size - 1) + at for n, size, at in ((k.shape[1], new.shape[1], fy - top), (k.shape[2], new.shape[2], fx - left)))
        if shift is not None:
            k = np.where((np.abs(dy)[:, None] <= shift) & (np.abs(dx)[None, :] <= shift), k, 0)
        most = k.max((1, 2))
        pair, y, x = np.nonzero(k == np.where(most > 0, most, -1)[:, None, None])
        y, x = dy[y], dx[x]
        order = np.lexsort((x, y, np.abs(y) + np.abs(x), pair))
        first = order[np.flatnonzero(np.diff(pair[order], prepend=-1))]
        own = pair[first]
        found.append((own, np.full(len(own), angle), y[first], x[first], most[own], new.sum((1, 2))[own], n_fix[own], rest[own]))
    return [np.concatenate(v) for v in zip(*found, strict=True)]


def _together(t: pa.Table, by: Sequence[str], search: Callable[..., list[np.ndarray]]) -> tuple[pa.Table, list[np.ndarray]]:
    """Keys of the pairs in a table of pixels, and what ``search`` finds of them, those in like frames at once."""
    pair = np.zeros(t.num_rows, np.int64)
    for c in by:
        codes = t[c].combine_chunks().dictionary_encode("encode").indices.to_numpy()
        pair = np.unique(pair * (codes.max() + 1) + codes, return_inverse=True)[1]
    first = np.unique(pair, return_index=True)[1]
    side, x, y = (t[c].to_numpy().astype(np.int64) for c in ("_side", "x", "y"))
    order = np.argsort(pair * 2 + side, kind="stable")
    pair, side, x, y = (v[order] for v in (pair, side, x, y))
    at = np.flatnonzero(np.diff(pair * 2 + side, prepend=-1))
    x0, x1, y0, y1 = (f.reduceat(v, at) for v in (x, y) for f in (np.minimum, np.maximum))
    # Small frames begin and end at multiples of a power of two no less than their sides, so there are few kinds of them.
    size = np.maximum(np.maximum(x1 - x0, y1 - y0) + 1, 8)
    g = np.where(size <= 64, 1 << np.ceil(np.log2(size)).astype(np.int64), 1)
    left, top = x0 // g * g, y0 // g * g
    frames = np.zeros((len(first), 2, 4), np.int64)
    frames[pair[at], side[at]] = np.stack([left, top, (x1 // g + 1) * g - left, (y1 // g + 1) * g - top], 1)
    kinds, kind = np.unique(frames.reshape(len(first), 8), axis=0, return_inverse=True)
    kind, found = kind.reshape(-1), []
    order = np.argsort(kind[pair], kind="stable")
    pair, side, x, y = (v[order] for v in (pair, side, x, y))
    ends = np.searchsorted(kind[pair], np.arange(len(kinds) + 1))
    for i, (fx, fy, fw, fh, mx, my, mw, mh) in enumerate(kinds.tolist()):
        if not fw or not mw:
            continue
        members = np.flatnonzero(kind == i)
        step = max(1, CELLS // ((fw + 2 * mw) * (fh + 2 * mh)))
        p, s, px, py = (v[ends[i] : ends[i + 1]] for v in (pair, side, x, y))
        for j in range(0, len(members), step):
            some = members[j : j + step]
            here = slice(*np.searchsorted(p, (some[0], some[-1] + 1)))
            masks = np.zeros((len(some), fh, fw), bool), np.zeros((len(some), mh, mw), bool)
            for k, (mask, l, u) in enumerate(zip(masks, (fx, mx), (fy, my), strict=True)):
                m = s[here] == k
                mask[np.searchsorted(some, p[here][m]), py[here][m] - u, px[here][m] - l] = True
            own, *values = search(masks[0], fx, fy, masks[1], mx, my)
            found.append((some[own], *values))
    return t.select(list(by)).take(pa.array(first)), [np.concatenate(v) for v in zip(*found, strict=True)]


def rigid_fit(fixed: DataFrame, moving: DataFrame, by: Sequence[str], angles: Sequence[float], shift: int | None, cx: float, cy: float, angles_a_task: int = 8, pixels: int = PIXELS) -> DataFrame:
    """Angle and whole-pixel shift with the best Dice, and whether it beats no motion.

    At each angle the overlaps at all shifts come from one correlation, so the search covers the whole frame (or ``shift`` pixels,
    if given) at the price of a few transforms. Pairs of up to ``pixels`` pixels are dealt once, and a task takes those in
    like frames together. Larger masks travel as runs; there a task holds one pair and tries some angles.
    """
    side = lambda d, k: d.select(*by, "x", "y", F.lit(k).alias("_side"))
    px = side(fixed, 0).unionByName(side(moving, 1))
    shape = StructType([*(px.schema[c] for c in by), *(StructField(n, DoubleType() if n in ("angle", "_rest") else LongType()) for n in FOUND)])
    arrow, turns, names = to_arrow_schema(shape), [float(a) for a in angles], list(by)

    def rows(keys: pa.Table, own: np.ndarray, values: Sequence[np.ndarray]) -> pa.Table:
        return pa.Table.from_arrays([*keys.take(pa.array(own)).columns, *(pa.array(v) for v in values)], names=arrow.names).cast(arrow)

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if batches and turns:
            keys, found = _together(pa.Table.from_batches(batches), names, lambda *masks: _search(*masks, turns, shift, cx, cy))
            if found:
                own, *values = found
                d, most = 2 * values[3] / (values[4] + values[5]), np.zeros(keys.num_rows)
                np.maximum.at(most, own, d)
                last = d > most[own] - 1e-8  # what may be the best once it is rounded
                yield from rows(keys, own[last], [v[last] for v in values]).to_batches()

    def array(t: pa.Table) -> tuple[np.ndarray, int, int]:
        y, x0, x1 = (t[c].to_numpy().astype(np.int64) for c in ("y", "x0", "x1"))
        out = np.zeros((y.max() - y.min() + 1, x1.max() - x0.min() + 2), np.int8)
        np.add.at(out, (y - y.min(), x0 - x0.min()), 1)
        np.add.at(out, (y - y.min(), x1 + 1 - x0.min()), -1)
        return out.cumsum(1, dtype=np.int8)[None, :, :-1].astype(bool), int(x0.min()), int(y.min())

    def one(t: pa.Table) -> pa.Table:
        sides = [t.filter(pc.equal(t["_side"], k)) for k in (0, 1)]
        if not all(f.num_rows for f in sides):
            return arrow.empty_table()
        own, *values = _search(*array(sides[0]), *array(sides[1]), blocks[t["_block"][0].as_py()], shift, cx, cy)
        return rows(t.select(names), own, values)

    n = rows_in_small_groups([px], by, pixels)
    if n is not None:
        d = together(px, by, n).mapInArrow(several, shape)
    else:
        large = checkpoint(large_groups(px, by, pixels).select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(by)]))
        rest = px.join(large, _equal(by, "_g"), "left_anti")
        blocks = [turns[i : i + angles_a_task] for i in range(0, len(turns), angles_a_task)]
        runs = mask_runs(px.join(large, _equal(by, "_g"), "left_semi").distinct(), [*by, "_side"]).withColumn("_block", F.explode(F.array(*[F.lit(i) for i in range(len(blocks))])))
        d = together(rest, by, rest.count()).mapInArrow(several, shape).unionByName(runs.groupBy(*by, "_block").applyInArrow(one, shape))
    d = d.withColumn("d", F.round(2 * F.col("_k") / (F.col("_nm") + F.col("_nf")), 9))
    # Ties go to the smallest motion, then to the smallest angle and shift.
    rank = F.struct(F.col("d"), (-(F.abs("angle") + F.abs("dy") + F.abs("dx"))).alias("z"), (-F.col("angle")).alias("a"), (-F.col("dy")).alias("v"), (-F.col("dx")).alias("u"), F.round("_rest", 9).alias("rest"))
    best = d.groupBy(*by).agg(F.max(rank).alias("b")).select(*by, (F.lit(0.0) - F.col("b.a")).alias("angle_deg"), (-F.col("b.v")).cast("int").alias("dy"), (-F.col("b.u")).cast("int").alias("dx"),
                                                            F.col("b.d").alias("dice_after"), F.col("b.rest").alias("dice_before"))
    return best.withColumn("accepted", F.col("dice_after") > F.col("dice_before"))


def inverse_transform(points: DataFrame, fit: DataFrame, by: Sequence[str], cx: float, cy: float) -> DataFrame:
    """Undo a fitted motion: shift back, then rotate back about the centre."""
    d = attach(points, fit.select(*by, F.col("angle_deg").alias("_a"), F.col("dy").alias("_dy"), F.col("dx").alias("_dx")), by)
    x, y = rotate(F.col("x") - F.col("_dx"), F.col("y") - F.col("_dy"), -F.col("_a"), cx, cy)
    return d.withColumns({"x": x, "y": y}).drop("_a", "_dy", "_dx")
