"""Binary masks as runs ``(section, y, x0, x1)``: closing, components, holes, distances.

A run table is far smaller than its pixels. Every window is along one raster row, whose
length the image width bounds; sections of any size spread over their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import checkpoint, new_folder, remove
from .halo import lower_envelope
from .summarise import attach

#: Rows of a plane that are labelled in one place (three at least), and columns whose distances are swept in one.
STRIP, COLUMNS = 256, 16
# Least area of an object, and the two it is held against.
MIN_OBJECT_UM2 = (20.0, 10.0, 50.0)


def mask_runs(px: DataFrame, by: Sequence[str]) -> DataFrame:
    """Foreground pixels to maximal runs."""
    w = W.partitionBy(*by, "y").orderBy("x")
    d = px.select(*by, "y", "x").withColumn("_i", F.col("x") - F.row_number().over(w))
    return d.groupBy(*by, "y", "_i").agg(F.min("x").alias("x0"), F.max("x").alias("x1")).drop("_i")


def run_pixels(runs: DataFrame) -> DataFrame:
    return runs.withColumn("x", F.explode(F.sequence("x0", "x1"))).drop("x0", "x1")


def _sweep(runs: DataFrame, by: Sequence[str], depth: Column) -> DataFrame:
    """Stretches of a row covered by enough of its (possibly overlapping) runs."""
    ev = runs.select(*by, "y", F.explode(F.array(F.struct(F.col("x0").alias("x"), F.lit(1).alias("d")), F.struct((F.col("x1") + 1).alias("x"), F.lit(-1).alias("d")))).alias("e"))
    ev = ev.groupBy(*by, "y", F.col("e.x").alias("x")).agg(F.sum("e.d").alias("d"))
    w = W.partitionBy(*by, "y").orderBy("x")
    ev = ev.select(*by, "y", "x", F.sum("d").over(w).alias("_depth"), F.lead("x").over(w).alias("_next"))
    on = ev.where(depth & F.col("_next").isNotNull()).select(*by, "y", F.col("x").alias("x0"), (F.col("_next") - 1).alias("x1"))
    # Join stretches that touch.
    start = (F.lag("x1").over(W.partitionBy(*by, "y").orderBy("x0")) + 1 < F.col("x0"))
    isl = on.withColumn("_n", F.coalesce(start, F.lit(True)).cast("int")).withColumn("_g", F.sum("_n").over(W.partitionBy(*by, "y").orderBy("x0")))
    return isl.groupBy(*by, "y", "_g").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1")).drop("_g")


def _frame(runs: DataFrame, frame: DataFrame, by: Sequence[str]) -> DataFrame:
    return attach(runs, frame.select(*by, "width", "height"), by)


def dilate(runs: DataFrame, frame: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """k x k dilation inside the frame (``frame``: ``by, width, height``)."""
    r = k // 2
    d = _frame(runs, frame, by).select(*by, F.explode(F.sequence(F.greatest(F.col("y") - r, F.lit(0)), F.least(F.col("y") + r, F.col("height") - 1))).alias("y"),
                                       F.greatest(F.col("x0") - r, F.lit(0)).alias("x0"), F.least(F.col("x1") + r, F.col("width") - 1).alias("x1"))
    return _sweep(d, by, F.col("_depth") > 0)


def erode(runs: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """k x k erosion; outside the frame counts as background."""
    r = k // 2
    d = runs.where(F.col("x1") - F.col("x0") >= 2 * r).select(*by, F.explode(F.sequence(F.col("y") - r, F.col("y") + r)).alias("y"), (F.col("x0") + r).alias("x0"), (F.col("x1") - r).alias("x1"))
    return _sweep(d, by, F.col("_depth") == 2 * r + 1)


def close_mask(runs: DataFrame, frame: DataFrame, by: Sequence[str], k: int = 7) -> DataFrame:
    return erode(dilate(runs, frame, by, k), by, k)


def complement(runs: DataFrame, frame: DataFrame, by: Sequence[str]) -> DataFrame:
    """Background runs of every row of the frame."""
    rows = frame.select(*by, "width", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"))
    # Edge markers bound each row, so the gaps between runs are the background.
    marks = rows.select(*by, "y", F.explode(F.array(F.struct(F.lit(-1).alias("x0"), F.lit(-1).alias("x1")), F.struct(F.col("width").alias("x0"), F.col("width").alias("x1")))).alias("m")).select(*by, "y", "m.x0", "m.x1")
    w = W.partitionBy(*by, "y").orderBy("x0")
    both = runs.select(*by, "y", "x0", "x1").unionByName(marks).withColumn("_p", F.lag("x1").over(w))
    return both.where(F.col("_p").isNotNull() & (F.col("x0") - F.col("_p") > 1)).select(*by, "y", (F.col("_p") + 1).alias("x0"), (F.col("x0") - 1).alias("x1"))


def _node(y: Column, x: Column) -> Column:
    return F.call_function("shiftleft", y.cast("bigint"), F.lit(32)) + x


def run_edges(runs: DataFrame, by: Sequence[str], connectivity: int = 4, node: Column | None = None) -> DataFrame:
    """Pairs of touching runs (or of their ``node`` names) in neighbouring rows; their number is linear in the runs.

    Runs of a row are disjoint, so a run only meets the latest run of the other row that
    starts no later than it does.
    """
    grow = 1 if connectivity == 8 else 0
    side = lambda t, dy: runs.select(*by, (F.col("y") + dy).alias("_pair"), F.lit(t).alias("_t"), (2 * F.col("x0") - grow).alias("_s"),
                                     (2 * F.col("x1") + grow).alias("_e"), (_node(F.col("y"), F.col("x0")) if node is None else node).alias("_id"))
    d = side(0, 0).unionByName(side(1, -1))
    w = W.partitionBy(*by, "_pair").orderBy("_s").rangeBetween(W.unboundedPreceding, W.currentRow)
    me = F.struct("_s", "_e", "_id")
    last = lambda t: F.max(F.when(F.col("_t") == t, me)).over(w)
    d = d.withColumn("_o", F.when(F.col("_t") == 0, last(1)).otherwise(last(0))).where(F.col("_o")["_e"] >= F.col("_s"))
    return d.select(*by, F.greatest("_id", F.col("_o")["_id"]).alias("u"), F.least("_id", F.col("_o")["_id"]).alias("v")).distinct()


def connected(edges: DataFrame, by: Sequence[str], max_rounds: int = 50) -> DataFrame:
    """Smallest node of every node's component, by alternating star contractions.

    Each round hangs neighbours below the smallest one they know, so the rounds grow with
    the logarithm of the graph. Neighbourhood minima are combinable aggregates; state
    between rounds is a reliable checkpoint; once a round is written the one before is removed.
    """
    spark = edges.sparkSession
    folder = new_folder(spark, "round")
    e = checkpoint(edges.where(F.col("u") != F.col("v")), folder)
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(*by, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*by, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        big = attach(both.where(F.col("v") > F.col("u")), low, [*by, "u"]).select(*by, F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = big.groupBy(*by, "u").agg(F.min("v").alias("m"))
        small = attach(big, least, [*by, "u"])
        nxt = small.select(*by, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select(*by, "u", F.col("m").alias("v"))).where("u <> v").distinct()
        before, folder = folder, new_folder(spark, "round")
        e = checkpoint(nxt, folder)
        remove(spark, before)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*by, "u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(*by, F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def touching(y: np.ndarray, x0: np.ndarray, x1: np.ndarray, grow: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of runs of neighbouring rows that touch; runs are sorted by row and column."""
    wide = int(x1.max() - min(0, x0.min())) + 4
    row, below = y * wide, (y + 1) * wide
    first = np.searchsorted(row + x1, below + x0 - grow)
    last = np.searchsorted(row + x0, below + x1 + grow, side="right")
    n = np.maximum(last - first, 0)
    u = np.repeat(np.arange(len(y)), n)
    return u, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[u]


def joined(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least member of each one's component."""
    root = np.arange(n)
    while (apart := root[u] != root[v]).any():
        a, b = root[u[apart]], root[v[apart]]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return root


def _label_strips(runs: DataFrame, by: Sequence[str], connectivity: int, strip: int) -> DataFrame:
    """Runs with the smallest node of their component within a strip of rows, which is of bounded size."""
    shape = StructType([*runs.schema.fields, StructField("root", LongType())])
    arrow = to_arrow_schema(shape)

    def run(t: pa.Table) -> pa.Table:
        t = t.drop_columns(["_strip"]).sort_by([("y", "ascending"), ("x0", "ascending")])
        y, x0, x1 = (t[c].to_numpy().astype(np.int64) for c in ("y", "x0", "x1"))
        u, v = touching(y, x0, x1, connectivity == 8)
        return t.append_column("root", pa.array(((y << 32) + x0)[joined(len(y), u, v)])).cast(arrow)

    return runs.withColumn("_strip", F.floor(F.col("y") / strip)).groupBy(*by, "_strip").applyInArrow(run, shape)


def components(runs: DataFrame, by: Sequence[str], connectivity: int = 4, strip: int = STRIP) -> DataFrame:
    """Runs with the ``root`` node of their component.

    Strips of rows are labelled in place; only labels that touch across a strip's edge form a graph, so a section no
    higher than a strip needs none, and a higher one has a graph of its strips' edge rows.
    """
    local = checkpoint(_label_strips(runs, by, connectivity, strip))
    row = F.pmod("y", F.lit(strip))
    edges = checkpoint(run_edges(local.where((row == 0) | (row == strip - 1)), by, connectivity, F.col("root")).where("u <> v"))
    if edges.isEmpty():
        return local
    top = connected(edges, by).withColumnRenamed("root", "_top").withColumnRenamed("node", "root")
    return attach(local, top, [*by, "root"]).withColumn("root", F.coalesce("_top", "root")).drop("_top")


def keep_large(labelled: DataFrame, by: Sequence[str], fraction: float = 0.02) -> DataFrame:
    """Components larger than a fraction of the section's largest one."""
    size = labelled.groupBy(*by, "root").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("_size"))
    top = size.groupBy(*by).agg(F.max("_size").alias("_top"))
    good = attach(size, top, by).where(F.col("_size") > fraction * F.col("_top")).select(*by, "root")
    return labelled.join(good, [*by, "root"], "left_semi")


def fill_holes(runs: DataFrame, frame: DataFrame, by: Sequence[str]) -> DataFrame:
    """Background components that do not touch the frame become foreground."""
    bg = _frame(components(complement(runs, frame, by), by), frame, by)
    edge = (F.col("x0") == 0) | (F.col("y") == 0) | (F.col("x1") == F.col("width") - 1) | (F.col("y") == F.col("height") - 1)
    outside = bg.where(edge).select(*by, "root").distinct()
    holes = bg.join(outside, [*by, "root"], "left_anti").select(*by, "y", "x0", "x1")
    return _sweep(runs.select(*by, "y", "x0", "x1").unionByName(holes), by, F.col("_depth") > 0)


def tissue_mask(px: DataFrame, frame: DataFrame, by: Sequence[str], *, closing: int = 7, fraction: float = 0.02) -> DataFrame:
    """Pixels of the cleaned mask: close, fill, keep large pieces, then drop every pixel
    that was never acquired. ``px``: ``by, x, y, value, tissue``."""
    closed = checkpoint(close_mask(mask_runs(px.where("tissue"), by), frame, by, closing))
    runs = fill_holes(closed, frame, by)
    kept = run_pixels(keep_large(components(runs, by), by, fraction).select(*by, "y", "x0", "x1"))
    return kept.join(px.where(F.col("value").isNotNull()).select(*by, "x", "y"), [*by, "x", "y"], "left_semi")


def tissue_area(mask: DataFrame, sections: DataFrame, by: Sequence[str], um_per_px: Column, small_mm2: float = 5.0) -> DataFrame:
    """Area, piece count and flags of every section, including those without tissue."""
    lab = components(mask_runs(mask, by), by)
    g = lab.groupBy(*by).agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("n_px"), F.count_distinct("root").alias("n_components"))
    area = F.when(F.col("n_px").isNotNull(), F.col("n_px") * um_per_px * um_per_px / 1e6)
    return attach(sections, g, by).select(
        *by, area.alias("area_mm2"), F.coalesce("n_components", F.lit(0)).alias("n_components"),
        F.when(area.isNull(), "no tissue found").when(area < small_mm2, "implausibly small tissue area").otherwise("").alias("problem"))


def objects(mask: DataFrame, frame: DataFrame, by: Sequence[str], min_px: int = 1) -> DataFrame:
    """8-connected objects: size, centroid, whether they touch the frame edge (their pixels still count as area, their size does not)."""
    lab = _frame(components(mask_runs(mask, by), by, 8), frame, by)
    n = F.col("x1") - F.col("x0") + 1
    edge = (F.col("x0") == 0) | (F.col("y") == 0) | (F.col("x1") == F.col("width") - 1) | (F.col("y") == F.col("height") - 1)
    return lab.groupBy(*by, "root").agg(
        F.sum(n).alias("n_px"), (F.sum(n * (F.col("x0") + F.col("x1")) / 2.0) / F.sum(n)).alias("cx"), (F.sum(n * F.col("y")) / F.sum(n)).alias("cy"),
        F.bool_or(edge).alias("touches_edge")).where(F.col("n_px") >= min_px).withColumn("in_size_summary", ~F.col("touches_edge"))


def count_objects(found: DataFrame, region: DataFrame, by: Sequence[str], pixel_um2: float, min_um2: Sequence[float] = MIN_OBJECT_UM2, name: str = "region") -> DataFrame:
    """Objects (of ``objects``) a region, each where its centroid lies, at every least area; sizes are those of objects off the frame's edge.

    ``region``: ``by, name, x, y``. Regions without an object count 0. Columns: ``by, name, n_min_<area>`` and, at the first area, ``mean_um2``.
    """
    at = found.select(*by, F.floor(F.col("cx") + 0.5).cast("int").alias("x"), F.floor(F.col("cy") + 0.5).cast("int").alias("y"), (F.col("n_px") * F.lit(float(pixel_um2))).alias("_area"), "in_size_summary")
    met = at.join(region.select(*by, name, "x", "y").distinct(), [*by, "x", "y"])
    g = met.groupBy(*by, name).agg(*[F.count_if(F.col("_area") >= a).alias(f"n_min_{a:g}") for a in min_um2],
                                   F.avg(F.when(F.col("in_size_summary") & (F.col("_area") >= min_um2[0]), F.col("_area"))).alias("mean_um2"))
    counts = [f"n_min_{a:g}" for a in min_um2]
    return attach(region.select(*by, name).distinct(), g, [*by, name]).fillna(0, subset=counts)


def nearest_distance(mask: DataFrame, px: DataFrame, by: Sequence[str], radius: float | None = None) -> DataFrame:
    """Exact distance in pixels to the nearest mask pixel, NULL beyond ``radius`` (if given) or without one.

    Squared distances along each row come from running extremes; down each column the lowest of the parabolas that stand
    on them is found in one sweep. So the work is linear in the pixels, whatever the radius; a row or column is
    as long as the image at most. ``px`` holds every pixel of its frame once, acquired or not.
    """
    flag = mask.select(*by, "y", "x").distinct().withColumn("_m", F.lit(True))
    d = px.join(flag, [*by, "y", "x"], "left")
    w = W.partitionBy(*by, "y").orderBy("x")
    hit = F.when(F.col("_m"), F.col("x"))
    left, right = F.col("x") - F.max(hit).over(w.rowsBetween(W.unboundedPreceding, 0)), F.max(-hit).over(W.partitionBy(*by, "y").orderBy(F.desc("x")).rowsBetween(W.unboundedPreceding, 0))
    d = d.select(*px.columns, F.least(left, -right - F.col("x")).cast("double").alias("_row"))
    given, shape = px.columns, StructType([*px.schema.fields, StructField("distance", DoubleType())])
    arrow = to_arrow_schema(shape)

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("x")
        x, y, row = t["x"].to_numpy(), t["y"].to_numpy(), t["_row"].to_numpy(zero_copy_only=False)
        height, far = np.where(np.isnan(row), np.inf, row * row), np.empty(len(y))
        edges = [*np.flatnonzero(np.diff(x, prepend=x[0] - 1)).tolist(), len(x)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            low = y[a:b].min()
            column = np.full(int(y[a:b].max() - low) + 1, np.inf)
            column[y[a:b] - low] = height[a:b]
            far[a:b] = np.sqrt(lower_envelope(column)[y[a:b] - low])
        far[~np.isfinite(far) | (far > (np.inf if radius is None else radius))] = np.nan
        return pa.Table.from_arrays([*t.select(given).columns, pa.array(far, from_pandas=True)], names=[*given, "distance"]).cast(arrow)

    return d.withColumn("_strip", F.floor(F.col("x") / COLUMNS)).groupBy(*by, "_strip").applyInArrow(run, shape)


def distance_bands(px: DataFrame, by: Sequence[str], positive: Column, edges: Sequence[float], min_px: int = 1) -> DataFrame:
    """Positive share per distance band (``distance`` NULL is beyond the last edge), and
    the near-minus-far contrast; the near/far ratio is NULL below the minimum area."""
    d = F.col("distance")
    band = F.when(d <= 0, 0)
    for i, e in enumerate(edges):
        band = band.when(d <= e, i + 1)
    per = px.groupBy(*by, band.otherwise(len(edges) + 1).alias("band")).agg(F.count(F.lit(1)).alias("n_px"), F.count_if(positive).alias("n_positive"))
    per = per.withColumn("pct", 100.0 * F.col("n_positive") / F.col("n_px"))
    pick = lambda b, c: F.max(F.when(F.col("band") == b, F.col(c)))
    far = len(edges) + 1
    both = per.groupBy(*by).agg(pick(1, "pct").alias("_near"), pick(far, "pct").alias("_far"), pick(1, "n_px").alias("_a"), pick(far, "n_px").alias("_b"))
    both = both.select(*by, (F.col("_near") - F.col("_far")).alias("contrast"),
                       F.when((F.col("_a") >= min_px) & (F.col("_b") >= min_px), F.try_divide("_near", "_far")).alias("near_far_ratio"))
    return attach(per, both, by)
