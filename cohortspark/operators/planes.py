"""Pixel statistics on long tables: one row per pixel, NULL where nothing was acquired."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpoint
from .halo import by_tiles, local_moments, multiscale
from .skew import GROUP_LIMIT, percentiles, value_counts, weighted_percentiles
from .summarise import attach

# Fixed values.
CLIP = 0.995
BINS = 256
BACKGROUND = 0.05
MARKER = 0.995
MIN_TISSUE_FRACTION = 0.005
MIN_TISSUE_PX = 20_000


def assemble(tiles: DataFrame, meta: DataFrame, key: str, tile_w: int, tile_h: int) -> DataFrame:
    """Decoded tiles (``values`` row by row) to pixels with absolute positions.

    The padded grid is cropped to the true size at the tile's level; NaN becomes NULL.
    """
    d = attach(tiles, meta.select(key, "true_w", "true_h"), [key])
    px = d.select(key, "channel", "level", "col", "row", "true_w", "true_h", F.posexplode("values").alias("_i", "_v"))
    scale = F.pow(F.lit(2.0), F.col("level"))
    x, y = F.col("col") * tile_w + F.col("_i") % tile_w, F.col("row") * tile_h + F.floor(F.col("_i") / tile_w)
    v = F.col("_v").cast("double")
    return px.select(key, "channel", "level", x.cast("int").alias("x"), y.cast("int").alias("y"), F.when(~F.isnan(v), v).alias("value"), "true_w", "true_h").where(
        (F.col("x") < F.greatest(F.ceil(F.col("true_w") / scale), F.lit(1))) & (F.col("y") < F.greatest(F.ceil(F.col("true_h") / scale), F.lit(1)))).drop("true_w", "true_h")


def otsu(px: DataFrame, by: Sequence[str], value: str, *, clip: float = CLIP, bins: int = BINS, limit: int = GROUP_LIMIT) -> DataFrame:
    """Threshold with the largest between-class variance on the clipped histogram.

    Pixels are read once, to a table of distinct values with counts; after the exact clip value, a section is at most
    ``bins`` rows. Columns: ``by, threshold``.
    """
    return otsu_of_counts(checkpoint(value_counts(px.select(*by, F.col(value).cast("double").alias("_v")), by, "_v", "_c")), by, clip=clip, bins=bins, limit=limit)


def otsu_of_counts(counts: DataFrame, by: Sequence[str], *, clip: float = CLIP, bins: int = BINS, limit: int = GROUP_LIMIT) -> DataFrame:
    """The same of distinct values ``_v`` with counts ``_c``."""
    top = weighted_percentiles(counts, by, "_v", {"_top": ("_c", clip)}, limit=limit)
    low = counts.groupBy(*by).agg(F.min("_v").alias("_low"))
    c = attach(counts, attach(top, low, by), by).withColumn("_span", F.col("_top") - F.col("_low"))
    b = F.least(F.floor(F.try_divide(F.least("_v", "_top") - F.col("_low"), F.col("_span")) * bins), F.lit(bins - 1))
    h = c.groupBy(*by, "_low", "_span", F.coalesce(b, F.lit(0)).alias("_b")).agg(F.sum("_c").alias("_c"))
    w = W.partitionBy(*by)
    up = w.orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    # Sums of bin numbers are whole, so equal variances are equal whatever the order of the sums, and the lower bin is taken.
    h = h.select("*", (F.col("_low") + (F.col("_b") + 0.5) * F.col("_span") / bins).alias("_m"),
                 F.sum("_c").over(up).alias("_w1"), F.sum(F.col("_c") * F.col("_b")).over(up).alias("_s1"),
                 F.sum("_c").over(w).alias("_n"), F.sum(F.col("_c") * F.col("_b")).over(w).alias("_s"))
    w2 = F.col("_n") - F.col("_w1")
    whole = lambda x: F.col(x).cast("decimal(19,0)")
    gap = (whole("_s1") * whole("_n") - whole("_s") * whole("_w1")).cast("double")
    var = F.try_divide(gap * gap, F.col("_w1").cast("double") * w2)
    best = h.groupBy(*by).agg(
        F.max(F.when(w2 > 0, F.struct(var.alias("var"), (-F.col("_b")).alias("b"), F.col("_m").alias("m")))).alias("_best"),
        F.min("_low").alias("_low"))
    return best.select(*by, F.coalesce(F.col("_best")["m"], F.col("_low")).alias("threshold"))


def above(px: DataFrame, by: Sequence[str], value: str, thresholds: DataFrame) -> DataFrame:
    """Adds ``tissue``: acquired and strictly above the section's threshold."""
    d = attach(px, thresholds.select(*by, F.col("threshold").alias("_t")), by)
    return d.withColumn("tissue", F.coalesce(F.col(value) > F.col("_t"), F.lit(False))).drop("_t")


def masked_percentiles(px: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], mask: Column | None = None, *, limit: int = GROUP_LIMIT) -> DataFrame:
    return percentiles(px.where(mask) if mask is not None else px, by, value, probs, limit=limit)


def _geo(p: DataFrame, by: Sequence[str], min_px: int, *more: str) -> DataFrame:
    t = F.sqrt(F.greatest("_lo", F.lit(1.0)) * F.greatest("_hi", F.lit(2.0)))
    few = F.col("n_values") < min_px
    return p.select(*by, F.col("n_values").alias("n_support_px"), F.when(~few, t).alias("threshold"),
                    F.when(few, "too few acquired pixels").otherwise("").alias("note"), *more)


def geo_threshold(px: DataFrame, by: Sequence[str], value: str, min_px: int = MIN_TISSUE_PX, *, limit: int = GROUP_LIMIT) -> DataFrame:
    """Geometric midpoint of p25 and p99.9, with a note where there are too few pixels."""
    return _geo(percentiles(px, by, value, {"_lo": 0.25, "_hi": 0.999}, limit=limit), by, min_px)


def _long(px: DataFrame, by: Sequence[str], channels: Sequence[str], *more: str) -> DataFrame:
    """One row a pixel and channel with a value."""
    cell = lambda c: F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v"))
    return px.select(*by, *more, F.explode(F.array(*[cell(c) for c in channels])).alias("e")).select(*by, *more, "e.k", "e.v").where(F.col("v").isNotNull())


def percentile_index(px: DataFrame, by: Sequence[str], stain: str, markers: Sequence[str], min_px: int = MIN_TISSUE_PX, *, limit: int = GROUP_LIMIT) -> DataFrame:
    """p99.9 of each marker inside tissue over p99 of the counterstain on its support.

    Pixels are read twice: for the counterstain's counts, from which threshold, base and tissue size follow, and for
    the markers' counts inside tissue.
    """
    counts = checkpoint(value_counts(px.select(*by, F.col(stain).cast("double").alias("_v")), by, "_v", "_c"))
    asked = {"_lo": 0.25, "_hi": 0.999, "_p99": 0.99}
    p = weighted_percentiles(counts, by, "_v", {n: ("_c", q) for n, q in asked.items()}, {"n_values": "_c"}, limit=limit)
    t = checkpoint(_geo(p, by, min_px, "_p99"))
    n = attach(counts, t.select(*by, "threshold"), by).groupBy(*by).agg(F.sum(F.when(F.col("_v") > F.col("threshold"), F.col("_c"))).alias("n_tissue_px"))
    tissue = above(px, by, stain, t.select(*by, "threshold")).where("tissue")
    p = percentiles(_long(tissue, by, markers), [*by, "k"], "v", {"p": 0.999}, limit=limit).groupBy(*by).agg(
        *[F.max(F.when(F.col("k") == m, F.col("p"))).alias(f"_{m}") for m in markers])
    out = attach(attach(t, n, by), p, by).withColumn("n_tissue_px", F.coalesce("n_tissue_px", F.lit(0).cast("bigint")))
    ok = (F.col("note") == "") & (F.col("n_tissue_px") >= min_px)
    return out.select(*by, F.round("threshold", 2).alias("threshold"), "n_support_px", "n_tissue_px",
                      *[F.when(ok, F.round(F.col(f"_{m}") / F.greatest("_p99", F.lit(1.0)), 3)).alias(f"{m}_index") for m in markers],
                      F.when(F.col("note") != "", F.col("note")).when(~ok, "too few tissue pixels").otherwise("").alias("note"))


def marker_index(px: DataFrame, exposures: DataFrame, by: Sequence[str], stain: str, markers: Sequence[str], *, limit: int = GROUP_LIMIT) -> DataFrame:
    """Exposure-normalised marker signal over exposure-normalised counterstain signal.

    Tissue comes from the counterstain alone. ``exposures``: ``by`` and ``<channel>_ms``. Pixels are read twice: for the
    counterstain's threshold, and for one table of counts of all channels, on the plane and inside tissue, that
    every percentile comes from.
    """
    chans = [stain, *markers]
    d = _long(above(px, by, stain, checkpoint(otsu(px, by, stain, limit=limit))), by, chans, "tissue")
    counts = checkpoint(d.groupBy(*by, "k", "v").agg(F.count(F.lit(1)).alias("n_all"), F.count_if("tissue").alias("n_tissue")))
    p = weighted_percentiles(counts, [*by, "k"], "v", {"_bg": ("n_all", BACKGROUND), "_mid": ("n_tissue", 0.5), "_top": ("n_tissue", MARKER)},
                             {"_n": "n_all", "_in": "n_tissue"}, limit=limit)
    own = F.col("k") == stain
    sig = p.withColumn("_sig", F.when(own, F.col("_mid")).otherwise(F.col("_top")) - F.col("_bg"))
    wide = sig.groupBy(*by).agg(*[F.max(F.when(F.col("k") == c, F.col("_sig"))).alias(f"_{c}") for c in chans], F.max(F.when(own, F.col("_in") / F.col("_n"))).alias("tissue_fraction"))
    out = attach(wide, exposures, by)
    denom = F.try_divide(F.col(f"_{stain}"), F.col(f"{stain}_ms"))
    thin = F.col("tissue_fraction") < MIN_TISSUE_FRACTION
    bad = thin | F.coalesce(denom == 0, F.lit(True))
    return out.select(*by, "tissue_fraction",
                      *[F.when(~bad, F.try_divide(F.try_divide(F.col(f"_{m}"), F.col(f"{m}_ms")), denom)).alias(f"{m}_index") for m in markers],
                      F.when(thin, "almost no tissue").when(bad, "counterstain signal is zero").otherwise("").alias("problem"))


def affine_normalise(px: DataFrame, anchors: DataFrame, by: Sequence[str], value: str, floor: float = 0.0):
    """``(value - glass) / gain`` per image or region, and the anchors refused because
    their gain does not exceed the floor (or, for a positive floor, falls below it)."""
    gain = F.col("tissue_p50") - F.col("glass_p50")
    bad = F.coalesce((gain <= 0) if floor <= 0 else (gain < floor), F.lit(True))
    refused = anchors.where(bad).select(*by, gain.alias("gain"))
    good = anchors.where(~bad).select(*by, F.col("glass_p50").alias("_g"), gain.alias("_k"))
    return px.join(good, list(by)).withColumn("normalised", (F.col(value) - F.col("_g")) / F.col("_k")).drop("_g", "_k"), refused


def classify_threshold(value: Column, threshold: float, names: Sequence[str] = ("Negative", "Positive")) -> Column:
    """Two-class label; NULL where nothing was acquired."""
    return F.when(value.isNotNull(), F.when(value > threshold, names[1]).otherwise(names[0]))


def percent_area(px: DataFrame, by: Sequence[str], cls: str, roi: str, pixel_um2: float, positive: str = "Positive", negative: str = "Negative") -> DataFrame:
    """Class areas inside the region, with coverage and a status. One pass over pixels."""
    inside = F.coalesce(F.col(roi), F.lit(False))
    area = lambda cond: F.count_if(cond) * F.lit(float(pixel_um2))
    p, n = F.col(cls) == positive, F.col(cls) == negative
    g = px.groupBy(*by).agg(
        area(inside).alias("roi_um2"), area(inside & p).alias("positive_in_um2"), area(inside & n).alias("negative_in_um2"),
        area(p).alias("positive_frame_um2"), area(n).alias("negative_frame_um2"), area(F.lit(True)).alias("frame_um2"))
    pos, neg, roi_a = F.col("positive_in_um2"), F.col("negative_in_um2"), F.col("roi_um2")
    cover = F.try_divide(pos + neg, roi_a)
    return g.select(
        *by, (100 * F.try_divide(pos, roi_a)).alias("pct_of_roi"), (100 * F.try_divide(pos, pos + neg)).alias("pct_of_nonignored"), pos, neg,
        F.greatest(roi_a - pos - neg, F.lit(0.0)).alias("ignore_in_um2"), roi_a, cover.alias("classified_coverage"),
        F.when(roi_a == 0, "NO_ROI").when(cover < 0.01, "COLLAPSED").when(cover < 0.5, "LOW_COVERAGE").otherwise("OK").alias("qc_status"),
        "positive_frame_um2", "negative_frame_um2", "frame_um2", F.greatest(F.col("positive_frame_um2") - pos, F.lit(0.0)).alias("positive_outside_um2"))


def calibrate(px: DataFrame, by: Sequence[str], value: str, is_control: Column, grid: Sequence[float], limit_pct: float) -> DataFrame:
    """Positive-area percentage per threshold: medians of both classes and p95 of the
    controls; ``chosen`` marks the lowest threshold whose p95 is under the limit.

    Pixels are counted once per grid interval; thresholds only meet those counts.
    """
    g = sorted(float(v) for v in grid)
    place = sum((F.when(F.col(value) > t, 1).otherwise(0) for t in g), F.lit(0))
    hist = px.where(F.col(value).isNotNull()).groupBy(*by, is_control.alias("_ctl")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(place > i).alias(f"_c{i}") for i in range(len(g))])
    each = hist.select(*by, "_ctl", "_n", F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"_c{i}").alias("c")) for i, t in enumerate(g)])).alias("e"))
    pct = each.select(F.col("e.threshold").alias("threshold"), "_ctl", (100.0 * F.col("e.c") / F.col("_n")).alias("pct"))
    p = percentiles(pct, ["threshold", "_ctl"], "pct", {"median": 0.5, "p95": 0.95})
    out = p.groupBy("threshold").agg(
        F.max(F.when(~F.col("_ctl"), F.col("median"))).alias("positive_median"), F.max(F.when(F.col("_ctl"), F.col("median"))).alias("control_median"),
        F.max(F.when(F.col("_ctl"), F.col("p95"))).alias("control_p95"))
    low = out.where(F.col("control_p95") < limit_pct).agg(F.min("threshold").alias("t"))
    return out.withColumn("chosen", F.coalesce(F.col("threshold") == low.select("t").scalar(), F.lit(False)))


def coarsen_plane(px: DataFrame, by: Sequence[str], value: str, level: int) -> DataFrame:
    """Block average of ``2**level`` pixels; missing pixels are left out."""
    k = 2**level
    return px.groupBy(*by, F.floor(F.col("x") / k).alias("x"), F.floor(F.col("y") / k).alias("y")).agg(F.avg(value).alias(value))


def local_norm(px: DataFrame, by: Sequence[str], value: str, radius: int, mode: str = "mean", floor: float = 0.0) -> DataFrame:
    """Subtract the local mean; ``zscore`` also divides by the local deviation, and
    ``floor`` keeps that divisor above a noise level. Missing pixels do not count."""
    return by_tiles(px, by, value, radius, ["normalised"], local_moments(radius, mode, floor))


def features(px: DataFrame, by: Sequence[str], value: str, sigmas: Sequence[float] = (1.0, 2.0, 4.0)) -> DataFrame:
    """Gaussian, Laplacian, weighted deviation and gradient magnitude at each scale, from one shuffle of the pixels."""
    rim, names, kernel = multiscale(sigmas)
    return by_tiles(px, by, value, rim, names, kernel)
