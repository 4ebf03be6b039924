"""Pixel planes: each embedding is an 8 x 8 plane; some pixels were never acquired."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import morphology as M
from ..operators import planes as P
from ..operators.tiles import choose_level
from .checks import TILES, _tiles
from .registry import query, rnd

BY = ["vec_id"]


def pixels(t):
    d = t.embeddings.select("vec_id", "label", F.posexplode("embedding").alias("i", "v"))
    gone = (F.col("vec_id") + F.col("i")) % 13 == 0
    return d.select("vec_id", "label", (F.col("i") % 8).alias("x"), F.floor(F.col("i") / 8).cast("int").alias("y"), F.when(~gone, F.col("v").cast("double")).alias("value"))


PX = """px AS (SELECT vec_id, label, CAST(i % 8 AS INTEGER) AS x, CAST(i // 8 AS INTEGER) AS y, CASE WHEN (vec_id + i) % 13 = 0 THEN NULL ELSE embedding[i + 1]::DOUBLE END AS value FROM embeddings, range(64) r(i))"""
MASK = f"{PX}, m AS (SELECT vec_id, x, y FROM px WHERE value > 0)"
OFF3 = "o3 AS (SELECT a.d AS dx, b.d AS dy FROM (VALUES (-1), (0), (1)) a(d), (VALUES (-1), (0), (1)) b(d))"
FOUR = "(abs(p.x - q.x) + abs(p.y - q.y) = 1)"


def mask(t):
    return pixels(t).where("value > 0")


def frame(t):
    return t.embeddings.select("vec_id", F.lit(8).alias("width"), F.lit(8).alias("height"))


def _px(runs):
    return M.run_pixels(runs).select("vec_id", "x", "y")


@query("i01_assemble", """SELECT vec_id // 16 AS section, CAST(0 AS INTEGER) AS channel, CAST(1 AS INTEGER) AS level, CAST(vec_id % 4 * 8 + i % 8 AS INTEGER) AS x, CAST((vec_id // 4) % 4 * 8 + i // 8 AS INTEGER) AS y, embedding[i + 1]::DOUBLE AS value
FROM embeddings, range(64) r(i) WHERE vec_id % 4 * 8 + i % 8 < 30 AND (vec_id // 4) % 4 * 8 + i // 8 < 29""")
def _assemble(t):
    k = F.col("vec_id")
    tiles = t.embeddings.select(F.floor(k / 16).alias("section"), F.lit(0).alias("channel"), F.lit(1).alias("level"), (k % 4).alias("col"), (F.floor(k / 4) % 4).alias("row"), F.col("embedding").alias("values"))
    meta = tiles.select("section").distinct().select("section", F.lit(60).alias("true_w"), F.lit(57).alias("true_h"))
    return P.assemble(tiles, meta, "section", 8, 8)


@query("i02_choose_level", f"""WITH {TILES} SELECT container, arg_min(level, abs(level - w) * 100 + level) AS level FROM (SELECT container, level, CASE container WHEN 'A' THEN 5 WHEN 'N' THEN 2 ELSE 0 END AS w FROM til WHERE level <> 3 OR container <> 'A') GROUP BY 1""")
def _level(t):
    tiles = _tiles(t).where("level <> 3 OR container <> 'A'")
    um = F.when(F.col("container") == "A", 0.325).when(F.col("container") == "N", 2.6).otherwise(40.0)
    return choose_level(tiles, "container", um)


OTSU = """th AS (WITH v AS (SELECT vec_id, value FROM px WHERE value IS NOT NULL),
s AS (SELECT vec_id, min(value) AS lo, quantile_cont(value, 0.995) AS hi FROM v GROUP BY 1),
h AS (SELECT vec_id, lo, hi - lo AS span, least(floor((least(value, hi) - lo) / (hi - lo) * 256), 255) AS b, count(*) AS c FROM v JOIN s USING (vec_id) GROUP BY ALL),
w AS (SELECT *, lo + (b + 0.5) * span / 256 AS mid FROM h),
z AS (SELECT vec_id, b, mid, sum(c) OVER up AS w1, sum(c * mid) OVER up AS s1, sum(c) OVER al AS n, sum(c * mid) OVER al AS sm FROM w
  WINDOW up AS (PARTITION BY vec_id ORDER BY b ROWS UNBOUNDED PRECEDING), al AS (PARTITION BY vec_id))
SELECT vec_id, mid AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY w1::DOUBLE * (n - w1) * (s1 / w1 - (sm - s1) / (n - w1)) * (s1 / w1 - (sm - s1) / (n - w1)) DESC, b) AS rn FROM z WHERE n > w1) WHERE rn = 1)"""


@query("i03_clipped_otsu", f"WITH {PX}, {OTSU} SELECT vec_id, round(threshold, 8) AS threshold FROM th")
def _otsu(t):
    return P.otsu(pixels(t), BY, "value").withColumn("threshold", rnd(F.col("threshold"), 8))


@query("d15_masked_percentiles", """SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99, round(quantile_cont(l_extendedprice, 0.999), 6) AS p999, count(*) AS n_values
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1""")
def _percentiles(t):
    p = P.masked_percentiles(t.lineitem, ["l_suppkey"], "l_extendedprice", {"p25": 0.25, "p99": 0.99, "p999": 0.999}, F.col("l_returnflag") != "R")
    return p.select("l_suppkey", *[rnd(F.col(c), 6).alias(c) for c in ("p25", "p99", "p999")], "n_values")


@query("d15_plane_percentiles", f"WITH {PX} SELECT vec_id, round(quantile_cont(value, 0.05), 8) AS p5, round(quantile_cont(value, 0.5), 8) AS p50, count(value) AS n_values FROM px WHERE value IS NOT NULL GROUP BY 1")
def _plane_percentiles(t):
    p = P.masked_percentiles(pixels(t), BY, "value", {"p5": 0.05, "p50": 0.5})
    return p.select("vec_id", rnd(F.col("p5"), 8).alias("p5"), rnd(F.col("p50"), 8).alias("p50"), "n_values")


def wide(t):
    """Lines as pixels of three channels; the supplier is the section."""
    return t.lineitem.select(F.col("l_suppkey").alias("section"), F.col("l_extendedprice").alias("dapi"), (F.col("l_quantity") * 10).alias("fitc"), (F.col("l_tax") * 1000 + F.col("l_discount") * 100).alias("cy3"))


WIDE = "wd AS (SELECT l_suppkey AS section, l_extendedprice AS dapi, l_quantity * 10 AS fitc, l_tax * 1000 + l_discount * 100 AS cy3 FROM lineitem)"
GEO = f"""{WIDE}, q AS (SELECT section, count(*) AS n, sqrt(greatest(quantile_cont(dapi, 0.25), 1.0) * greatest(quantile_cont(dapi, 0.999), 2.0)) AS thr, quantile_cont(dapi, 0.99) AS p99 FROM wd GROUP BY 1)"""


@query("i04_geometric_threshold", f"WITH {GEO} SELECT section, n AS n_support_px, CASE WHEN n >= 600 THEN round(thr, 4) END AS threshold, CASE WHEN n < 600 THEN 'too few acquired pixels' ELSE '' END AS note FROM q")
def _geo(t):
    return P.geo_threshold(wide(t), ["section"], "dapi", 600).withColumn("threshold", rnd(F.col("threshold"), 4))


@query("i12_percentile_index", f"""WITH {GEO}, ti AS (SELECT section, count(*) AS n_tissue_px, quantile_cont(fitc, 0.999) AS f, quantile_cont(cy3, 0.999) AS c FROM wd JOIN q USING (section) WHERE dapi > thr GROUP BY 1)
SELECT section, round(thr, 2) AS threshold, n AS n_support_px, coalesce(n_tissue_px, 0) AS n_tissue_px, CASE WHEN coalesce(n_tissue_px, 0) >= 140 THEN round(f / greatest(p99, 1), 3) END AS fitc_index, CASE WHEN coalesce(n_tissue_px, 0) >= 140 THEN round(c / greatest(p99, 1), 3) END AS cy3_index,
  CASE WHEN coalesce(n_tissue_px, 0) < 140 THEN 'too few tissue pixels' ELSE '' END AS note FROM q LEFT JOIN ti USING (section)""")
def _pindex(t):
    return P.percentile_index(wide(t), ["section"], "dapi", ["fitc", "cy3"], 140)


@query("i11_marker_index", f"""WITH {WIDE}, px AS (SELECT section AS vec_id, dapi AS value FROM wd), {OTSU},
b AS (SELECT section, quantile_cont(dapi, 0.05) AS bd, quantile_cont(fitc, 0.05) AS bf, quantile_cont(cy3, 0.05) AS bc, count(*) AS n FROM wd GROUP BY 1),
i AS (SELECT section, quantile_cont(dapi, 0.5) AS d, quantile_cont(fitc, 0.995) AS f, quantile_cont(cy3, 0.995) AS c, count(*) AS k FROM wd JOIN th ON vec_id = section WHERE dapi > threshold GROUP BY 1)
SELECT section, round(k / n::DOUBLE, 6) AS tissue_fraction, round((f - bf) / (397.927::DOUBLE + section) / ((d - bd) / 128.547::DOUBLE), 6) AS fitc_index, round((c - bc) / 1839.999::DOUBLE / ((d - bd) / 128.547::DOUBLE), 6) AS cy3_index, '' AS problem FROM b JOIN i USING (section)""")
def _mindex(t):
    ms = t.supplier.select(F.col("s_suppkey").alias("section"), F.lit(128.547).alias("dapi_ms"), (F.lit(397.927) + F.col("s_suppkey")).alias("fitc_ms"), F.lit(1839.999).alias("cy3_ms"))
    d = P.marker_index(wide(t), ms, ["section"], "dapi", ["fitc", "cy3"])
    return d.withColumns({c: rnd(F.col(c)) for c in ("tissue_fraction", "fitc_index", "cy3_index")})


ANCHORS = f"{PX}, an AS (SELECT vec_id, quantile_cont(value, 0.25) AS g, quantile_cont(value, 0.5) AS p FROM px WHERE value IS NOT NULL GROUP BY 1)"


def _anchors(t):
    return P.masked_percentiles(pixels(t), BY, "value", {"glass_p50": 0.25, "tissue_p50": 0.5})


@query("b25_affine_normalise", f"WITH {ANCHORS} SELECT vec_id, x, y, round((value - g) / (p - g), 6) + 0.0::DOUBLE AS normalised FROM px JOIN an USING (vec_id) WHERE p - g >= 0.08")
def _affine(t):
    return P.affine_normalise(pixels(t), _anchors(t), BY, "value", 0.08)[0].select("vec_id", "x", "y", rnd(F.col("normalised")).alias("normalised"))


@query("b25_refused_anchors", f"WITH {ANCHORS} SELECT vec_id, round(p - g, 8) AS gain FROM an WHERE NOT p - g >= 0.08")
def _refused(t):
    return P.affine_normalise(pixels(t), _anchors(t), BY, "value", 0.08)[1].withColumn("gain", rnd(F.col("gain"), 8))


@query("i13_threshold_classes", f"WITH {PX} SELECT vec_id, x, y, CASE WHEN value > 0.1::DOUBLE THEN 'Positive' WHEN value IS NOT NULL THEN 'Negative' END AS class FROM px")
def _classes(t):
    return pixels(t).select("vec_id", "x", "y", P.classify_threshold(F.col("value"), 0.1).alias("class"))


CLASSED = f"{PX}, cl AS (SELECT *, CASE WHEN value > 0.1::DOUBLE THEN 'Positive' WHEN value > -0.02::DOUBLE THEN 'Negative' WHEN value IS NOT NULL THEN 'Ignore' END AS c, x BETWEEN 1 AND 6 AND y BETWEEN 1 AND 6 AS roi FROM px)"
AREA = """ar AS (SELECT vec_id, count(*) FILTER (roi) * 4.0::DOUBLE AS r, count(*) FILTER (roi AND c = 'Positive') * 4.0::DOUBLE AS p, count(*) FILTER (roi AND c = 'Negative') * 4.0::DOUBLE AS n,
  count(*) FILTER (c = 'Positive') * 4.0::DOUBLE AS pa, count(*) FILTER (c = 'Negative') * 4.0::DOUBLE AS na, count(*) * 4.0::DOUBLE AS fa FROM cl GROUP BY 1)"""


def classed(t):
    v = F.col("value")
    return pixels(t).withColumns({
        "class": F.when(v > 0.1, "Positive").when(v > -0.02, "Negative").when(v.isNotNull(), "Ignore"),
        "roi": F.col("x").between(1, 6) & F.col("y").between(1, 6)})


@query("d19_percent_area", f"""WITH {CLASSED}, {AREA} SELECT vec_id, round(100 * p / r, 6) AS pct_of_roi, round(100 * p / nullif(p + n, 0), 6) AS pct_of_nonignored, p AS positive_in_um2, n AS negative_in_um2, greatest(r - p - n, 0) AS ignore_in_um2, r AS roi_um2,
  round((p + n) / r, 6) AS classified_coverage, CASE WHEN (p + n) / r < 0.01 THEN 'COLLAPSED' WHEN (p + n) / r < 0.5 THEN 'LOW_COVERAGE' ELSE 'OK' END AS qc_status, pa AS positive_frame_um2, na AS negative_frame_um2, fa AS frame_um2, greatest(pa - p, 0) AS positive_outside_um2 FROM ar""")
def _area(t):
    d = P.percent_area(classed(t), BY, "class", "roi", 4.0)
    return d.withColumns({c: rnd(F.col(c)) for c in ("pct_of_roi", "pct_of_nonignored", "classified_coverage")})


GRID = (-0.1, 0.0, 0.1, 0.2, 0.3)


@query("i14_calibrate_threshold", f"""WITH {PX}, g AS (SELECT vec_id, label = 0 AS ctl, t AS threshold, 100.0::DOUBLE * count(*) FILTER (value > t) / count(*) AS pct FROM px, (VALUES {', '.join(f'({v}::DOUBLE)' for v in GRID)}) v(t) WHERE value IS NOT NULL GROUP BY ALL),
s AS (SELECT threshold, median(pct) FILTER (NOT ctl) AS pm, median(pct) FILTER (ctl) AS cm, quantile_cont(pct, 0.95) FILTER (ctl) AS c95 FROM g GROUP BY 1)
SELECT threshold, round(pm, 6) AS positive_median, round(cm, 6) AS control_median, round(c95, 6) AS control_p95, coalesce(threshold = (SELECT min(threshold) FROM s WHERE c95 < 12), false) AS chosen FROM s""")
def _calibrate(t):
    d = P.calibrate(pixels(t), BY, "value", F.col("label") == 0, GRID, 12.0)
    return d.withColumns({c: rnd(F.col(c)) for c in ("positive_median", "control_median", "control_p95")})


@query("k05_resolution_sweep", f"""WITH {PX}, lv AS (SELECT vec_id, l, x // (1 << l) AS x, y // (1 << l) AS y, avg(value) AS v FROM px, (VALUES (0), (1), (2)) r(l) GROUP BY ALL)
SELECT vec_id, l AS level, round(100.0 * count(*) FILTER (v > 0.01::DOUBLE) / count(*), 6) AS pct_of_roi, count(*) AS n_px FROM lv GROUP BY 1, 2""")
def _sweep(t):
    out = None
    for level in (0, 1, 2):
        d = P.coarsen_plane(pixels(t), BY, "value", level).withColumns({"class": P.classify_threshold(F.col("value"), 0.01), "roi": F.lit(True)})
        a = P.percent_area(d, BY, "class", "roi", 1.0).select("vec_id", F.lit(level).alias("level"), rnd(F.col("pct_of_roi")).alias("pct_of_roi"), F.col("frame_um2").cast("bigint").alias("n_px"))
        out = a if out is None else out.unionByName(a)
    return out


@query("e09_mask_runs", f"""WITH {MASK}, g AS (SELECT *, x - row_number() OVER (PARTITION BY vec_id, y ORDER BY x) AS i FROM m) SELECT vec_id, y, min(x) AS x0, max(x) AS x1 FROM g GROUP BY vec_id, y, i""")
def _runs(t):
    return M.mask_runs(mask(t), BY)


CLOSED = f"""{OFF3}, dil AS (SELECT DISTINCT vec_id, x + dx AS x, y + dy AS y FROM m, o3 WHERE x + dx BETWEEN 0 AND 7 AND y + dy BETWEEN 0 AND 7),
clo AS (SELECT vec_id, x, y FROM (SELECT vec_id, x + dx AS x, y + dy AS y FROM dil, o3) GROUP BY ALL HAVING count(*) = 9)"""


@query("i05_binary_closing", f"WITH {MASK}, {CLOSED} SELECT * FROM clo")
def _close(t):
    return _px(M.close_mask(M.mask_runs(mask(t), BY), frame(t), BY, 3))


def _square_sql(name: str, r: int) -> str:
    return f"{name} AS (SELECT a.d AS dx, b.d AS dy FROM range({-r}, {r + 1}) a(d), range({-r}, {r + 1}) b(d))"


@query("i05_closing_7", f"""WITH {MASK}, {_square_sql('o7', 3)}, dil AS (SELECT DISTINCT vec_id, x + dx AS x, y + dy AS y FROM m, o7 WHERE x + dx BETWEEN 0 AND 7 AND y + dy BETWEEN 0 AND 7)
SELECT vec_id, CAST(d.x + dx AS INTEGER) AS x, CAST(d.y + dy AS INTEGER) AS y FROM dil d, o7 GROUP BY ALL HAVING count(*) = 49""")
def _close_7(t):
    return _px(M.close_mask(M.mask_runs(mask(t), BY), frame(t), BY))


def _comp_sql(source: str, eight: bool = False) -> str:
    near = "abs(p.x - q.x) <= 1 AND abs(p.y - q.y) <= 1" if eight else FOUR
    return f"""WITH RECURSIVE {MASK}, {CLOSED}, {{extra}}
r(vec_id, s, x, y) AS (SELECT vec_id, y * 8 + x, x, y FROM {source} UNION SELECT p.vec_id, p.s, q.x, q.y FROM r p JOIN {source} q ON p.vec_id = q.vec_id AND {near}),
lab AS (SELECT vec_id, x, y, min(s) AS label FROM r GROUP BY 1, 2, 3)"""


def _labelled(runs):
    d = runs.withColumn("label", (F.shiftright("root", 32) * 8 + F.col("root") % 2**32).cast("int"))
    return M.run_pixels(d).select("vec_id", "x", "y", "label")


@query("i06_components", _comp_sql("m").replace("{extra}", "") + " SELECT * FROM lab")
def _components(t):
    return _labelled(M.components(M.mask_runs(mask(t), BY), BY))


@query("i06_components_8", _comp_sql("m", True).replace("{extra}", "") + " SELECT * FROM lab")
def _components8(t):
    return _labelled(M.components(M.mask_runs(mask(t), BY), BY, 8))


_LARGE = ", sz AS (SELECT vec_id, label, count(*) AS n FROM lab GROUP BY 1, 2), kp AS (SELECT lab.vec_id, x, y FROM lab JOIN sz USING (vec_id, label) JOIN (SELECT vec_id, max(n) AS top FROM sz GROUP BY 1) USING (vec_id) WHERE n > 0.3 * top)"


@query("i06_keep_large", _comp_sql("m").replace("{extra}", "") + _LARGE + " SELECT * FROM kp")
def _large(t):
    return _px(M.keep_large(M.components(M.mask_runs(mask(t), BY), BY), BY, 0.3))


def _fill_sql(source: str) -> str:
    return f"""bg AS (SELECT vec_id, x, y FROM px WHERE (vec_id, x, y) NOT IN (SELECT (vec_id, x, y) FROM {source})),
ou(vec_id, x, y) AS (SELECT vec_id, x, y FROM bg WHERE x IN (0, 7) OR y IN (0, 7) UNION SELECT q.vec_id, q.x, q.y FROM ou p JOIN bg q ON p.vec_id = q.vec_id AND {FOUR}),
fil AS (SELECT vec_id, x, y FROM px WHERE (vec_id, x, y) NOT IN (SELECT (vec_id, x, y) FROM ou))"""


@query("i07_fill_holes", f"WITH RECURSIVE {MASK}, {_fill_sql('m')} SELECT * FROM fil")
def _fill(t):
    return _px(M.fill_holes(M.mask_runs(mask(t), BY), frame(t), BY))


_TISSUE = _comp_sql("fil").replace("{extra}", _fill_sql("clo") + ",") + _LARGE + ", tm AS (SELECT kp.* FROM kp JOIN px USING (vec_id, x, y) WHERE value IS NOT NULL)"


def tissue(t):
    px = pixels(t).withColumn("tissue", F.coalesce(F.col("value") > 0, F.lit(False)))
    return M.tissue_mask(px, frame(t), BY, closing=3, fraction=0.3)


@query("i08_tissue_mask", _TISSUE + " SELECT vec_id, x, y FROM tm")
def _tissue(t):
    return tissue(t).select("vec_id", "x", "y")


@query("i08_tissue_area", f"""WITH RECURSIVE {MASK}, r(vec_id, s, x, y) AS (SELECT vec_id, y * 8 + x, x, y FROM m UNION SELECT p.vec_id, p.s, q.x, q.y FROM r p JOIN m q ON p.vec_id = q.vec_id AND {FOUR}),
lab AS (SELECT vec_id, x, y, min(s) AS label FROM r GROUP BY 1, 2, 3), a AS (SELECT vec_id, count(*) * 900.0 * 900.0 / 1e6 AS area, count(DISTINCT label) AS k FROM lab GROUP BY 1)
SELECT vec_id, round(area, 6) AS area_mm2, coalesce(k, 0) AS n_components, CASE WHEN area IS NULL THEN 'no tissue found' WHEN area < 25 THEN 'implausibly small tissue area' ELSE '' END AS problem FROM embeddings LEFT JOIN a USING (vec_id)""")
def _tissue_area(t):
    d = M.tissue_area(mask(t), t.embeddings.select("vec_id"), BY, F.lit(900.0), 25.0)
    return d.withColumn("area_mm2", rnd(F.col("area_mm2")))


BOX = "bx AS (SELECT p.vec_id, p.x, p.y, p.value, avg(q.value) AS mu, sqrt(greatest(avg(q.value * q.value) - avg(q.value) * avg(q.value), 0)) AS sd FROM px p JOIN px q ON p.vec_id = q.vec_id AND abs(p.x - q.x) <= 1 AND abs(p.y - q.y) <= 1 GROUP BY ALL)"


@query("i09_local_normalisation", f"WITH {PX}, {BOX} SELECT vec_id, x, y, round(value - mu, 6) + 0.0::DOUBLE AS mean, round((value - mu) / greatest(sd, 0.05), 5) + 0.0::DOUBLE AS floored FROM bx")
def _norm(t):
    px = pixels(t)
    a = P.local_norm(px, BY, "value", 1).select("vec_id", "x", "y", rnd(F.col("normalised")).alias("mean"))
    b = P.local_norm(px, BY, "value", 1, "floor", 0.05).select("vec_id", "x", "y", rnd(F.col("normalised"), 5).alias("floored"))
    return a.join(b, ["vec_id", "x", "y"])


@query("i09_zscore", f"WITH {PX}, {BOX} SELECT vec_id, x, y, round((value - mu) / nullif(sd, 0), 5) + 0.0::DOUBLE AS zscore FROM bx")
def _zscore(t):
    return P.local_norm(pixels(t), BY, "value", 1, "zscore").select("vec_id", "x", "y", rnd(F.col("normalised"), 5).alias("zscore"))


SIGMAS = (1, 2, 4)


def _scale_sql(k: int) -> str:
    """One scale: blurred along x, then y, then the differences to the four neighbours."""
    w = ", ".join(f"({o}, {math.exp(-o * o / (2.0 * k * k))!r}::DOUBLE)" for o in range(-3 * k, 3 * k + 1))
    return f"""w{k}(o, w) AS (VALUES {w}),
gx{k} AS (SELECT p.vec_id, p.x, p.y, sum(q.value * w) / sum(w) FILTER (q.value IS NOT NULL) AS g, sum(q.value * q.value * w) / sum(w) FILTER (q.value IS NOT NULL) AS s FROM px p, w{k} JOIN px q ON q.vec_id = p.vec_id AND q.y = p.y AND q.x = p.x + o GROUP BY ALL),
gg{k} AS (SELECT p.vec_id, p.x, p.y, sum(q.g * w) / sum(w) FILTER (q.g IS NOT NULL) AS g, sum(q.s * w) / sum(w) FILTER (q.s IS NOT NULL) AS s FROM gx{k} p, w{k} JOIN gx{k} q ON q.vec_id = p.vec_id AND q.x = p.x AND q.y = p.y + o GROUP BY ALL),
nb{k} AS (SELECT c.*, coalesce(l.g, c.g) AS l, coalesce(r.g, c.g) AS r, coalesce(u.g, c.g) AS u, coalesce(b.g, c.g) AS b FROM gg{k} c LEFT JOIN gg{k} l ON l.vec_id = c.vec_id AND l.y = c.y AND l.x = c.x - 1 LEFT JOIN gg{k} r ON r.vec_id = c.vec_id AND r.y = c.y AND r.x = c.x + 1
  LEFT JOIN gg{k} u ON u.vec_id = c.vec_id AND u.x = c.x AND u.y = c.y - 1 LEFT JOIN gg{k} b ON b.vec_id = c.vec_id AND b.x = c.x AND b.y = c.y + 1),
f{k} AS (SELECT vec_id, x, y, round(g, 6) + 0.0::DOUBLE AS gauss_s{k}, round(sqrt(greatest(s - g * g, 0)), 5) AS std_s{k}, round(l + r + u + b - 4 * g, 6) + 0.0::DOUBLE AS laplace_s{k}, round(sqrt((r - l) * (r - l) / 4 + (b - u) * (b - u) / 4), 6) AS gradient_s{k} FROM nb{k})"""


@query("i10_multiscale_features", f"WITH {PX}, {', '.join(map(_scale_sql, SIGMAS))} SELECT * FROM f1 JOIN f2 USING (vec_id, x, y) JOIN f4 USING (vec_id, x, y)")
def _features(t):
    f = P.features(pixels(t), BY, "value")
    return f.select("vec_id", "x", "y", *[rnd(F.col(f"{c}_s{k}"), 5 if c == "std" else 6).alias(f"{c}_s{k}") for k in SIGMAS for c in ("gauss", "std", "laplace", "gradient")])


SEEDS = f"{PX}, m AS (SELECT vec_id, x, y FROM px WHERE value > 0.25::DOUBLE), ds AS (SELECT p.vec_id, p.x, p.y, p.value, min(sqrt((p.x - m.x) ** 2 + (p.y - m.y) ** 2)) AS dist FROM px p LEFT JOIN m ON p.vec_id = m.vec_id AND (p.x - m.x) ** 2 + (p.y - m.y) ** 2 <= 9 GROUP BY ALL)"


def _distance(t):
    px = pixels(t)
    return M.nearest_distance(px.where("value > 0.25"), px, BY, 3)


@query("l01_nearest_distance", f"WITH {SEEDS} SELECT vec_id, x, y, round(dist, 6) AS distance FROM ds")
def _dist(t):
    return _distance(t).select("vec_id", "x", "y", rnd(F.col("distance")).alias("distance"))


@query("l01_distance_bands", f"""WITH {SEEDS}, b AS (SELECT vec_id, CASE WHEN dist <= 0 THEN 0 WHEN dist <= 1 THEN 1 WHEN dist <= 2 THEN 2 ELSE 3 END AS band, count(*) AS n_px, count(*) FILTER (value > 0) AS n_positive FROM ds GROUP BY 1, 2),
c AS (SELECT vec_id, max(100.0::DOUBLE * n_positive / n_px) FILTER (band = 1) AS nr, max(100.0::DOUBLE * n_positive / n_px) FILTER (band = 3) AS fr, max(n_px) FILTER (band = 1) AS a, max(n_px) FILTER (band = 3) AS z FROM b GROUP BY 1)
SELECT vec_id, CAST(band AS INTEGER) AS band, n_px, n_positive, round(100.0 * n_positive / n_px, 6) AS pct, round(nr - fr, 6) + 0.0::DOUBLE AS contrast, round(CASE WHEN a >= 3 AND z >= 3 THEN nr / nullif(fr, 0) END, 6) AS near_far_ratio FROM b JOIN c USING (vec_id)""")
def _bands(t):
    d = M.distance_bands(_distance(t), BY, F.col("value") > 0, [1.0, 2.0], 3)
    return d.select("vec_id", "band", "n_px", "n_positive", *[rnd(F.col(c)).alias(c) for c in ("pct", "contrast", "near_far_ratio")])


@query("l02_object_table", _comp_sql("m", True).replace("{extra}", "") + """ SELECT vec_id, label, count(*) AS n_px, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy, bool_or(x IN (0, 7) OR y IN (0, 7)) AS touches_edge, NOT bool_or(x IN (0, 7) OR y IN (0, 7)) AS in_size_summary
FROM lab GROUP BY 1, 2 HAVING count(*) >= 2""")
def _objects(t):
    d = M.objects(mask(t), frame(t), BY, 2).withColumn("label", (F.shiftright("root", 32) * 8 + F.col("root") % 2**32).cast("int"))
    return d.select("vec_id", "label", "n_px", rnd(F.col("cx")).alias("cx"), rnd(F.col("cy")).alias("cy"), "touches_edge", "in_size_summary")


@query("l02_objects_by_region", _comp_sql("m", True).replace("{extra}", "") + """, ob AS (SELECT vec_id, label, count(*) * 9.0::DOUBLE AS a, floor(avg(x) + 0.5) AS cx, floor(avg(y) + 0.5) AS cy, bool_or(x IN (0, 7) OR y IN (0, 7)) AS edge FROM lab GROUP BY 1, 2)
SELECT e.vec_id, CAST(side AS INTEGER) AS side, count(*) FILTER (a >= 20) AS n_min_20, count(*) FILTER (a >= 10) AS n_min_10, count(*) FILTER (a >= 50) AS n_min_50, round(avg(a) FILTER (a >= 20 AND NOT edge), 6) AS mean_um2
FROM embeddings e CROSS JOIN range(2) s(side) LEFT JOIN ob ON ob.vec_id = e.vec_id AND floor(cx / 4) = side GROUP BY 1, 2""")
def _objects_by_region(t):
    side = pixels(t).select("vec_id", F.floor(F.col("x") / 4).cast("int").alias("side"), "x", "y")
    d = M.count_objects(M.objects(mask(t), frame(t), BY), side, BY, 9.0, name="side")
    return d.withColumn("mean_um2", rnd(F.col("mean_um2")))
