"""Pixel operators against small brute-force versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.operators import morphology as M
from cohortspark.operators import planes as P
from cohortspark.operators import regions as R

BY = ["s"]


def frame_of(spark, *planes):
    rows = [(i, int(x), int(y), None if np.isnan(v) else float(v)) for i, p in enumerate(planes) for (y, x), v in np.ndenumerate(p)]
    return spark.createDataFrame(rows, "s int, x int, y int, value double"), spark.createDataFrame([(i, p.shape[1], p.shape[0]) for i, p in enumerate(planes)], "s int, width int, height int")


def mask_of(df, n, shape):
    out = [np.zeros(shape, bool) for _ in range(n)]
    for r in df.collect():
        out[r.s][r.y, r.x] = True
    return out


def otsu(v):
    v = np.minimum(v, np.percentile(v, 99.5))
    c, e = np.histogram(v, 256)
    m = (e[:-1] + e[1:]) / 2
    w1, w2 = np.cumsum(c), np.cumsum(c[::-1])[::-1]
    a, b = np.cumsum(c * m) / np.maximum(w1, 1), (np.cumsum((c * m)[::-1]) / np.maximum(np.cumsum(c[::-1]), 1))[::-1]
    return m[np.argmax(w1[:-1] * w2[1:] * (a[:-1] - b[1:]) ** 2)]


def dilate(m, k):
    r, p = k // 2, np.pad(m, k // 2)
    return np.any([p[r + a:r + a + m.shape[0], r + b:r + b + m.shape[1]] for a in range(-r, r + 1) for b in range(-r, r + 1)], axis=0)


def erode(m, k):
    r, p = k // 2, np.pad(m, k // 2)
    return np.all([p[r + a:r + a + m.shape[0], r + b:r + b + m.shape[1]] for a in range(-r, r + 1) for b in range(-r, r + 1)], axis=0)


def label(m, eight=False):
    lab, n = np.zeros(m.shape, int), 0
    step = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (eight or not (a and b))]
    for s in zip(*np.nonzero(m)):
        if lab[s]:
            continue
        n, todo = n + 1, [s]
        while todo:
            y, x = todo.pop()
            if 0 <= y < m.shape[0] and 0 <= x < m.shape[1] and m[y, x] and not lab[y, x]:
                lab[y, x] = n
                todo += [(y + a, x + b) for a, b in step]
    return lab, n


@pytest.fixture(scope="module")
def noise():
    g = np.random.default_rng(3)
    return [g.random((24, 20)) < p for p in (0.2, 0.45, 0.6, 0.75)]


def runs(spark, masks):
    px, fr = frame_of(spark, *[m.astype(float) for m in masks])
    return M.mask_runs(px.where("value > 0"), BY), fr


def test_closing_holes_components(spark, noise):
    r, fr = runs(spark, noise)
    n, shape = len(noise), noise[0].shape
    pix = lambda d: mask_of(M.run_pixels(d), n, shape)
    assert all((a == b).all() for a, b in zip(pix(r), noise))
    assert all((a == erode(dilate(m, 5), 5)).all() for a, m in zip(pix(M.close_mask(r, fr, BY, 5)), noise))
    filled = pix(M.fill_holes(r, fr, BY))
    for a, m in zip(filled, noise):
        lab, k = label(~m)
        edge = set(lab[0]) | set(lab[-1]) | set(lab[:, 0]) | set(lab[:, -1])
        assert (a == (m | ((lab > 0) & ~np.isin(lab, list(edge))))).all()
    for eight in (False, True):
        got = M.components(r, BY, 8 if eight else 4).select("s", "root").distinct().groupBy("s").count().collect()
        assert {x.s: x["count"] for x in got} == {i: label(m, eight)[1] for i, m in enumerate(noise)}


def test_snake_settles(spark):
    m = np.zeros((31, 40), bool)
    m[::2] = True
    for i in range(1, 31, 2):
        m[i, -1 if i % 4 == 1 else 0] = True
    r, _ = runs(spark, [m])
    assert M.components(r, BY).select("root").distinct().count() == 1


def section(n=60):
    p = np.full((n, n), 5.0)
    p[13:47, 13:47] = 200
    return p


def test_tissue_mask_fixtures(spark):
    base = section()
    hole, rows, speck, drop = base.copy(), base.copy(), base.copy(), base.copy()
    hole[25:35, 25:35] = np.nan
    rows[:20] = np.nan
    speck[2, 2] = 37612
    drop[::6] = 5
    planes = [base, base * 3 + 40, np.sqrt(base), hole, rows, speck, drop, np.full((60, 60), np.nan)]
    px, fr = frame_of(spark, *planes)
    d = P.above(px, BY, "value", P.otsu(px, BY, "value"))
    got = mask_of(M.tissue_mask(d, fr, BY, closing=7), len(planes), (60, 60))
    area = [g.sum() for g in got]
    assert area[0] == area[1] == area[2] == 34 * 34
    assert not got[3][25:35, 25:35].any() and not got[4][:20].any()
    assert abs(area[5] - area[0]) < 0.02 * area[0] and area[6] > 0.9 * area[0] and area[7] == 0


def test_otsu_equals_reference_definition(spark):
    g = np.random.default_rng(2)
    planes = [np.round(np.where(g.random((30, 30)) < 0.4, g.normal(300, 30, (30, 30)), g.normal(40, 9, (30, 30)))) for _ in range(3)]
    px, _ = frame_of(spark, *planes)
    got = {r.s: r.threshold for r in P.otsu(px, BY, "value", limit=50).collect()}
    for i, p in enumerate(planes):
        assert got[i] == pytest.approx(otsu(p.ravel()))


def test_otsu_takes_the_lower_of_two_bins_with_equal_variance(spark):
    """Values in bins 0, 127, 128 and 255: cutting the first or the last off gives the same variance."""
    lows = [(0.38, 0.8), (0.19, 0.7), (-0.55, 1.3), (0.57, 0.6), (-0.4, 1.4), (0.24, 2.0), (0.9, 1.0), (0.25, 2.0)]
    rows = [(i, v) for i, (low, span) in enumerate(lows) for v in (low, low + 127.5 / 256 * span, low + 128.5 / 256 * span, low + span) for _ in range(300)]
    got = {r.s: r.threshold for r in P.otsu(spark.createDataFrame(rows, "s int, value double"), BY, "value").collect()}
    assert got == {i: pytest.approx(low + span / 512) for i, (low, span) in enumerate(lows)}


def test_marker_index_is_exposure_free(spark):
    n, rows = 40, []
    g = np.random.default_rng(4)
    for s, marker, scale in ((0, 500.0, 1), (1, 6.0, 1), (2, 1000.0, 2)):
        for y in range(n):
            for x in range(n):
                d, m = (200.0, marker) if x < n // 2 else (5.0, 5.0)
                rows.append((s, (d + (x + y) % 3 * 0.1) * scale, m if s != 2 else (m if x < n // 2 else 10.0), 1.0))
    del g
    px = spark.createDataFrame(rows, "s int, dapi double, fitc double, cy3 double")
    ms = spark.createDataFrame([(0, 100.0, 50.0, 20.0), (1, 100.0, 50.0, 20.0), (2, 200.0, 100.0, 40.0)], "s int, dapi_ms double, fitc_ms double, cy3_ms double")
    r = {x.s: x for x in P.marker_index(px, ms, BY, "dapi", ["fitc", "cy3"]).collect()}
    assert r[0].fitc_index > r[1].fitc_index and r[2].fitc_index == pytest.approx(r[0].fitc_index) and r[0].tissue_fraction == 0.5


def test_local_norm_invariances(spark):
    p = np.random.default_rng(6).random((9, 9)) * 50
    px, _ = frame_of(spark, p, p + 30, p * 4)
    for mode, same, differs in (("mean", 1, 2), ("zscore", 2, None)):
        got = [{(r.x, r.y): r.normalised for r in P.local_norm(px.where(F.col("s") == i), BY, "value", 2, mode).collect()} for i in range(3)]
        assert all(got[0][k] == pytest.approx(got[same][k], abs=1e-6) for k in got[0])
        if differs:
            assert any(abs(got[0][k] - got[differs][k]) > 1 for k in got[0])


def test_distance_and_objects(spark, noise):
    m = noise[0]
    px, fr = frame_of(spark, m.astype(float))
    got = {(r.x, r.y): r.distance for r in M.nearest_distance(px.where("value > 0"), px, BY, 3).collect()}
    ys, xs = np.nonzero(m)
    for (y, x), _ in np.ndenumerate(m):
        d = np.sqrt(((ys - y) ** 2 + (xs - x) ** 2).min())
        assert got[x, y] == (pytest.approx(d) if d <= 3 else None)
    o = M.objects(px.where("value > 0"), fr, BY, 1)
    assert o.count() == label(m, True)[1] and o.agg(F.sum("n_px")).first()[0] == m.sum()


def test_polygon_area_and_raster(spark):
    ring = lambda a, b: [[a, a], [b, a], [b, b], [a, b], [a, a]]
    d = spark.createDataFrame([(1, [ring(0.0, 16.0), ring(4.0, 8.0)])], "k int, rings array<array<array<double>>>")
    assert d.select(R.poly_area(F.col("rings")).alias("a")).first().a == 240
    px = M.run_pixels(R.rasterise(d, ["k"]))
    assert px.count() == 240 and px.where("x between 4 and 7 and y between 4 and 7").count() == 0


def test_rigid_fit_finds_a_shift(spark):
    m = np.zeros((20, 20), bool)
    m[4:12, 5:9] = True
    px, _ = frame_of(spark, m.astype(float))
    fixed = px.where("value > 0").select("s", "x", "y")
    moving = fixed.select("s", (F.col("x") + 2).alias("x"), (F.col("y") - 1).alias("y"))
    r = R.rigid_fit(fixed, moving, BY, (-4.0, 0.0, 4.0), 3, 9.5, 9.5).first()
    assert (r.angle_deg, r.dy, r.dx, r.dice_after, r.accepted) == (0.0, 1, -2, 1.0, True)
    same = R.rigid_fit(fixed, fixed, BY, (0.0,), 1, 9.5, 9.5).first()
    assert not same.accepted


def test_percent_area_states(spark):
    rows = [(0, "Positive")] * 30 + [(0, "Negative")] * 60 + [(0, "Ignore")] * 10 + [(1, "Ignore")] * 100 + [(2, "Negative")] * 20 + [(2, "Ignore")] * 80
    d = spark.createDataFrame(rows, "s int, class string").withColumn("roi", F.lit(True))
    r = {x.s: x for x in P.percent_area(d, BY, "class", "roi", 2.0).collect()}
    assert [r[i].qc_status for i in range(3)] == ["OK", "COLLAPSED", "LOW_COVERAGE"]
    assert r[0].pct_of_roi == pytest.approx(30) and r[0].pct_of_nonignored == pytest.approx(100 / 3) and r[1].pct_of_nonignored is None and r[0].ignore_in_um2 == 20


def test_more_channels_than_bits(spark):
    from cohortspark.operators.tiles import support_mismatch, tile_summary
    tiles = spark.createDataFrame([(1, 0, c, 0, ch) for c in range(3) for ch in (0, 63, 64) if (c, ch) != (2, 63)], "file int, level int, col int, row int, channel int")
    assert tile_summary(tiles, "file").first().n_channels == 3
    r = support_mismatch(tiles, "file").first()
    assert (r.mismatched, r.n_positions) == ("63", 1)


def test_long_digit_runs_have_different_keys(spark):
    from pyspark.sql import functions as F

    from cohortspark.functions.text import natural_key
    names = ["a9", "a10", "a" + "1" * 25 + "2", "a" + "1" * 25 + "3", "a007", "b1"]
    d = spark.createDataFrame([(n,) for n in names], "n string").withColumn("k", natural_key(F.col("n")))
    assert [r.n for r in d.orderBy("k").collect()] == ["a007", "a9", "a10", "a" + "1" * 25 + "2", "a" + "1" * 25 + "3", "b1"]
