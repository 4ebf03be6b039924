"""Tiles with a rim, strips and sweeps against whole planes."""

import math
import random

import numpy as np
import pytest

from cohortspark.operators import halo as H
from cohortspark.operators import morphology as M
from cohortspark.operators import planes as P
from cohortspark.operators import regions as R

W, HEIGHT = 30, 23
rng = random.Random(2)
PLANE = {(x, y): (rng.random() if rng.random() < 0.9 else None) for x in range(W) for y in range(HEIGHT) if rng.random() < 0.95}


@pytest.fixture(scope="module")
def px(spark):
    return spark.createDataFrame([("a", x, y, v, f"{x}.{y}") for (x, y), v in PLANE.items()], "s string, x int, y int, value double, note string")


def blurred(values, sigma):
    w = H.gaussian_weights(sigma)
    for axis in (0, 1):
        out = {}
        for p in PLANE:
            near = [(values.get((p[0] + o * (1 - axis), p[1] + o * axis)), k) for o, k in w.items()]
            near = [(v, k) for v, k in near if v is not None]
            out[p] = sum(v * k for v, k in near) / sum(k for _, k in near) if near else None
        values = out
    return values


def test_features_are_the_same_over_tile_edges(px):
    rim, names, kernel = H.multiscale((1.0, 2.0))
    got = {(r.x, r.y): r for r in H.by_tiles(px, ["s"], "value", rim, names, kernel, tile=7).collect()}
    assert got.keys() == PLANE.keys() and all(r.note == f"{x}.{y}" for (x, y), r in got.items())
    for sigma, tag in ((1.0, "s1"), (2.0, "s2")):
        g, q = blurred(PLANE, sigma), blurred({p: v and v * v for p, v in PLANE.items()}, sigma)
        for (x, y), r in got.items():
            c = g[x, y]
            a, b, u, d = (c if (n := g.get(p)) is None else n for p in ((x - 1, y), (x + 1, y), (x, y - 1), (x, y + 1)))
            assert r[f"gauss_{tag}"] == pytest.approx(c) and r[f"laplace_{tag}"] == pytest.approx(a + b + u + d - 4 * c, abs=1e-9)
            assert r[f"std_{tag}"] == pytest.approx(math.sqrt(max(q[x, y] - c * c, 0)), abs=1e-6) and r[f"gradient_{tag}"] == pytest.approx(math.hypot((b - a) / 2, (d - u) / 2))


def test_pixels_are_shuffled_once(px):
    plan = P.features(px, ["s"], "value")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("radius", [None, 154, 4])
def test_distance_for_any_radius(px, spark, radius):
    frame = spark.createDataFrame([("a", x, y) for x in range(W) for y in range(HEIGHT)], "s string, x int, y int")
    seeds = [p for p, v in PLANE.items() if v is not None and v > 0.97]
    got = {(r.x, r.y): r.distance for r in M.nearest_distance(px.where("value > 0.97"), frame, ["s"], radius).collect()}
    assert len(got) == W * HEIGHT
    for p, d in got.items():
        want = min(math.dist(p, q) for q in seeds)
        assert d == (None if radius and want > radius else pytest.approx(want))
    assert {r.distance for r in M.nearest_distance(px.limit(0), px, ["s"], radius).collect()} == {None}


def test_lower_envelope():
    r = np.random.default_rng(1)
    for _ in range(200):
        h = np.where(r.random(40) < 0.5, np.inf, r.integers(0, 300, 40).astype(float))
        i = np.arange(40)
        assert np.array_equal(H.lower_envelope(h), (h[None, :] + (i[:, None] - i[None, :]) ** 2).min(1))


@pytest.mark.parametrize("connectivity", [4, 8])
def test_components_over_strips(px, connectivity):
    on = {p for p, v in PLANE.items() if v is not None and v > 0.42}
    near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if abs(a) + abs(b) == 1 or connectivity == 8 and (a or b)]
    want = {}
    for p in sorted(on, key=lambda p: (p[1], p[0])):
        if p not in want:
            want[p] = p
            todo = [p]
            while todo:
                x, y = todo.pop()
                for q in ((x + a, y + b) for a, b in near):
                    if q in on and q not in want:
                        want[q] = p
                        todo.append(q)
    for strip in (3, 5, 256):
        runs = M.components(M.mask_runs(px.where("value > 0.42"), ["s"]), ["s"], connectivity, strip)
        got = {(x, r.y): (r.root % 2**32, r.root >> 32) for r in runs.collect() for x in range(r.x0, r.x1 + 1)}
        assert got == want


def squares(spark, *boxes):
    rect = lambda a, b, c, d: [[a, b], [c, b], [c, d], [a, d]]
    return spark.createDataFrame([("r", [[[float(v) for v in p] for p in rect(*box)]]) for box in boxes], "region string, rings array<array<array<double>>>")


def test_overlap_counts_once(spark):
    two = squares(spark, (0, 0, 10, 10), (5, 0, 15, 10))
    assert R.union_area(two, ["region"]).first().area == 150
    assert M.run_pixels(R.rasterise(two, ["region"])).count() == 150
    twice = squares(spark, (0, 0, 4, 4), (0, 0, 4, 4), (8, 8, 9, 9))
    assert R.union_area(twice, ["region"]).first().area == 17
    assert M.run_pixels(R.rasterise(twice, ["region"])).count() == 17


def test_union_of_crossing_polygons(spark):
    r = random.Random(4)
    polygons = []
    for k in range(6):
        for _ in range(4):
            c, turn = (r.uniform(20, 40), r.uniform(20, 40)), r.random()
            star = [[c[0] + d * math.cos(2 * math.pi * (i / 9 + turn)), c[1] + d * math.sin(2 * math.pi * (i / 9 + turn))] for i in range(9) for d in (r.uniform(5, 18),)]
            hole = [[c[0] + 2 * math.cos(i), c[1] + 2 * math.sin(i)] for i in range(6)]
            polygons.append((k, [star, hole]))
    df = spark.createDataFrame(polygons, "k int, rings array<array<array<double>>>")
    fine = 16
    got = {r.k: r.area for r in R.union_area(df, ["k"]).collect()}
    at = (np.arange(60 * fine) + 0.5) / fine
    for k in range(6):
        inside = np.zeros((len(at), len(at)), bool)
        for g, rings in polygons:
            if g == k:
                odd = np.zeros_like(inside)
                for ring in rings:
                    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
                        with np.errstate(divide="ignore", invalid="ignore"):
                            cross = ((ay > at) != (by > at))[:, None] & (at[None, :] < (ax + (at - ay) * (bx - ax) / (by - ay))[:, None])
                        odd ^= cross
                inside |= odd
        assert got[k] == pytest.approx(inside.sum() / fine**2, rel=2e-3)


def test_a_shift_of_half_a_frame_is_found(spark):
    """A blob moved by half the frame and turned by 2.75 degrees comes back; a mask without a partner gives no row."""
    side = 120
    blob = {(x, y) for x in range(10, 55) for y in range(15, 45) if (x - 30) ** 2 / 400 + (y - 30) ** 2 / 150 < 1 or (x > 40 and y > 36)}
    grid = np.zeros((side, side), bool)
    for x, y in blob:
        grid[y, x] = True
    new, left, top = R.turned(grid, 0, 0, 2.75, 60, 60)
    fixed = [(1, x + left - 7 + 60, y + top + 55) for y, x in np.argwhere(new).tolist()]
    f = spark.createDataFrame([*fixed, (2, 0, 0)], "k int, x int, y int")
    m = spark.createDataFrame([(1, x, y) for x, y in blob], "k int, x int, y int")
    found = R.rigid_fit(f, m, ["k"], [a / 4 for a in range(-16, 17)], None, 60, 60).collect()
    assert [(r.k, r.angle_deg, r.dx, r.dy, r.dice_after, r.accepted) for r in found] == [(1, 2.75, 53, 55, 1.0, True)]
    near = R.rigid_fit(f, m, ["k"], [2.75], 54, 60, 60).collect()
    assert near[0].dy == 54 and near[0].dice_after < 1


def test_overlaps_count_every_shift():
    r = np.random.default_rng(2)
    a, b = r.random((6, 7)) < 0.5, r.random((4, 5)) < 0.5
    got = R.overlaps(a, b)
    for dy in range(-3, 6):
        for dx in range(-4, 7):
            want = sum(a[y + dy, x + dx] and b[y, x] for y in range(4) for x in range(5) if 0 <= y + dy < 6 and 0 <= x + dx < 7)
            assert got[dy + 3, dx + 4] == want
