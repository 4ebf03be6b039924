"""Registration of many small pairs at once equals that of each by itself."""

import numpy as np
import pyarrow as pa

from cohortspark.operators import regions as R

ANGLES = [a / 4 for a in range(-16, 17, 4)]


def _rows(pairs):
    return [(k, int(x + left), int(y + top)) for k, (m, left, top) in pairs for y, x in np.argwhere(m)]


def _pairs(seed, n=24):
    r = np.random.default_rng(seed)
    for i in range(n):
        size = (r.integers(1, 12), r.integers(1, 12)) if i % 5 else (70, 3)
        yield None if i == 7 else f"k{i}", (r.random(size) < 0.5, int(r.integers(-9, 9)), int(r.integers(-9, 9)))


def _both(spark):
    return [spark.createDataFrame(_rows(p), "k string, x int, y int") for p in (list(_pairs(1)), [p for i, p in enumerate(_pairs(2)) if i != 3])]


def test_small_pairs_equal_large_ones(spark):
    for shift in (None, 2):
        got = [sorted(R.rigid_fit(*_both(spark), ["k"], ANGLES, shift, 3.5, 3.5, pixels=n).collect(), key=str) for n in (R.PIXELS, 40, 0)]
        keys = {r.k for r in got[0]}
        assert got[0] == got[1] == got[2] and len(keys) > (5 if shift else 15)
        assert "k3" not in keys and (shift or None in keys)


def test_small_pairs_share_a_search(spark, monkeypatch):
    """400 pairs in one frame: the arrays of a search hold many pairs, and equal brute force at no turn."""
    r = np.random.default_rng(5)
    fix, mov = (r.random((400, 6, 6)) < 0.4 for _ in range(2))
    calls = []
    rows = [(i, s, x, y) for s, m in enumerate((fix, mov)) for i, y, x in np.argwhere(m).tolist()]
    t = pa.table(dict(zip(("k", "_side", "x", "y"), map(list, zip(*rows, strict=True)), strict=True)))
    keys, (own, angle, dy, dx, k, nm, nf, rest) = R._together(t, ["k"], lambda *m: calls.append(len(m[0])) or R._search(*m, [0.0], None, 2.5, 2.5))
    assert calls == [400] and sorted(own) == list(range(400))
    for p, i in enumerate(keys["k"].take(own).to_pylist()):
        best = max((sum(fix[i][y + v, x + u] for y, x in np.argwhere(mov[i]) if 0 <= y + v < 6 and 0 <= x + u < 6), -abs(v) - abs(u), -v, -u) for v in range(-5, 6) for u in range(-5, 6))
        assert (k[p], -dy[p], -dx[p]) == (best[0], best[2], best[3])
        assert rest[p] == 2 * (fix[i] & mov[i]).sum() / (fix[i].sum() + mov[i].sum())
