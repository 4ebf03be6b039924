"""Sets of a candidate group are compared range by range."""

import tracemalloc

import numpy as np

from cohortspark.llm import simhash as s


def test_common_in_bounded_memory():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    sets = [np.unique(base[rng.random(len(base)) < 0.9]) for _ in range(100)]
    sets.append(np.array([], np.uint64))
    tracemalloc.start()
    got = s.common(sets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    for i, j in ((0, 1), (5, 99), (7, 7), (3, 100)):
        assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))
