from __future__ import annotations

import random

from cohortspark.operators.blinding import replicate_index


def test_one_shuffle(spark):
    r = random.Random(4)
    rows = [(r.choice([None, *range(40)]), r.choice([None, "a", "b"]), r.choice([None, 1.0, 2.0, r.random()])) for _ in range(2000)]
    d = spark.createDataFrame([*rows, *[(7, "c", 1.0)] * 25_000], "k bigint, t string, v double")
    got = replicate_index(d, ["k"])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(repr, got.collect())) == sorted(map(repr, replicate_index(d, ["k"], limit=5).collect()))
