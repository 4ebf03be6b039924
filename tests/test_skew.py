"""The large-group path must give what the plain path gives; both are checked by hand."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.operators.blinding import replicate_index
from cohortspark.operators.skew import cells, mid_ranks, ordered, percentiles, permutation_index, set_digest, top_k, weighted_percentiles

rng = random.Random(5)
#: One key holds a third of the rows, and one value repeats often.
ROWS = [(("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}"), float(rng.choice([7, 7, 7, *range(60)]))) for _ in range(900)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "k string, x double")


def groups():
    out = {}
    for k, x in ROWS:
        out.setdefault(k, []).append(x)
    return out


@pytest.mark.parametrize("limit", [10, 10**6])
def test_ordered_sides(df, limit):
    pts = df.groupBy("k", "x").agg(F.count("*").alias("c"))
    got = ordered(pts, ["k"], "x", {
        "prev": ("max", F.col("x"), "before"), "nxt": ("min", F.col("x"), "after"), "below": ("sum", F.col("c"), "before"),
        "upto": ("sum", F.col("c"), "upto"), "onward": ("sum", F.col("c"), "onward"), "above": ("sum", F.col("c"), "after")}, limit=limit, ranges=7).collect()
    g = groups()
    assert len(got) == sum(len(set(v)) for v in g.values())
    for r in got:
        v = g[r.k]
        lo, hi = [a for a in v if a < r.x], [a for a in v if a > r.x]
        assert (r.prev, r.nxt) == (max(lo, default=None), min(hi, default=None))
        assert (r.below, r.above, r.upto, r.onward) == (len(lo), len(hi), len(v) - len(hi), len(v) - len(lo))


@pytest.mark.parametrize("limit", [10, 10**6])
def test_percentiles_equal_numpy(df, limit):
    got = {r.k: r for r in percentiles(df, ["k"], "x", {"a": 0.25, "b": 0.995}, limit=limit).collect()}
    for k, v in groups().items():
        assert got[k].n_values == len(v)
        assert got[k].a == pytest.approx(np.percentile(v, 25)) and got[k].b == pytest.approx(np.percentile(v, 99.5))


@pytest.mark.parametrize("limit", [10, 10**6])
def test_global_mid_ranks(df, limit):
    got = {r.x: r.mid_rank for r in mid_ranks(df, [], "x", limit=limit).collect()}
    xs = sorted(x for _, x in ROWS)
    for x in set(xs):
        at = [i + 1 for i, v in enumerate(xs) if v == x]
        assert got[x] == sum(at) / len(at)


@pytest.mark.parametrize("limit", [10, 10**6])
def test_replicates_count_every_copy(df, limit):
    d = df.withColumn("v", (F.col("x") % 3).cast("int")).select("k", "v")
    got = replicate_index(d, ["k"], limit=limit).groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("replicate").alias("u"), F.max("replicate").alias("m")).collect()
    for r in got:
        assert r.n == r.u == r.m == len(groups()[r.k])


def test_permutation_is_bijective_and_independent_of_limits(spark):
    ids = spark.range(500)
    a = {r.id: r.pos for r in permutation_index(ids, "id", seed="s", limit=20).collect()}
    b = {r.id: r.pos for r in permutation_index(ids.orderBy(F.desc("id")), "id", seed="s").collect()}
    assert a == b and sorted(a.values()) == list(range(500)) and [a[i] for i in range(500)] != list(range(500))
    c = {r.id: r.pos for r in permutation_index(ids, "id", seed="t").collect()}
    assert a != c


def test_random_orders_are_cut_where_a_task_would_hold_them_whole(spark, monkeypatch):
    ids = spark.range(500).withColumn("k", F.when(F.col("id") < 450, "a"))
    place = lambda by: permutation_index(ids, "id", seed="s", by=by)
    whole = {by: {r.id: r.pos for r in place(by).collect()} for by in ((), ("k",))}
    monkeypatch.setattr("cohortspark.operators.skew.ROWS_A_TASK", 100)
    for by, want in whole.items():
        got = place(by)
        assert "_cell" in got._jdf.queryExecution().analyzed().toString()
        assert {r.id: r.pos for r in got.collect()} == want


def test_set_digest_ignores_order_and_sees_changes(spark):
    a = spark.range(100).select(F.lit(1).alias("k"), F.col("id").cast("string").alias("v"))
    b = a.orderBy(F.desc("v")).unionByName(a)
    digest = lambda d, **kw: set_digest(d, ["k"], F.col("v"), **kw).first().digest
    assert digest(a) == digest(b) and digest(a, distinct=False) != digest(b, distinct=False)
    assert digest(a) != digest(a.where("v <> '7'"))


def test_top_k_limits_rows_before_the_shuffle(df):
    d = top_k(df, ["k"], [F.col("x")], 2)
    assert "WindowGroupLimit" in d._jdf.queryExecution().executedPlan().toString()
    assert d.count() == sum(min(2, len(v)) for v in groups().values())


def test_cells_follow_the_rows(spark):
    """Neither an outlier nor a common prefix fills a cell."""
    n = 100_000
    numbers = spark.range(n).select(F.lit("g").alias("k"), F.when(F.col("id") == 0, 1e12).otherwise(F.col("id") / 7).alias("x"))
    codes = spark.range(n).select(F.lit("g").alias("k"), F.concat(F.lit("one-common-prefix-"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("x"))
    for d in (numbers, codes):
        sizes = [r.n for r in cells(d, ["k"], ["x"], 4000).groupBy("_cell").agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == n and max(sizes) < 0.05 * n
        ends = cells(d, ["k"], ["x"], 4000).groupBy("_cell").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("_cell").collect()
        assert all(a.hi < b.lo for a, b in zip(ends, ends[1:]))


@pytest.mark.parametrize("limit", [30, 10**6])
def test_percentiles_of_masks_from_one_table(spark, limit):
    r = random.Random(3)
    rows = [(r.choice("ab"), float(r.choice([5, 5, r.randrange(400)])), r.random() < 0.3) for _ in range(1500)] + [("c", 1.0, False), ("c", None, True)]
    counts = spark.createDataFrame(rows, "k string, x double, m boolean").groupBy("k", "x").agg(F.count("*").alias("n"), F.count_if("m").alias("n_m"))
    got = {r.k: r for r in weighted_percentiles(counts, ["k"], "x", {"a": ("n", 0.995), "b": ("n_m", 0.5), "c": ("n_m", 0.0)}, {"t": "n", "t_m": "n_m"}, limit=limit).collect()}
    for k in "ab":
        every, some = [x for g, x, _ in rows if g == k], [x for g, x, m in rows if g == k and m]
        assert (got[k].t, got[k].t_m) == (len(every), len(some))
        assert got[k].a == pytest.approx(np.percentile(every, 99.5)) and got[k].b == pytest.approx(np.percentile(some, 50)) and got[k].c == min(some)
    assert tuple(got["c"]) == ("c", 1.0, None, None, 1, 0)


def test_all_side(df):
    for limit in (10, 10**6):
        got = ordered(df.distinct(), ["k"], "x", {"n": ("sum", F.lit(1), "all"), "top": ("max", F.col("x"), "all")}, limit=limit).collect()
        g = groups()
        assert all((r.n, r.top) == (len(set(g[r.k])), max(g[r.k])) for r in got)
