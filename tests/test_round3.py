"""Cases of the third review."""

import hashlib

from pyspark.sql import functions as F

from cohortspark.bindings import cohort
from cohortspark.bindings.registry import Tables
from cohortspark.functions import text as X
from cohortspark.operators import audit as A


def test_path_ids_follow_the_last_slash(spark):
    d = spark.createDataFrame([("/a/38",), ("/a/38/",), ("/38/a",), ("44",), ("",), (None,)], "p string")
    got = d.select(F.size(X.scan_path(F.col("p"), "29|[3-5][0-9]|60"))).collect()
    assert [r[0] for r in got][:5] == [1, 0, 0, 1, 0]


def test_features_are_computed_once(spark, monkeypatch):
    """Training and prediction read a table, not the kernels behind it."""
    kept = []
    monkeypatch.setattr(cohort, "checkpoint", lambda d: kept.append(d) or d.limit(0).unionByName(d.cache()), raising=False)
    t = Tables(spark, "/root/testdata/sf0.001")
    t.embeddings = t.embeddings.where("vec_id < 40")
    assert cohort._forest(t).agg(F.sum("n")).first()[0] == 40 * 64
    assert len(kept) == 1


def test_shuffled_orders_in_ranges(spark):
    """Replicates that are cut into ranges have the places and neighbours of one sorted list."""
    ids = [(i, (i * 37) % 500, "abc"[i % 3] if i % 11 else None) for i in range(500)]
    got = {r["rep"]: (r["n"], int(r["dot"]), r["n_adjacent"]) for r in A._shuffled_orders(spark.createDataFrame(ids, "_id int, _rid bigint, _g string"), 5, "audit", 100).collect()}
    for rep in range(1, 6):
        order = sorted(ids, key=lambda r: hashlib.sha256(f"audit:{rep}-{r[0]}".encode()).hexdigest())
        same = sum(a[2] == b[2] is not None for a, b in zip(order, order[1:]))
        assert got[rep] == (500, sum(r[1] * k for k, r in enumerate(order)), same)
