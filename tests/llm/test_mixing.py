"""Mixing: held-out labels, a plain solver, and defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm.mixing import PULL, features, fit_rates, label_domains, mix, posteriors, train

#: A few hundred labels are too few for this classifier.
FOLDER = "/root/testdata/sf0.1"
TARGETS = {"good": 0.9, "poor": 0.1, "toxic": 0.0}


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = label_domains(spark.read.parquet(f"{FOLDER}/labels.parquet"))
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = train(docs, labels.where(~third))
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    got = posteriors(docs, model, list(TARGETS)).withColumn("best", F.get(F.array(*map(F.lit, TARGETS)), best - 1)).join(labels.where(third), "doc_id")
    rows = got.select("best", "domain").collect()
    assert np.mean([r.best == r.domain for r in rows]) > 0.9
    assert np.mean([r.best == "toxic" for r in rows if r.domain == "toxic"]) > 0.8


def test_rates_against_a_plain_solver(spark):
    rng = np.random.default_rng(2)
    cells = [(x.tolist(), int(rng.integers(1, 900))) for x in np.unique(np.diff(np.sort(rng.integers(0, 101, (40, 2)), axis=1), axis=1, prepend=0, append=100), axis=0)]
    wanted = np.array([0.7, 0.25, 0.05])
    total = sum(t for _, t in cells)
    rate, got = fit_rates(spark.createDataFrame(cells, "posterior array<int>, tokens bigint"), wanted.tolist(), float(total), close=1e-4)
    rows = spark.createDataFrame(cells, "posterior array<int>, tokens bigint").select("tokens", "posterior", rate.alias("r")).collect()
    p, share = np.array([c for c, _ in cells]) / 100, np.array([t for _, t in cells]) / total
    scale = 1 / np.maximum(share @ p, wanted)
    r = np.ones(len(p))
    for _ in range(200_000):
        slope = p @ (scale * ((share * r) @ p - wanted)) + PULL * (r - 1)
        r = np.maximum(0, r - slope / (1 + PULL))
    mine = {tuple(x.posterior): x.r for x in rows}
    assert np.abs((share * r) @ p - np.array(got)).max() < 5e-3
    assert max(abs(mine[tuple(c)] - v) for (c, _), v in zip(cells, r)) < 0.15


def test_defined_cases(spark, make_docs):
    words = {"good": "calm river stone light", "toxic": "awful vile scum rot"}
    rows = [(i, " ".join(np.random.default_rng(i).permutation(words["toxic" if i % 4 == 0 else "good"].split() * 3))) for i in range(80)]
    rows += [(None, None), (900, None), (901, ""), (7, rows[7][1]), (902, "calm " * 100_000)]
    labels = spark.createDataFrame([(i, "toxic" if i % 4 == 0 else "good") for i in range(60)] + [(None, "good"), (61, None), (5000, "good"), (1, "good"), (3, "unknown")], "doc_id bigint, domain string")
    docs = make_docs(rows).withColumnRenamed("lang", "tokens").withColumnRenamed("source", "row")
    out = mix(docs, labels, {"good": 1.0, "toxic": 0.0, "none": 0.0})
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) and out.columns[:5] == docs.columns
    assert all(r.domain == ("toxic" if i % 4 == 0 else "good") for i in range(60, 80) for r in got[i])
    assert all(r.copies == 0 for i in range(0, 80, 4) for r in got[i]) and len({(r.rate, r.copies) for r in got[7]}) == 1
    assert got[900][0].n_tokens == 0 and got[902][0].n_tokens == 100_000
    assert mix(make_docs([]), labels, {"good": 1.0}).count() == 0
    for bad in ({}, {"a": -1.0}, {"a": 0.0}):
        with pytest.raises(ValueError):
            mix(docs, labels, bad)
    assert mix(docs.withColumnRenamed("row", "rate"), labels, {"good": 1.0}).where("rate IS NULL").count() == 0


def test_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id bigint, domain string")
    assert {(tuple(r.posterior), round(r.rate, 3)) for r in mix(make_docs(["a b", "c"]), none, {"x": 0.5, "y": 0.5}).collect()} == {((0.5, 0.5), 1.0)}


def test_features():
    assert features(None)[1] == 0 and features("a b a")[1] == 3
    assert (features("one two")[0] == features("two  one")[0]).all()
