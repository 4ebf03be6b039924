"""What the cohort queries hand to their operators."""

from pyspark.sql import functions as F

from cohortspark.bindings import cohort
from cohortspark.bindings.registry import Tables


class Seen(Exception):
    pass


def test_classifier_learns_from_all_labelled_planes(spark, monkeypatch):
    rows = [(i, [(i + k) % 7 / 10 - 0.2 for k in range(64)]) for i in range(8)]

    def stop(samples, features, label, **_):
        raise Seen(samples, features)

    monkeypatch.setattr(cohort.C, "train_forest", stop)
    monkeypatch.setattr(Tables, "embeddings", spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("label", F.lit(1)), raising=False)
    try:
        cohort._forest(Tables(spark, "unused"))
    except Seen as e:
        samples, features = e.args
    assert {r.vec_id for r in samples.select("vec_id").distinct().collect()} == set(range(8))
    assert {f.split("_")[1] for f in features} == {"s1", "s2", "s4"} and set(features) <= set(samples.columns)
