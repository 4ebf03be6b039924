"""Language identification: held-out accuracy and defined cases."""

import zlib

import numpy as np

from cohortspark.llm.language_id import PairwiseModel, features, held_out, identify, sample, train, train_svm
from cohortspark.llm.load import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op1_language_id"](spark, FOLDER).collect()
    assert len(rows) == len(true)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    mine = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == true[r.doc_id] for r in mine]) > 0.98
    family = {"en": "germanic", "de": "germanic", "fr": "romance", "es": "romance"}
    assert all(family[r.lang_pred] == r.family_pred for r in rows if r.family_pred)


def test_defined_cases(spark, make_docs):
    models = train(spark.read.parquet(f"{FOLDER}/documents.parquet"), per_language=60)
    texts = [None, "", "12 34 !?", "The thing that was of and", "the " * 200_000, "\U0001d538", "!" * 10 + "x", "the thing", "the thing"]
    out = {r.doc_id: r for r in identify(make_docs(texts).withColumnRenamed("source", "family"), models).collect()}
    assert [out[i].lang_pred for i in range(3)] == ["und"] * 3 and [out[i].score for i in range(3)] == [0.0] * 3
    assert out[3].lang_pred == "en" and out[4].lang_pred == "en" and out[5].lang_pred != "und" and out[6].lang_pred != "und"
    assert (out[7].lang_pred, out[7].score) == (out[8].lang_pred, out[8].score)
    assert identify(make_docs([]), models).count() == 0
    assert identify(make_docs(texts).withColumnRenamed("source", "score"), models).where("score > 1").count() == 0


def test_few_languages(make_docs):
    none = train(make_docs([]))
    assert [r.lang_pred for r in identify(make_docs(["word"]), none).collect()] == ["und"]
    one = train(make_docs(["some words", None, ""]))
    assert [(r.lang_pred, r.score) for r in identify(make_docs(["word"]), one).collect()] == [("en", 1.0)]


def test_unknown_languages_are_families(spark):
    rows = [("aa bb ab", "xx"), ("cc dd cd", "yy"), ("ee ff ef", "en"), ("gg hh gh", "de")] * 3
    models = train(spark.createDataFrame(rows, "text string, lang string"))
    out = identify(spark.createDataFrame(rows, "text string, lang string"), models).collect()
    assert all(r.lang == r.lang_pred for r in out)


def test_sample_takes_copies_once(spark):
    rows = [("same text", "en")] * 500 + [(f"text {i}", "de") for i in range(2000)]
    n = {}
    for r in sample(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", 100).collect():
        n[r.lang] = n.get(r.lang, 0) + 1
    assert n.get("en", 0) <= 1 and 60 < n["de"] < 150


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    y = np.where(x @ np.array([1, -2, 0.5, 0, 1]) > 0, 1.0, -1.0)
    w, b = train_svm(x, y, epochs=200)
    assert np.mean(np.sign(x @ w + b) == y) > 0.97
    three = PairwiseModel(np.eye(3).repeat(4, 0), list("aaaabbbbcccc"))
    assert [three.classes[i] for i in three.decide(np.eye(3, dtype=np.float32))[0]] == list("abc")


def test_features_of_long_text_are_whole():
    text = "alpha beta " * 60_000
    assert np.allclose(features(text), features("alpha beta " * 600), atol=0.01)
    assert features("12 !").any() and not features("").any()
