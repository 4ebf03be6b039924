"""The pipeline on planted cases, and its stages against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from cohortspark.llm.decontaminate import words_of

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The smallest tables that train well, with planted rows of ids from a million on."""
    folder = tmp_path_factory.mktemp("planted")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("score", F.lit("mine")).withColumn("rows", F.lit(1))
    base = [r.text for r in docs.where("lang = 'en' AND length(text) BETWEEN 1500 AND 4000").orderBy("doc_id").limit(6).collect()]
    rng = random.Random(3)
    words = [w for t in base for w in t.replace(".", "").split() if w.isalpha()]
    fresh = lambda n, seed: " ".join(random.Random(seed).choices(words, k=n))
    own = "\n".join(fresh(14, k).capitalize() + "." for k in range(20))
    edited = own.split(" ")
    for _ in range(4):
        edited[rng.randrange(len(edited))] = "edited"
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").orderBy("item_id").first().text
    rows = {
        1: (own, "kept"), 2: (own, "copy"), 3: (" ".join(edited).replace("\n", " "), "near copy"), 4: (None, "null"), 5: ("", "empty"), 6: ("123 !! 456", "no letter"),
        7: (fresh(150, 98) + "\n" + item + "\n" + fresh(150, 99), "leak"), 8: (item, "all leak"), 9: (fresh(300, 97), "clean"),
        10: ("\n".join(own.split("\n")[4:18]) + "\n" + "\n".join(fresh(12, 200 + k) for k in range(30)), "shared lines"),
    }
    more = spark.createDataFrame([(10**6 + k, t, None, "p", None if t is None else len(t), "mine", 1) for k, (t, _) in rows.items()], docs.schema)
    docs.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    for t in ("benchmark", "labels"):
        spark.read.parquet(f"{FOLDER}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    tables = [spark.read.parquet(f"{folder}/documents.parquet")]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, tables[-1], str(folder)).write.parquet(f"{folder}/stage{k}")
        tables.append(spark.read.parquet(f"{folder}/stage{k}"))
    return str(folder), tables, rows, item


def at(df):
    return {r.doc_id - 10**6: r for r in df.where("doc_id > 1000000").collect()}


def test_columns_stay(planted):
    _, tables, _, _ = planted
    for t in tables[1:5]:
        assert t.dtypes == tables[0].dtypes
        assert t.where("score <> 'mine' OR rows <> 1").count() == 0
    assert tables[5].columns == [*tables[0].columns, "domain", "rate", "copies"]


def test_language_stage(planted):
    _, tables, _, _ = planted
    assert set(at(tables[1])) == {1, 2, 3, 7, 8, 9, 10}
    assert tables[1].count() == tables[0].count() - 3  # clean documents stay


def test_line_stage(planted):
    _, tables, rows, _ = planted
    got = at(tables[2])
    assert got[1].text == rows[1][0] and 2 not in got
    assert len(got[10].text) < len(rows[10][0]) and got[10].n_chars == len(got[10].text)
    assert got[9].text == rows[9][0]


def test_near_duplicate_stage(planted):
    _, tables, _, _ = planted
    got = at(tables[3])
    assert {1, 7, 8, 9, 10} <= set(got) and 3 not in got


def test_decontamination_stage(planted):
    _, tables, rows, item = planted
    got = at(tables[4])
    assert 8 not in got and got[9].text == rows[9][0]
    grams = {tuple(words_of(item)[i : i + 10]) for i in range(len(words_of(item)) - 9)}
    left = words_of(got[7].text)
    assert not grams & {tuple(left[i : i + 10]) for i in range(len(left))} and len(left) >= 290
    items = [words_of(r.text) for r in tables[0].sparkSession.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    every = {tuple(w[i : i + min(10, len(w))]) for w in items for i in range(len(w) - min(10, len(w)) + 1) if w}
    before = {r.doc_id: r.text for r in tables[3].collect()}
    after = {r.doc_id: r.text for r in tables[4].collect()}
    for d, t in before.items():
        w = words_of(t)
        if not any(tuple(w[i : i + n]) in every for n in {len(g) for g in every} for i in range(len(w) - n + 1)):
            assert after[d] == t  # clean documents are left alone


def test_mixing_stage(planted):
    folder, tables, _, _ = planted
    last = tables[5]
    assert last.where("copies < 1").count() == 0 and 1 in at(last)
    labels = last.sparkSession.read.parquet(f"{folder}/labels.parquet")
    share = lambda some: last.join(labels.where(some), "doc_id").count() / tables[4].join(labels.where(some), "doc_id").count()
    assert share("toxic = 1") < 0.2 and share("toxic = 0 AND quality = 1") > 0.95


def test_run_and_empty_tables(spark, planted, tmp_path):
    folder, tables, _, _ = planted
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    assert sorted(r.doc_id for r in pipeline.run(spark, folder).select("doc_id").collect()) == sorted(r.doc_id for r in tables[5].select("doc_id").collect())


def test_rows_without_an_id_and_repeated_ids(spark, make_docs):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, text), (None, text), (None, "other words altogether"), (2, text + " more")]
    out = pipeline.keep_one_of_near_duplicates(spark, make_docs(rows), FOLDER)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, text), (None, text), (None, "other words altogether")], key=str)


@pytest.mark.parametrize("parts", [(180, 16, 4), (120, 70, 10)])
def test_mixing_at_any_composition(spark, make_docs, tmp_path, parts):
    rng = random.Random(sum(parts[1:]))
    kinds = [k for k, n in zip(("good", "poor", "toxic"), parts, strict=True) for _ in range(n)]
    docs = make_docs([" ".join(rng.choice("abcdefghij") + k + rng.choice("klmnopqrst") for _ in range(80)) for k in kinds])
    spark.createDataFrame([(i, int(k == "good"), int(k == "toxic")) for i, k in enumerate(kinds)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = {r.doc_id: r for r in pipeline.mix_domains(spark, docs, str(tmp_path)).collect()}
    assert sorted(out) == [i for i, k in enumerate(kinds) if k != "toxic"]
    assert min(r.rate for r in out.values()) >= 0.99


def test_repeated_ids_with_unlike_texts(spark, make_docs):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    out = pipeline.keep_one_of_near_duplicates(spark, make_docs([(3, a), (5, a), (5, b), (7, b)]), FOLDER)
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(3, a), (5, b)]
