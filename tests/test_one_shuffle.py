"""Groups that fit a task are shuffled once, with the results of the joins that huge groups need."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cohortspark.operators import conditions as C
from cohortspark.operators import matching as M
from cohortspark.plans import manifest as P


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def same(a, b) -> bool:
    names = sorted(a.columns)
    assert names == sorted(b.columns)
    return sorted(map(repr, a.select(*names).collect())) == sorted(map(repr, b.select(*names).collect()))


def points(spark, seed):
    r = random.Random(seed)
    rows = [(t if t else None, f"0{i}", r.choice([None, 1.0, 2.0, 2.5, 9.0, 40.0, r.random() * 30])) for t in range(60) for i in range(1, 1 + r.randrange(6))]
    return spark.createDataFrame(rows, "tube_id bigint, section_label string, x double")


def notes(spark):
    r = random.Random(3)
    acts = ("exclude_section", "flag_artefact", "flag_quality", "prefer_section", "prefer_scan")
    rows = [(i, r.choice([None, *range(1, 60)]), r.choice(["", " ", None, "original", "rescan"]), r.choice(["", None, "01", "02", "03"]), r.choice(acts), f"note {i}") for i in range(120)]
    return spark.createDataFrame(rows, "ord bigint, tube_id bigint, scan string, section_label string, action string, note string")


def test_nearest_match(spark):
    left, right = points(spark, 1), points(spark, 2)
    got = M.nearest_match(left, right, ["tube_id"], "x", "section_label")
    assert exchanges(got) <= 1
    assert same(got, M.nearest_match(left, right, ["tube_id"], "x", "section_label", limit=1))


def test_patch_and_prefer(spark):
    one, two = points(spark, 1).withColumn("scan", F.lit("original")), points(spark, 2).withColumn("scan", F.lit("rescan"))
    n = F.coalesce("tube_id", F.lit(0)) + F.col("section_label").cast("int")
    d = one.unionByName(two).withColumns({
        "physical_section_label": F.col("section_label"), "condition": F.when(n % 3 == 0, "unresolved").when(n % 3 == 1, "negative").otherwise("positive"),
        "analysis_include": n % 4 != 0, "scan_is_preferred": F.col("scan") == "rescan"})
    got = C.patch_and_prefer(d, notes(spark))
    assert exchanges(got) <= 1
    assert same(got, C.patch_and_prefer(d, notes(spark), limit=1))


def test_manifest(spark):
    r = random.Random(5)
    boxes = ["near_label", "far_label", "both", None]
    record = spark.createDataFrame([(t, r.choice(boxes), r.choice(["", "", None, "check"]), f"g{t % 3}") for t in range(1, 80) if t % 7], "tube_id bigint, positive_box string, needs_confirmation string, group string")
    first, again = points(spark, 1).withColumn("width_px", F.lit(3).cast("bigint")), points(spark, 2)
    got = P.build_manifest(first, again, record, notes(spark))
    assert exchanges(got) <= 1
    assert same(got, P.build_manifest(first, again, record, notes(spark), limit=1))
    table = [P.section_table(first, again, record, notes(spark), {"g1": "a"}, (1.0, 2.0, 3.0), limit=limit) for limit in (1000, 1)]
    assert exchanges(table[0]) <= 1 and same(*table)
