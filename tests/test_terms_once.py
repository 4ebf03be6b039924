from __future__ import annotations

from pyspark.sql import functions as F

from cohortspark.operators.audit import audit_terms


def test_each_value_is_searched_once(spark):
    i = F.col("id")
    d = spark.range(300).select(F.concat(F.lit("K"), i.cast("string")).alias("code"), F.when(i % 3 == 0, "the Placebo arm").when(i % 3 == 1, "clean").alias("note"),
                                F.when(i % 2 == 0, F.concat(F.lit("/raw/diet/"), (i % 10).cast("string"))).otherwise("none").alias("diet_file"))
    got = audit_terms(d, ["placebo", "diet"])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert sorted(map(tuple, got.collect())) == [("LEAK", "path", "diet_file", "150"), ("LEAK", "term", "diet_file", "diet"), ("LEAK", "term", "note", "placebo"), ("LEAK", "term_in_name", "diet_file", "diet")]
