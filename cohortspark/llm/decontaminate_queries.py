"""Query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import find_matches
from .registry import query, table

_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, CASE WHEN text IS NULL THEN [] ELSE {_WORDS.format('text')} END AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM bw)),
ks AS (SELECT DISTINCT k FROM grams),
dg AS (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks)),
found AS (SELECT rid, dg.k, i, item_id FROM dg JOIN grams USING (k, g)),
hits AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM found) GROUP BY rid),
items AS (SELECT rid, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items.s, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""


@query("op5_decontaminate", SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = find_matches(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    n_hit = F.aggregate("hit", F.lit(0).cast("bigint"), lambda n, x: n + x["stop"] - x["start"])
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
