"""Query of the substring dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .recompression import remove_repeats
from .registry import query, table

SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents),
win AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d)),
low AS (SELECT g, min(doc_id) AS first FROM win GROUP BY g),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (g) WHERE first < doc_id OR (doc_id IS NULL AND first IS NOT NULL)),
lost AS (SELECT rid, list(p) AS ps, count(*) AS n FROM gone GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN lost USING (rid)
"""


@query("op10_recompression", SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
