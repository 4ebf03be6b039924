"""Query of the line dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .line_chunks import LINES, remove_chunks
from .registry import query, table

#: All passages of so many lines, whether or not a mark chooses them.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT rid, id, i, ls[i] AS x, array_to_string(ls[i:i + {LINES - 1}], chr(10)) AS t, i + {LINES - 1} <= len(ls) AS whole FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
m AS (SELECT rid, id, i, first_value(id) OVER w AS id0, first_value(i) OVER w AS i0 FROM l WHERE whole AND regexp_matches(t, '[^\\x00-\\x20]') WINDOW w AS (PARTITION BY t ORDER BY id, i)),
g AS (SELECT DISTINCT rid, i + j AS i FROM m, range({LINES}) r(j) WHERE id > id0 OR (id = id0 AND i > i0)),
f AS (SELECT l.rid, count(*) FILTER (g.i IS NOT NULL) AS gone, string_agg(x, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS t FROM l LEFT JOIN g ON l.rid = g.rid AND l.i = g.i GROUP BY l.rid)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS clean_sha256 FROM d LEFT JOIN f USING (rid)
"""


@query("op7_line_chunks", SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_chunks(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("clean_sha256"))
