"""Query of the spelling variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import query, table
from .spelling import group_variants
from .sql_parts import CRC, crc32

#: Replaced letters meet under a mask of their position, deleted ones in the shorter word.
_SQL = f"""
WITH RECURSIVE {CRC},
runs AS (SELECT key, r, count(*) AS k FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS key,
             unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS r FROM documents) WHERE length(r) >= 5 GROUP BY ALL),
summed AS (SELECT r, k, {crc32("key || ':' || r")} AS h FROM runs, crc_tab),
typed AS (SELECT CASE WHEN h % 97 = 0 THEN left(r, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS word, k FROM summed),
vocab AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS (SELECT word, n, i, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
pairs AS (SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
          UNION SELECT c.word, c.n, v.word, v.n FROM cut c JOIN vocab v ON c.a || c.b = v.word
          UNION SELECT v.word, v.n, c.word, c.n FROM cut c JOIN vocab v ON c.a || c.b = v.word),
best AS (SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS place FROM pairs),
forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
          FROM vocab v LEFT JOIN (SELECT * FROM best WHERE place = 1) b ON v.word = b.word),
up AS (SELECT word, word AS root, 0 AS steps FROM forms UNION ALL SELECT up.word, f.form, steps + 1 FROM up JOIN forms f ON up.root = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT word, max_by(root, steps) AS root FROM up GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN ends e ON f.word = e.word
"""


@query("op13_spelling", _SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return group_variants(table(spark, folder, "documents"), drop_every=97).select("word", "form", "root", "n", "n_near", "form_n")
