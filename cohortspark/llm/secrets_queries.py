"""Query of the secret scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import secrets as s
from .registry import query, table


#: The base patterns with the lengths apart.
BASE = (("assign", s.ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16))
#: The allow list.
ALLOWED = (
    r"^[A-Za-z]+$",
    r"^[A-Za-z]*([/_-]+[A-Za-z]+|[/_-]+[0-9]{1,4})+[/_-]*$",
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"[eE][xX][aA][mM][pP][lL][eE]",
    r"0123456789|1234567890|abcdefghij|ABCDEFGHIJ",
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _found(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    p = _quoted(pattern)
    return f"""SELECT rid, '{kind}' AS kind, {rank} AS rank, start, stop FROM (SELECT rid, length(p) AS n, start, start + length(w) AS stop FROM (
        SELECT rid, w, p, sum(length(g)) OVER (PARTITION BY rid ORDER BY i) + coalesce(sum(length(w)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM (SELECT rid, unnest(range(1, len(ws) + 1)) AS i, ws[i] AS w, gs[i] AS g, ps[i] AS p
              FROM (SELECT rid, regexp_extract_all(t, {p}) AS ws, string_split_regex(t, {p}) AS gs, regexp_extract_all(t, {p}, {group}) AS ps FROM d)))) WHERE n >= {least}"""


def _sql() -> str:
    limit = "CASE " + " ".join(f"WHEN regexp_matches(v, {_quoted(c.pattern)}) THEN {s.largest_sum(c.bits)}" for c in s.CLASSES) + " END"
    allowed = " OR ".join(f"regexp_matches(v, {_quoted(p)})" for p in ALLOWED)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({' UNION ALL '.join(_found(kind, k, *rest) for k, (kind, *rest) in enumerate(BASE))}),
cand AS (SELECT c.rid, c.start, substring(t, CAST(c.start AS BIGINT) + 1, CAST(c.stop - c.start AS BIGINT)) AS v FROM ({_found('c', 9, s.CANDIDATE, 0, 1)}) c JOIN d USING (rid)),
kept AS (SELECT *, {limit} AS most FROM cand WHERE NOT ({allowed})),
win AS (SELECT rid, start, v, most, unnest(range(1, length(v) - {s.WINDOW} + 2)) AS i FROM kept),
letters AS (SELECT rid, start, most, i, x, count(*) AS n FROM (SELECT rid, start, most, i, unnest(string_split(v[i:i + {s.WINDOW - 1}], '')) AS x FROM win) GROUP BY ALL),
hits AS (SELECT rid, start, i FROM letters GROUP BY rid, start, most, i HAVING sum({s.weights()}[n + 1]) <= most),
steps AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY rid, start ORDER BY i) <= {s.WINDOW} THEN 0 ELSE 1 END AS fresh FROM hits),
isles AS (SELECT *, sum(fresh) OVER (PARTITION BY rid, start ORDER BY i) AS isle FROM steps),
spans AS (SELECT rid, start + min(i) - 1 AS a, start + max(i) - 1 + {s.WINDOW} AS b FROM isles GROUP BY rid, start, isle),
fresh AS (SELECT rid, 'entropy' AS kind, {len(s.BASE)} AS rank, a AS start, b AS stop FROM spans WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.rid = spans.rid AND base.start <= a AND b <= base.stop)),
names AS (SELECT rid, kind, rank, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS s FROM (SELECT * FROM base UNION ALL SELECT * FROM fresh)),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
      string_agg(s, ',' ORDER BY start, rank) FILTER (kind <> 'entropy') AS b, string_agg(s, ',' ORDER BY start, rank) AS e FROM names GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(e, '') AS spans FROM d LEFT JOIN g USING (rid)
"""


@query("op3_secrets", _sql())
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = s.find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("secrets", lambda x: x["kind"] != "entropy")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(s.written(base), 256).alias("base_sha256"), s.written(F.col("secrets")).alias("spans"))
