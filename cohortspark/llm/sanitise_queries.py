"""Query of the personal data and the terms that give it away."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sanitise as s
from .registry import query, table

#: The base patterns.
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
_DIGITS = "regexp_replace(w, '[^0-9]', '', 'g')"
_LUHN = (f"list_sum(list_transform(range(length({_DIGITS})), lambda j: CASE WHEN j % 2 = 0 THEN CAST({_DIGITS}[length({_DIGITS}) - j] AS INT) "
         f"ELSE CAST({_DIGITS}[length({_DIGITS}) - j] AS INT) * 2 - CASE WHEN CAST({_DIGITS}[length({_DIGITS}) - j] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0")
_VALID = {"email": "true", "ip": "list_bool_and(list_transform(string_split(w, '.'), lambda x: CAST(x AS DOUBLE) <= 255))",
          "card": f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}", "phone": f"length({_DIGITS}) BETWEEN 10 AND 15"}
_ENTITY = {"email": "translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
           "ip": "array_to_string(list_transform(string_split(w, '.'), lambda x: CAST(CAST(x AS DOUBLE) AS BIGINT)), '.')", "card": _DIGITS, "phone": _DIGITS}
_TERM = "[a-z0-9À-ɏ]+"


def _positions(pattern: str, source: str, text: str) -> str:
    """``rid, w, start``: matches in order with their places, from the gaps between them."""
    return f"""SELECT rid, w, sum(length(g)) OVER (PARTITION BY rid ORDER BY i) + coalesce(sum(length(w)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM (SELECT rid, unnest(range(1, len(ws) + 1)) AS i, ws[i] AS w, gs[i] AS g FROM (SELECT rid, regexp_extract_all({text}, '{pattern}') AS ws, string_split_regex({text}, '{pattern}') AS gs FROM {source}))"""


def _sql() -> str:
    base = " UNION ALL ".join(f"SELECT rid, '{k}' AS kind, {i} AS rank, CAST(start AS BIGINT) AS start, CAST(start + length(w) AS BIGINT) AS stop, '{k}:' || {_ENTITY[k]} AS entity "
                              f"FROM ({_positions(PATTERNS[k], 'd', 't')}) WHERE {_VALID[k]}" for i, k in enumerate(s.KINDS))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, md5(coalesce(text, '')) AS digest FROM documents),
base AS ({base}),
own AS (SELECT * FROM d WHERE rid IN (SELECT rid FROM base)),
words AS (SELECT rid, w AS term, CAST(start AS BIGINT) AS a, CAST(start + length(w) AS BIGINT) AS z FROM ({_positions(_TERM, 'own', 'low')}) WHERE length(w) >= {s.LEAST_TERM}),
outside AS (SELECT * FROM words w WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = w.rid AND b.start < w.z AND w.a < b.stop)),
near AS (SELECT DISTINCT o.rid, digest, entity, term FROM outside o JOIN base b ON o.rid = b.rid AND ((o.a >= b.start - {s.REACH} AND o.z <= b.start) OR (o.a >= b.stop AND o.z <= b.stop + {s.REACH})) JOIN d ON d.rid = o.rid),
pairs AS (SELECT entity, term, count(*) AS n_both FROM near GROUP BY ALL HAVING count(DISTINCT digest) >= {s.SUPPORT}),
entities AS (SELECT entity, count(DISTINCT rid) AS n_entity FROM base GROUP BY ALL),
terms AS (SELECT term, count(*) AS n_term FROM (SELECT DISTINCT rid, unnest(regexp_extract_all(low, '{_TERM}')) AS term FROM d) GROUP BY ALL),
told AS (SELECT entity, term FROM pairs JOIN entities USING (entity) JOIN terms USING (term), (SELECT count(*) AS total FROM d)
         WHERE total > n_entity AND log2(total * n_both::DOUBLE / (n_entity * n_term::DOUBLE)) >= {s.SHARE} * log2(total / n_entity) - 1e-9),
hits AS (SELECT DISTINCT rid, term FROM near JOIN told USING (entity, term)),
names AS (SELECT rid, kind, rank, start, kind || ':' || start || ':' || stop AS s FROM base UNION ALL SELECT rid, 'term', {len(s.KINDS)}, a, 'term:' || a || ':' || z FROM outside JOIN hits USING (rid, term)),
g AS (SELECT rid, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in s.KINDS)},
      string_agg(s, ',' ORDER BY start, rank) FILTER (kind <> 'term') AS b, string_agg(s, ',' ORDER BY start, rank) AS e FROM names GROUP BY rid)
SELECT doc_id, {', '.join(f'CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}' for k in s.KINDS)}, sha256(coalesce(b, '')) AS base_sha256, coalesce(e, '') AS spans FROM d LEFT JOIN g USING (rid)
"""


@query("op12_personal", _sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    found = s.find_personal(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "term")
    return found.select(F.col("doc").alias("doc_id"), *map(count, s.KINDS), F.sha2(s.written(base), 256).alias("base_sha256"), s.written(F.col("spans")).alias("spans"))
