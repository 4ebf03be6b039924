"""Query of the structure repair: conversations are damaged by a rule, then repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .sql_parts import CRC, crc32
from .structure import repair_structure, summaries


def damaged(turns: DataFrame) -> DataFrame:
    """Turns of ``conversations``, nulls as one space, a fifth part of them dropped or harmed by a checksum of their place."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    d = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("k")).where("k <> 0")
    harmed = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    d = d.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), harmed.alias("text"), F.when(F.col("k") == 3, 2).otherwise(1).alias("times"))
    return d.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("times")


def _least(options: list[str]) -> str:
    return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"


def _kept(q: int) -> str:
    """What may be done with a turn in a state, as the least of (cost, edits, text) with what follows."""
    user, assistant = 2, 3
    keep = {0: (("s", 1), ("u", user)), 1: (("u", user),), 2: (("a", assistant),), 3: (("u", user),)}[q]
    chosen = assistant if q == user else user
    name = "assistant" if q == user else "user"
    options = [f"{{'c': 2 + g{q}.c, 'a': 'D' || g{q}.a, 't': g{q}.t}}"]
    options += [f"CASE WHEN NOT must AND initial = '{r}' THEN {{'c': stays + g{n}.c, 'a': 'K' || g{n}.a, 't': chr(10) || role || ':' || text || g{n}.t}} END" for r, n in keep]
    options += [f"CASE WHEN NOT must THEN {{'c': 1 + stays + g{chosen}.c, 'a': 'R' || g{chosen}.a, 't': chr(10) || '{name}:' || text || g{chosen}.t}} END"]
    return _least(options)


def _put(q: int) -> str:
    """The same with up to two empty turns before it."""
    one = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    name, n = one[q]
    more, m = one[n]
    return _least([f"b{q}", f"{{'c': 5 + b{n}.c, 'a': 'I' || b{n}.a, 't': chr(10) || '{name}:' || b{n}.t}}",
                   f"{{'c': 10 + b{m}.c, 'a': 'II' || b{m}.a, 't': chr(10) || '{name}:' || chr(10) || '{more}:' || b{m}.t}}"])


_SQL = f"""
WITH RECURSIVE {CRC},
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
summed AS (SELECT conv_id, turn, role, text, {crc32("key")} % 20 AS k FROM keyed, crc_tab),
harmed AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM summed),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text), copy) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM harmed),
faults AS (SELECT *, left(role, 1) AS initial, left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS earlier,
           CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM numbered),
marked AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS stays FROM faults),
walk AS (SELECT conv_id, n AS i, {{'c': 0, 'a': '', 't': ''}} AS g0, {{'c': 10, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS g1,
                {{'c': 5, 'a': 'I', 't': chr(10) || 'assistant:'}} AS g2, {{'c': 0, 'a': '', 't': ''}} AS g3 FROM (SELECT DISTINCT conv_id, n FROM numbered)
         UNION ALL SELECT conv_id, i - 1, {_put(0)}, {_put(1)}, {_put(2)}, {_put(3)} FROM
           (SELECT w.conv_id, w.i, {', '.join(f'{_kept(q)} AS b{q}' for q in range(4))} FROM walk w JOIN marked m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND w.i = m.i)),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(g0.c, 0) AS BIGINT) AS cost, coalesce(g0.a, '') AS audit, sha256(coalesce(substr(g0.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN (SELECT * FROM walk WHERE i = 0) w ON e.conv_id IS NOT DISTINCT FROM w.conv_id
"""


@query("op11_structure", _SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    found = summaries(repair_structure(damaged(turns))).withColumnRenamed("conv", "_conv")
    every = turns.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").cast("string").eqNullSafe(F.col("_conv")), "left")
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
