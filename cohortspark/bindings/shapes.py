"""How the test tables stand in for slides, records and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import Tables

BOX = {"F": "far_label", "O": "near_label", "P": "both"}
ARM = {"AUTOMOBILE": "a", "BUILDING": "a", "FURNITURE": "b", "MACHINERY": "b"}


def sections(t: Tables) -> DataFrame:
    """A section is a distinct line of an order; its price is the stage coordinate."""
    return t.lineitem.groupBy(F.col("l_orderkey").alias("slide"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("section_label")).agg(
        F.min("l_extendedprice").alias("x"))


SECTIONS = """sec AS (SELECT l_orderkey AS slide, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS section_label,
  min(l_extendedprice) AS x FROM lineitem GROUP BY 1, 2)"""


def record(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_orderkey").alias("slide"), F.col("o_custkey").alias("animal"),
        F.when(status == "F", "far_label").when(status == "O", "near_label").when(status == "P", "both").alias("positive_box"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.col("o_orderpriority")).otherwise("").alias("needs_confirmation"),
    )


RECORD = """rec AS (SELECT o_orderkey AS slide, o_custkey AS animal,
  CASE o_orderstatus WHEN 'F' THEN 'far_label' WHEN 'O' THEN 'near_label' WHEN 'P' THEN 'both' END AS positive_box,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderpriority ELSE '' END AS needs_confirmation FROM orders)"""


def scans(t: Tables) -> DataFrame:
    """Original and rescan sections: status F and O of the same order."""
    return t.lineitem.groupBy(
        F.col("l_orderkey").alias("slide"),
        F.when(F.col("l_linestatus") == "F", "original").otherwise("rescan").alias("scan"),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("section_label"),
    ).agg(F.min("l_extendedprice").alias("x"), F.max("l_returnflag").alias("flag"), F.sum("l_quantity").alias("qty"))


SCANS = """scn AS (SELECT l_orderkey AS slide, CASE WHEN l_linestatus = 'F' THEN 'original' ELSE 'rescan' END AS scan,
  lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS section_label, min(l_extendedprice) AS x,
  max(l_returnflag) AS flag, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2, 3)"""


def gap_sql(source: str, key: str = "slide", out: str = "gp") -> str:
    """SQL for the widest gap of every group of ``source(key, x)``."""
    return f"""{out}_p AS (SELECT {key}, x, count(*) AS c FROM {source} GROUP BY 1, 2),
{out}_g AS (SELECT {key}, x, c, lag(x) OVER (PARTITION BY {key} ORDER BY x) AS lo,
  x - lag(x) OVER (PARTITION BY {key} ORDER BY x) AS gap,
  sum(c) OVER (PARTITION BY {key} ORDER BY x) - c AS below, sum(c) OVER (PARTITION BY {key}) AS n FROM {out}_p),
{out}_r AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY gap DESC NULLS LAST, x) AS rn FROM {out}_g),
{out} AS (SELECT {key}, CAST(max(n) AS BIGINT) AS n, CAST(max(CASE WHEN rn = 1 THEN below END) AS BIGINT) AS n_low,
  max(CASE WHEN rn = 1 THEN lo END) AS split_lo, max(CASE WHEN rn = 1 AND gap IS NOT NULL THEN x END) AS split_hi,
  max(CASE WHEN rn = 1 THEN gap END) AS split_gap, max(CASE WHEN rn = 2 THEN gap END) AS other_gap
  FROM {out}_r GROUP BY {key})"""


def split_sql(gap: str = "gp", key: str = "slide", out: str = "spl") -> str:
    return f"""{out} AS (SELECT {key}, n, n_low, n - n_low AS n_high, split_lo, split_gap, other_gap,
  split_gap / nullif(other_gap, 0) AS gap_ratio,
  CASE WHEN n < 3 THEN 'too_few' WHEN split_gap IS NULL THEN 'ambiguous'
       WHEN NOT ((n_low = 2 AND n - n_low IN (1, 2)) OR (n_low = 1 AND n - n_low = 2)) THEN 'bad_shape'
       WHEN split_gap / nullif(other_gap, 0) < 1.3 THEN 'ambiguous' ELSE 'ok' END AS status FROM {gap})"""


SIDES = f"""{SECTIONS}, {RECORD}, {gap_sql('sec')}, {split_sql()},
box AS (SELECT sec.slide, section_label, x, status, gap_ratio,
  CASE WHEN status = 'ok' THEN CASE WHEN x <= split_lo THEN 'near_label' ELSE 'far_label' END END AS box
  FROM sec JOIN spl USING (slide)),
cond AS (SELECT b.slide, b.section_label, b.x, b.box, b.gap_ratio, r.animal, r.positive_box,
  CASE WHEN r.slide IS NULL THEN 'no record'
       WHEN r.needs_confirmation <> '' THEN 'needs confirmation: ' || r.needs_confirmation
       WHEN coalesce(r.positive_box, '') NOT IN ('near_label', 'far_label', 'both') THEN 'positive box is ' || coalesce(r.positive_box, '')
       WHEN r.positive_box <> 'both' AND b.status <> 'ok' THEN 'no box could be derived' ELSE '' END AS reason,
  CASE WHEN r.slide IS NULL OR r.needs_confirmation <> '' OR coalesce(r.positive_box, '') NOT IN ('near_label', 'far_label', 'both') THEN 'unresolved'
       WHEN r.positive_box = 'both' THEN 'positive' WHEN b.status <> 'ok' THEN 'unresolved'
       WHEN b.box = r.positive_box THEN 'positive' ELSE 'negative' END AS condition
  FROM box b LEFT JOIN rec r USING (slide))"""
