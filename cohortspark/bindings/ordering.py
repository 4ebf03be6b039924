"""Ranks, replicates, sorts, group limits and set operations on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sets as G
from ..operators import stats as T
from ..operators.blinding import replicate_index
from ..operators.skew import mid_ranks
from .registry import query, rnd
from .shapes import SCANS, scans


@query("e03_replicate_index", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY sha256(l_partkey || '|' || l_suppkey || '|' || l_quantity || '|' || l_extendedprice)) AS replicate FROM lineitem""")
def _replicate(t):
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return replicate_index(t.lineitem.select(*cols), ["l_orderkey", "l_linenumber"])


@query("e04_mid_ranks", """SELECT o_totalprice, count(*) AS n, CAST(min(r) + (count(*) - 1) / 2.0 AS DOUBLE) AS mid_rank
FROM (SELECT o_totalprice, rank() OVER (ORDER BY o_totalprice) AS r FROM orders) GROUP BY 1""")
def _ranks(t):
    return mid_ranks(t.orders, [], "o_totalprice").select("o_totalprice", F.col("_cnt").alias("n"), "mid_rank")


@query("e04_spearman", """WITH r AS (SELECT rank() OVER (ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_custkey) - 1) / 2.0::DOUBLE AS a,
  rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0::DOUBLE AS b FROM orders)
SELECT count(*) AS n, round(corr(a, b), 8) AS rho FROM r""")
def _spearman(t):
    return T.spearman(t.orders, "o_custkey", "o_totalprice").withColumn("rho", rnd(F.col("rho"), 8))


@query("e04_spearman_by_group", """WITH r AS (SELECT o_orderpriority AS g, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_orderpriority, o_custkey) - 1) / 2.0::DOUBLE AS a,
  rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2.0::DOUBLE AS b FROM orders)
SELECT g AS o_orderpriority, count(*) AS n, round(corr(a, b), 8) AS rho FROM r GROUP BY 1""")
def _spearman_by(t):
    return T.spearman(t.orders, "o_custkey", "o_totalprice", ["o_orderpriority"]).withColumn("rho", rnd(F.col("rho"), 8))


@query("e05_adjacent_equal", """SELECT count(*) AS n, count(*) FILTER (c_mktsegment = p) AS n_adjacent FROM (
  SELECT c_mktsegment, lag(c_mktsegment) OVER (ORDER BY c_custkey) AS p FROM customer)""")
def _adjacent(t):
    return T.adjacent_equal(t.customer, "c_custkey", "c_mktsegment")


@query("f01_canonical_sort", f"WITH {SCANS} SELECT * FROM scn ORDER BY slide, scan, section_label")
def _sort(t):
    return scans(t).orderBy("slide", "scan", "section_label")


@query("f03_first_groups", f"WITH {SCANS} SELECT * FROM scn WHERE (slide, scan) IN (SELECT DISTINCT ON (slide, scan) (slide, scan) FROM scn ORDER BY slide, scan LIMIT 40)")
def _first_groups(t):
    return G.first_groups(scans(t), ["slide", "scan"], 40)


@query("g01_union_scans", """SELECT l_orderkey, l_extendedprice, l_tax, NULL AS l_discount FROM lineitem WHERE l_linestatus = 'F'
UNION ALL SELECT l_orderkey, l_extendedprice, NULL, l_discount FROM lineitem WHERE l_linestatus = 'O'""")
def _union(t):
    return G.union_scans(t.lineitem.where("l_linestatus = 'F'").select("l_orderkey", "l_extendedprice", "l_tax"),
                         t.lineitem.where("l_linestatus = 'O'").select("l_orderkey", "l_extendedprice", "l_discount"))


@query("g02_inventory_difference", """SELECT l_partkey AS id, 'unexpected' AS finding FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45) WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)
UNION ALL SELECT p_partkey, 'missing' FROM part WHERE p_size < 5 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)""")
def _difference(t):
    ids = lambda d, c: d.select(F.col(c).alias("id"))
    return G.inventory_difference(ids(t.lineitem.where("l_quantity > 45"), "l_partkey"), ids(t.part.where("p_size < 40"), "p_partkey"), "id",
                                  ids(t.part.where("p_size < 5"), "p_partkey"))


def _partition_sql(a, b, source):
    return f"""WITH p AS (SELECT DISTINCT {a} AS a, {b} AS b FROM {source}), x AS (SELECT count(*) AS cells, max(n) AS w FROM (SELECT count(*) AS n FROM p GROUP BY a)),
y AS (SELECT count(*) AS cells, max(n) AS w FROM (SELECT count(*) AS n FROM p GROUP BY b))
SELECT x.cells AS n_cells_a, y.cells AS n_cells_b, x.w = 1 AS refines, x.w = 1 AND y.w = 1 AS "equal" FROM x, y"""


@query("g03_partition_refines", _partition_sql("o_custkey % 6", "o_custkey % 3", "orders"))
def _refines(t):
    d = t.orders.select((F.col("o_custkey") % 6).alias("a"), (F.col("o_custkey") % 3).alias("b"))
    return G.partition_relation(d, "a", "b")


@query("g03_partition_mixed", _partition_sql("c_mktsegment", "c_nationkey", "customer"))
def _mixed(t):
    return G.partition_relation(t.customer, "c_mktsegment", "c_nationkey")
