"""Pseudonyms, the private/blinded split and every audit on customers and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import blinding as B
from ..operators.conditions import attach_codes
from .registry import query, rnd

SEED = "a long test-only seed 7q"
WIDTH = 6
_STEP, _SHIFT = B.pool_step(SEED, B.LETTERS * 10**WIDTH)


def _label_sql(pos: str) -> str:
    i = f"(({pos}) * {_STEP} + {_SHIFT}) % {B.LETTERS * 10**WIDTH}"
    return f"chr(CAST(65 + ({i}) % 26 AS INTEGER)) || '0' || lpad(CAST(({i}) // 26 AS VARCHAR), {WIDTH}, '0')"


CODES = f"""codes AS (SELECT c_custkey AS tube_id, {_label_sql(f"row_number() OVER (ORDER BY sha256('{SEED}:' || c_custkey)) - 1")} AS code,
  c_mktsegment AS "group" FROM customer)"""


def _codes(t):
    ids = t.customer.select(F.col("c_custkey").alias("tube_id"))
    groups = t.customer.select(F.col("c_custkey").alias("tube_id"), F.col("c_mktsegment").alias("group"))
    return B.assign_codes(ids, "tube_id", SEED, width=WIDTH).join(groups, "tube_id")


@query("h01_seeded_codes", f"WITH {CODES} SELECT tube_id, code FROM codes")
def _assign(t):
    return _codes(t).select("tube_id", "code")


@query("h02_extend_codes", f"""WITH old AS (SELECT c_custkey AS tube_id, {_label_sql(f"row_number() OVER (ORDER BY sha256('{SEED}:' || c_custkey)) - 1")} AS code FROM customer WHERE c_custkey % 3 <> 0),
fresh AS (SELECT c_custkey AS tube_id, row_number() OVER (ORDER BY sha256('{SEED}:' || c_custkey)) AS k FROM customer WHERE c_custkey % 3 = 0),
walk AS (SELECT i, {_label_sql('i')} AS code FROM range((SELECT count(*) FROM customer)) r(i)),
free AS (SELECT code, row_number() OVER (ORDER BY i) AS k FROM walk WHERE code NOT IN (SELECT code FROM old))
SELECT tube_id, code FROM old UNION ALL SELECT tube_id, code FROM fresh JOIN free USING (k)""")
def _extend(t):
    ids = t.customer.select(F.col("c_custkey").alias("tube_id"))
    old = B.assign_codes(ids.where("tube_id % 3 <> 0"), "tube_id", SEED, width=WIDTH)
    return B.extend_codes(old, ids, "tube_id", SEED, width=WIDTH)


@query("c08_attach_codes", f"WITH {CODES} SELECT o_orderkey, code FROM orders JOIN codes ON o_custkey = tube_id")
def _attach(t):
    return attach_codes(t.orders.select("o_orderkey", F.col("o_custkey").alias("tube_id")), _codes(t).select("tube_id", "code"), "tube_id")[0].select("o_orderkey", "code")


@query("c08_missing_codes", "SELECT DISTINCT o_custkey AS tube_id FROM orders WHERE o_custkey % 3 = 0")
def _missing(t):
    codes = _codes(t).where("tube_id % 3 <> 0").select("tube_id", "code")
    return attach_codes(t.orders.select(F.col("o_custkey").alias("tube_id")), codes, "tube_id")[1]


def _rows(t):
    """Orders as coded section rows of the private table."""
    k = F.col("o_orderkey")
    return t.orders.select(
        F.col("o_custkey").alias("tube_id"), F.lit("section").alias("row_kind"), F.format_string("%02d", k % 4 + 1).alias("section_label"),
        F.when(F.col("o_orderstatus") == "F", "positive").otherwise("negative").alias("condition"), (10002 + 3 * (k % 4)).alias("stack_id"),
        F.when(F.col("o_orderstatus") == "O", "near_label").otherwise("far_label").alias("box"), (F.lit(0.325) + (k % 100) / 1e7).alias("pixel_size_um"),
        F.col("o_orderdate").cast("string").alias("acquisition_time"), F.when(k % 50 == 0, "maybe").otherwise("").alias("needs_confirmation"),
        (k % 3 != 0).alias("scan_is_preferred"), F.col("o_orderpriority").alias("channel"))


ROWS = """rws AS (SELECT o_custkey AS tube_id, 'section' AS row_kind, '0' || (o_orderkey % 4 + 1) AS section_label, CASE WHEN o_orderstatus = 'F' THEN 'positive' ELSE 'negative' END AS condition,
  10002 + 3 * (o_orderkey % 4) AS stack_id, CASE WHEN o_orderstatus = 'O' THEN 'near_label' ELSE 'far_label' END AS box, round(0.325::DOUBLE + (o_orderkey % 100) / 1e7, 4) AS pixel_size_um,
  o_orderkey % 3 <> 0 AS preferred, o_orderkey % 50 = 0 AS flagged, o_orderpriority AS channel FROM orders)"""
BLINDED = f"""{CODES}, {ROWS}, bl AS (SELECT code, row_kind, section_label, condition, stack_id, box, pixel_size_um, channel, row_number() OVER (PARTITION BY code, section_label
  ORDER BY sha256(row_kind || '|' || condition || '|' || stack_id || '|' || box || '|' || pixel_size_um || '|' || channel)) AS replicate FROM rws JOIN codes USING (tube_id) WHERE preferred AND NOT flagged)"""


def _blinded(t):
    return B.split_private_blinded(_rows(t).where("needs_confirmation = ''"), _codes(t).select("tube_id", "code"), "tube_id", preferred_only=True)[1]


@query("h03_private_blinded_split", f"WITH {BLINDED} SELECT * FROM bl")
def _split(t):
    return _blinded(t)


@query("h03_unresolved_gate", f"WITH {ROWS} SELECT tube_id, section_label, condition FROM rws WHERE flagged")
def _gate(t):
    return B.unresolved_rows(_rows(t)).select("tube_id", "section_label", "condition")


@query("f02_order_destroyed", f"WITH {BLINDED} SELECT code, section_label, replicate, condition FROM bl ORDER BY code, section_label, replicate")
def _order(t):
    return B.destroy_order(_blinded(t).select("code", "section_label", "replicate", "condition"))


def _leaky(t):
    """The blinded table with an id, a group word, a path and a renamed code planted."""
    d = _rows(t).join(_codes(t), "tube_id").where("scan_is_preferred")
    k = F.col("tube_id")
    return d.select(
        F.when(k == 7, "Z0999999").otherwise(F.col("code")).alias("code"), "section_label", "condition", "box", "pixel_size_um",
        F.concat(F.lit("K0"), k.cast("string"), F.lit(" from "), k.cast("string"), F.lit(" at 2026-07-18T23:30:42")).alias("remark"),
        F.when(k % 2 == 0, F.lower("group")).otherwise("no negative control").alias("marker"),
        F.concat(F.lit("/raw/"), F.col("channel")).alias("region"), F.col("acquisition_time"))


@query("h04_audit_structure", """SELECT 'LEAK' AS severity, 'unknown_code' AS "check", 'code' AS "column", '1' AS detail WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = 7 AND o_orderkey % 3 <> 0)
UNION ALL SELECT 'LEAK', 'shared_code', 'code', CAST(count(*) AS VARCHAR) FROM (SELECT min(c_custkey) FROM customer GROUP BY c_custkey // 100 HAVING count(*) > 1)
UNION ALL SELECT 'LEAK', 'denied_name', 'acquisition_time', 'acquisition'""")
def _structure(t):
    codes = _codes(t)
    same = codes.select("tube_id", F.concat(F.lit("S"), F.floor(F.col("tube_id") / 100).cast("string")).alias("code"))
    whole = A.audit_structure(_leaky(t), codes).where("check <> 'shared_code'")
    return whole.unionByName(A.audit_structure(same, same).where("check = 'shared_code'"))


@query("h05_audit_ids", """SELECT 'LEAK' AS severity, 'id_value' AS "check", 'remark' AS "column", CAST(count(DISTINCT o_custkey) AS VARCHAR) AS detail FROM orders WHERE o_orderkey % 3 <> 0
UNION ALL SELECT 'LEAK', 'id_value', 'region', CAST(count(DISTINCT substr(o_orderpriority, 1, 1)) AS VARCHAR) FROM orders WHERE o_orderkey % 3 <> 0""")
def _ids(t):
    return A.audit_ids(_leaky(t).drop("acquisition_time"), t.customer.select(F.col("c_custkey").alias("tube_id")), "tube_id")


@query("h06_audit_terms", """SELECT DISTINCT 'LEAK' AS severity, 'term' AS "check", 'marker' AS "column", lower(c_mktsegment) AS detail FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_custkey % 2 = 0 AND o_orderkey % 3 <> 0
UNION ALL SELECT 'LEAK', 'path', 'region', CAST(count(*) AS VARCHAR) FROM orders WHERE o_orderkey % 3 <> 0""")
def _terms(t):
    vocabulary = A.group_vocabulary(t.customer, ["c_mktsegment"])
    return A.audit_terms(_leaky(t).select("code", "section_label", "condition", "box", "marker", "region"), vocabulary)


N_PERM = 200
STATS = f"""{CODES}, pl AS (SELECT tube_id, "group" AS g, row_number() OVER (ORDER BY tube_id) - 1 AS rid, row_number() OVER (ORDER BY code) - 1 AS rcode FROM codes),
n AS (SELECT count(*)::DOUBLE AS n FROM pl),
obs AS (SELECT corr(rid, rcode) AS rho FROM pl), oadj AS (SELECT count(*) FILTER (g = p) AS adj FROM (SELECT g, lag(g) OVER (ORDER BY rcode) AS p FROM pl)),
sh AS (SELECT rep, rid, g, row_number() OVER (PARTITION BY rep ORDER BY sha256('audit:' || rep || '-' || tube_id)) - 1 AS pos FROM pl, range(1, {N_PERM + 1}) r(rep)),
adjr AS (SELECT rep, count(*) FILTER (g = p) AS adj_r FROM (SELECT rep, g, lag(g) OVER (PARTITION BY rep ORDER BY pos) AS p FROM sh) GROUP BY 1),
rhor AS (SELECT rep, corr(rid, pos) AS rho_r FROM sh GROUP BY 1),
st AS (SELECT CAST((SELECT n FROM n) AS BIGINT) AS n, any_value(rho) AS rho, any_value(adj) AS n_adjacent, (1 + count(*) FILTER (abs(rho_r) >= abs(rho) - 1e-12::DOUBLE)) / {N_PERM + 1}.0::DOUBLE AS p_rho,
  avg(adj_r) AS adjacent_null_mean, (1 + count(*) FILTER (adj_r >= adj)) / {N_PERM + 1}.0::DOUBLE AS p_upper, (1 + count(*) FILTER (adj_r <= adj)) / {N_PERM + 1}.0::DOUBLE AS p_lower
  FROM rhor JOIN adjr USING (rep), obs, oadj)"""


@query("h07_h08_order_statistics", f"""WITH {STATS} SELECT n, round(rho, 8) AS rho, n_adjacent, round(p_rho, 6) AS p_rho, round(adjacent_null_mean, 6) AS adjacent_null_mean, round(p_upper, 6) AS p_upper, round(p_lower, 6) AS p_lower FROM st""")
def _order_stats(t):
    s = A.order_statistics(_codes(t), "tube_id", "code", "group", n_perm=N_PERM)
    return s.select("n", rnd(F.col("rho"), 8).alias("rho"), "n_adjacent", *[rnd(F.col(c)).alias(c) for c in ("p_rho", "adjacent_null_mean", "p_upper", "p_lower")])


@query("h07_audit_order_planted", """SELECT 'LEAK' AS severity, 'code_order' AS "check", 'code' AS "column", '1.0' AS detail""")
def _order_planted(t):
    d = t.customer.select(F.col("c_custkey").alias("tube_id"), F.concat(F.lit("Q"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias("code"), F.col("c_mktsegment").alias("group"))
    return A.audit_order(A.order_statistics(d, "tube_id", "code", "group", n_perm=N_PERM)).where("check = 'code_order'")


@query("h09_audit_row_order", """WITH r AS (SELECT corr(c_custkey, c_custkey // 10 * 10 + (c_custkey * 7) % 10) AS rho FROM customer) SELECT 'LEAK' AS severity, 'row_order' AS "check", 'row_no' AS "column" FROM r WHERE abs(rho) >= 0.5""")
def _row_order(t):
    rows = t.customer.select(F.col("c_custkey").alias("tube_id"), (F.floor(F.col("c_custkey") / 10) * 10 + (F.col("c_custkey") * 7) % 10).alias("row_no"))
    return A.audit_row_order(rows, "row_no", "tube_id").drop("detail")


def _columns_table(t):
    """Blinded columns of every kind: constant, one-to-one, the group itself, a refinement
    of it, monotone in the id, with rare values, and harmless."""
    c = t.customer.join(_codes(t).select(F.col("tube_id").alias("c_custkey"), "code", "group"), "c_custkey")
    k = F.col("c_custkey")
    d = c.select(
        "code", F.lit("section").alias("row_kind"), F.concat(F.lit("x"), F.sha2(k.cast("string"), 256)).alias("region"), F.col("group").alias("marker"),
        F.concat("group", (k % 3).cast("string")).alias("box"), F.floor(k / 50).alias("series_index"), F.when(k == 5, "odd").otherwise((k % 2).cast("string")).alias("channel"),
        (k % 4).cast("string").alias("condition"))
    return d.unionByName(d.where("condition = '1'").withColumn("condition", F.lit("9")))


@query("h10_column_statistics", f"""WITH {CODES}, c AS (SELECT *, tube_id AS k FROM codes),
base AS (SELECT code, k, "group" AS g, 'section' AS row_kind, 'x' || sha256(CAST(k AS VARCHAR)) AS region, "group" AS marker, "group" || k % 3 AS box, CAST(k // 50 AS VARCHAR) AS series_index,
  CASE WHEN k = 5 THEN 'odd' ELSE CAST(k % 2 AS VARCHAR) END AS channel, CASE WHEN k % 4 = 1 THEN '1|9' ELSE CAST(k % 4 AS VARCHAR) END AS condition FROM c),
sig AS (SELECT * FROM (SELECT code, k, g, row_kind, region, marker, box, series_index, channel, condition FROM base) UNPIVOT (signature FOR "column" IN (row_kind, region, marker, box, series_index, channel, condition))),
num AS (SELECT "column", bool_and(TRY_CAST(signature AS DOUBLE) IS NOT NULL) AS numeric, count(DISTINCT TRY_CAST(signature AS DOUBLE)) AS nn FROM sig GROUP BY 1),
cel AS (SELECT "column", signature, count(*) AS n, count(DISTINCT g) AS groups FROM sig GROUP BY 1, 2),
per AS (SELECT "column", count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS n_entities, max(groups) = 1 AS pure, count(*) FILTER (n <= 2) AS n_rare FROM cel GROUP BY 1),
ng AS (SELECT "column", count(DISTINCT g) AS n_groups FROM sig GROUP BY 1),
v AS (SELECT sig."column", k, CASE WHEN numeric THEN TRY_CAST(signature AS DOUBLE) END AS x, CASE WHEN numeric THEN '' ELSE signature END AS s FROM sig JOIN num USING ("column")),
rk AS (SELECT "column", rank() OVER (PARTITION BY "column" ORDER BY k) AS a, rank() OVER (PARTITION BY "column" ORDER BY x, s) + (count(*) OVER (PARTITION BY "column", x, s) - 1) / 2.0::DOUBLE AS b FROM v),
rho AS (SELECT "column", round(corr(a, b), 8) AS rho FROM rk GROUP BY 1)
SELECT "column", n_cells, n_entities, n_groups, pure, n_rare, CASE WHEN CASE WHEN numeric THEN nn ELSE n_cells END >= 3 THEN rho + 0.0::DOUBLE END AS rho FROM per JOIN ng USING ("column") JOIN num USING ("column") JOIN rho USING ("column")""")
def _column_stats(t):
    return A.column_statistics(_columns_table(t), _codes(t), "tube_id", "group").withColumn("rho", rnd(F.col("rho"), 8))


@query("h10_audit_columns", """SELECT 'LEAK' AS severity, 'one_to_one' AS "check", 'region' AS "column", CAST(count(*) AS VARCHAR) AS detail FROM customer
UNION ALL SELECT 'LEAK', 'recovers_groups', 'marker', CAST(count(DISTINCT c_mktsegment) AS VARCHAR) FROM customer
UNION ALL SELECT 'LEAK', 'group_pure', 'box', CAST(count(DISTINCT c_mktsegment || c_custkey % 3) AS VARCHAR) FROM customer
UNION ALL SELECT 'LEAK', 'monotone_in_id', 'series_index', CAST(count(DISTINCT c_custkey // 50) AS VARCHAR) FROM customer
UNION ALL SELECT 'RISK', 'rare_values', 'channel', '1'""")
def _columns(t):
    return A.audit_columns(A.column_statistics(_columns_table(t), _codes(t), "tube_id", "group"))


@query("h11_audit_duplicates", """SELECT 'RISK' AS severity, 'duplicates_unaddressable' AS "check", 'section_label' AS "column", CAST(count(DISTINCT o_custkey) AS VARCHAR) AS detail
FROM (SELECT o_custkey FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 50 <> 0 GROUP BY o_custkey, o_orderkey % 4 HAVING count(*) > 1)""")
def _duplicates(t):
    return A.audit_duplicates(_blinded(t).drop("replicate"))


@query("h12_joint_statistics", f"""WITH {BLINDED}, sg AS (SELECT code, string_agg(DISTINCT concat_ws('|', section_label, condition, box, channel), '#' ORDER BY concat_ws('|', section_label, condition, box, channel)) AS s FROM bl GROUP BY 1),
c AS (SELECT count(*) AS n FROM sg GROUP BY s) SELECT CAST(sum(n) AS BIGINT) AS n_entities, count(*) AS n_cells, CAST(coalesce(sum(n) FILTER (n <= 2), 0) AS BIGINT) AS n_singled FROM c""")
def _joint(t):
    return A.joint_statistics(_blinded(t).select("code", "section_label", "condition", "box", "channel"))


@query("h13_audit_codes", """SELECT 'RISK' AS severity, 'code_contains_id' AS "check", 'code' AS "column", CAST(count(*) AS VARCHAR) AS detail FROM customer WHERE contains('K' || CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey // 2 END, CAST(c_custkey AS VARCHAR))
UNION ALL SELECT 'RISK', 'tails_equal_ids', 'code', CAST(count(*) AS VARCHAR) FROM customer WHERE CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey // 2 END = c_custkey
UNION ALL SELECT 'LEAK', 'code_format', 'code', CAST(count(*) AS VARCHAR) FROM customer WHERE c_custkey % 100 = 0
UNION ALL SELECT 'RISK', 'outside_roster', 'code', CAST(count(*) AS VARCHAR) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 'LEAK', 'duplicate_code', 'code', CAST(count(*) AS VARCHAR) FROM (SELECT 1 FROM customer GROUP BY 'K' || CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey // 2 END || CASE WHEN c_custkey % 100 = 0 THEN '!' ELSE '' END HAVING count(*) > 1)""")
def _audit_codes(t):
    k = F.col("c_custkey")
    tail = F.when(k % 2 == 0, k).otherwise(F.floor(k / 2)).cast("string")
    codes = t.customer.select(k.alias("tube_id"), F.concat(F.lit("K"), tail, F.when(k % 100 == 0, "!").otherwise("")).alias("code"))
    roster = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("tube_id"))
    return A.audit_codes(codes, "tube_id", "code", roster)


@query("blind_audit_report")
def _report(t):
    return A.audit_blinded(_blinded(t), _codes(t), "tube_id", "group", n_perm=N_PERM)
