"""Counts, tile accounting and validation rules on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as U
from ..operators import summarise as S
from ..operators import tiles as L
from .registry import query, rnd
from .shapes import SIDES, record, sections
from ..plans.manifest import section_conditions


@query("d01_rollup_counts", """SELECT o_custkey, count(*) AS n_rows, count(*) FILTER (o_orderstatus = 'F') AS n_positive, count(*) FILTER (o_orderstatus = 'O') AS n_negative,
  count(DISTINCT o_orderpriority) AS n_distinct FROM orders GROUP BY 1""")
def _counts(t):
    return S.rollup_counts(t.orders, ["o_custkey"], {"n_positive": F.col("o_orderstatus") == "F", "n_negative": F.col("o_orderstatus") == "O"}, F.col("o_orderpriority"))


@query("d02_entity_flag", """WITH o AS (SELECT o_orderkey, o_custkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'negative' WHEN '2-HIGH' THEN 'positive' ELSE 'unresolved' END AS condition FROM orders)
SELECT o_orderkey, o_custkey, condition, CASE WHEN bool_or(condition <> 'unresolved') OVER w THEN bool_or(condition = 'negative') OVER w END AS has_negative_control FROM o WINDOW w AS (PARTITION BY o_custkey)""")
def _flag(t):
    c = F.when(F.col("o_orderpriority") == "1-URGENT", "negative").when(F.col("o_orderpriority") == "2-HIGH", "positive").otherwise("unresolved")
    return S.entity_flag(t.orders.select("o_orderkey", "o_custkey", c.alias("condition")), "o_custkey")


@query("d03_slide_summary", f"""WITH {SIDES} SELECT slide, count(*) AS n_sections,
  coalesce(string_agg(CASE WHEN condition = 'positive' THEN section_label END, ',' ORDER BY section_label), '') AS positive_labels,
  coalesce(string_agg(CASE WHEN condition = 'negative' THEN section_label END, ',' ORDER BY section_label), '') AS negative_labels,
  coalesce(string_agg(CASE WHEN condition = 'unresolved' THEN section_label END, ',' ORDER BY section_label), '') AS unresolved_labels,
  count(*) FILTER (condition = 'unresolved') AS n_unresolved,
  CASE WHEN bool_and(x > 20000) THEN 'yes' WHEN bool_or(x > 20000) THEN 'part' ELSE 'index' END AS payload,
  CASE WHEN bool_and(x < 60000) THEN 'std' ELSE 'NON' END AS exposure FROM cond GROUP BY slide""")
def _summary(t):
    d = section_conditions(sections(t), record(t)).withColumns({"has_pixels": F.col("x") > 20000, "std": F.col("x") < 60000})
    return S.slide_summary(d, ["slide"], "has_pixels", "std")


@query("d04_modal_tuple", """SELECT round(l_discount, 4) AS l_discount, round(l_tax, 4) AS l_tax, count(*) AS n FROM lineitem GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 1""")
def _modal(t):
    return S.modal_tuple(t.lineitem, ["l_discount", "l_tax"])


@query("d04_standard_flag", """WITH m AS (SELECT p_size AS a, p_retailprice AS b FROM part GROUP BY 1, 2 ORDER BY count(*) DESC, 1, 2 LIMIT 1)
SELECT p_partkey, abs(p_size - a) <= 0.5::DOUBLE * greatest(abs(p_size), abs(a)) AND abs(p_retailprice - b) <= 0.5::DOUBLE * greatest(abs(p_retailprice), abs(b)) AS exposure_is_standard FROM part, m""")
def _standard(t):
    from ..operators.blinding import standard_flag
    return standard_flag(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"], 0.5).select("p_partkey", "exposure_is_standard")


@query("d05_consistent_tuple", """SELECT l_partkey, count(*) AS n_records, count(DISTINCT (l_discount, l_tax)) AS n_distinct, count(DISTINCT (l_discount, l_tax)) = 1 AS consistent FROM lineitem GROUP BY 1""")
def _consistent(t):
    return S.consistent_tuple(t.lineitem, ["l_partkey"], ["l_discount", "l_tax"])


def _tiles(t):
    """Lines as tiles of three containers; one container holds a third of the rows."""
    q = F.col("l_quantity").cast("bigint")
    return t.lineitem.select(
        F.col("l_returnflag").alias("container"), (F.col("l_partkey") % 32).alias("col"), (F.col("l_suppkey") % 32).alias("row"),
        (F.col("l_linenumber") % 3).cast("bigint").alias("channel"), (q % 4).alias("level"), F.col("l_orderkey").alias("offset"), q.alias("nbytes"),
        F.lit(14000).cast("bigint").alias("file_bytes"), (F.col("l_linenumber") + 1).alias("pixel_type"))


TILES = """til AS (SELECT l_returnflag AS container, l_partkey % 32 AS col, l_suppkey % 32 AS row, CAST(l_linenumber % 3 AS BIGINT) AS channel,
  CAST(l_quantity AS BIGINT) % 4 AS level, l_orderkey AS off, CAST(l_quantity AS BIGINT) AS nbytes, l_linenumber + 1 AS pixel_type FROM lineitem)"""
SUMMARY = f"""{TILES}, lv AS (SELECT container, level, min(col) AS min_col, min(row) AS min_row, max(col) + 1 AS grid_cols, max(row) + 1 AS grid_rows,
  count(DISTINCT (col, row)) AS tiles_present, CAST(count(DISTINCT channel) AS INTEGER) AS n_channels FROM til GROUP BY 1, 2),
sm AS (SELECT container, level AS base_level, n_levels, hi - level + 1 = n_levels AS levels_contiguous, min_col, min_row, grid_cols, grid_rows, tiles_present,
  grid_cols * grid_rows AS tiles_in_bbox, 1 - tiles_present / (grid_cols * grid_rows)::DOUBLE AS sparsity_fraction, n_channels
  FROM lv JOIN (SELECT container, min(level) AS level, max(level) AS hi, count(*) AS n_levels FROM lv GROUP BY 1) USING (container, level))"""


@query("d06_tile_summary", f"WITH {SUMMARY} SELECT * REPLACE (round(sparsity_fraction, 6) + 0.0::DOUBLE AS sparsity_fraction) FROM sm")
def _tile_summary(t):
    return L.tile_summary(_tiles(t), "container").withColumn("sparsity_fraction", rnd(F.col("sparsity_fraction")))


@query("d07_support_mismatch", f"""WITH {TILES}, b AS (SELECT t.* FROM til t JOIN (SELECT container, min(level) AS level FROM til GROUP BY 1) USING (container, level)),
c AS (SELECT DISTINCT container, col, row, channel FROM b), chs AS (SELECT DISTINCT container, channel FROM c),
ps AS (SELECT DISTINCT container, col, row FROM c),
bad AS (SELECT ps.container, ps.col, ps.row, chs.channel FROM ps JOIN chs USING (container)
  WHERE ((ps.container, ps.col, ps.row, chs.channel) IN (SELECT (container, col, row, channel) FROM c))
    <> ((ps.container, ps.col, ps.row, (SELECT min(channel) FROM chs x WHERE x.container = ps.container)) IN (SELECT (container, col, row, channel) FROM c)))
SELECT k.container, coalesce(string_agg(DISTINCT CAST(bad.channel AS VARCHAR), ',' ORDER BY CAST(bad.channel AS VARCHAR)), '') AS mismatched, count(DISTINCT (bad.col, bad.row)) FILTER (bad.channel IS NOT NULL) AS n_positions
FROM (SELECT DISTINCT container FROM til) k LEFT JOIN bad USING (container) GROUP BY 1""")
def _support(t):
    return L.support_mismatch(_tiles(t), "container")


@query("d08_tile_bounds", f"""WITH {TILES} SELECT container, count(*) AS n_tiles, count(*) FILTER (off + nbytes > 14000) AS n_overflowing, count(*) FILTER (col < 0) AS n_negative,
  count(*) FILTER (pixel_type NOT IN (1, 2, 3, 4, 5, 6, 9, 10)) AS n_unknown_type FROM til GROUP BY 1""")
def _bounds(t):
    return L.tile_bounds(_tiles(t), "container")


def _checked(t):
    s = L.tile_summary(_tiles(t), "container")
    k = F.ascii("container")
    s = s.withColumns({"tile_w": F.lit(512), "tile_h": F.lit(512), "true_w": 15000 + k * 10, "true_h": F.when(F.col("container") == "N", 15000).otherwise(16200),
                       "dtype": F.when(F.col("container") == "R", "uint8").otherwise("uint16"), "samples_per_tile": F.when(F.col("container") == "A", 3).otherwise(1)})
    return L.geometry_check(s)


CHECKED = f"""{SUMMARY}, g0 AS (SELECT *, 15000 + ascii(container) * 10 AS true_w, CASE WHEN container = 'N' THEN 15000 ELSE 16200 END AS true_h FROM sm),
gc AS (SELECT *, (grid_cols * 512)::DOUBLE * (grid_rows * 512) / (true_w::DOUBLE * true_h) - 1 AS grid_overestimate,
  (grid_cols - 1) * 512 >= true_w OR (grid_rows - 1) * 512 >= true_h AS origin_outside, CAST(ceil(true_w / 512.0) AS BIGINT) AS nominal_cols, CAST(ceil(true_h / 512.0) AS BIGINT) AS nominal_rows,
  1 - tiles_present / (ceil(true_w / 512.0) * ceil(true_h / 512.0))::DOUBLE AS sparsity_vs_true, NOT (sparsity_fraction BETWEEN 0.005 AND 0.3) AS sparsity_warning FROM g0)"""


@query("d09_geometry_check", f"""WITH {CHECKED} SELECT container, round(grid_overestimate, 6) AS grid_overestimate, origin_outside, nominal_cols, nominal_rows,
  round(sparsity_vs_true, 6) AS sparsity_vs_true, sparsity_warning FROM gc""")
def _geometry(t):
    return _checked(t).select("container", rnd(F.col("grid_overestimate")).alias("grid_overestimate"), "origin_outside", "nominal_cols", "nominal_rows",
                              rnd(F.col("sparsity_vs_true")).alias("sparsity_vs_true"), "sparsity_warning")


@query("d10_shape_rules", f"""WITH {CHECKED}, p AS (SELECT 'dtype' AS rule, container AS key, 'uint8' AS message FROM gc WHERE container = 'R'
  UNION ALL SELECT 'channel_count', container, CAST(n_channels AS VARCHAR) FROM gc WHERE n_channels <> 3
  UNION ALL SELECT 'samples_per_tile', container, '3' FROM gc WHERE container = 'A'
  UNION ALL SELECT 'sparsity', container, 'positions without data' FROM gc WHERE sparsity_vs_true > 0.3
  UNION ALL SELECT 'grid_overestimate', container, 'grid and image size disagree' FROM gc WHERE abs(grid_overestimate) > 0.15
  UNION ALL SELECT 'origin_outside', container, 'grid does not fit the image' FROM gc WHERE origin_outside)
SELECT rule, 'ERROR' AS severity, key, message FROM p""")
def _shape(t):
    return L.shape_rules(_checked(t), "container")


@query("d11_rollup_status", """WITH p AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_discount = 0 GROUP BY 1),
r AS (SELECT o_orderkey, o_orderpriority, coalesce(n, 0) AS n FROM orders LEFT JOIN p ON k = o_orderkey)
SELECT o_orderpriority, count(*) AS n_total, count(*) FILTER (n = 0) AS n_passed, count(*) FILTER (n > 0) AS n_failed, CAST(sum(n) AS BIGINT) AS n_problems, count(*) FILTER (n > 0) = 0 AS ok FROM r GROUP BY 1""")
def _status(t):
    problems = t.lineitem.where("l_discount = 0").select(F.col("l_orderkey").alias("o_orderkey"))
    return S.rollup_status(problems, t.orders, "o_orderkey", "o_orderpriority")


def _manifest(t):
    """A section table that breaks every rule somewhere."""
    arm = F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "diet").when(F.col("c_mktsegment") == "FURNITURE", "ip").otherwise("")
    d = t.lineitem.join(t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    label = F.when(F.col("l_quantity") == 50, F.col("l_linenumber").cast("string")).otherwise(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"))
    flag = F.col("l_returnflag")
    rows = d.select(
        F.lit("section").alias("row_kind"), F.col("l_orderkey").alias("tube_id"), F.when(F.col("l_linestatus") == "F", "original").otherwise("rescan").alias("scan"),
        label.alias("section_label"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("physical_section_label"),
        F.when(flag == "R", "unresolved").when(flag == "A", "negative").otherwise("positive").alias("condition"),
        F.when(F.col("l_discount") < 0.03, "").when(flag == "N", "near_label").otherwise("far_label").alias("box"),
        (F.col("o_orderstatus") == "F").alias("has_negative_control"), (F.col("o_custkey") % 7).alias("n_sections_recorded"), (F.col("l_orderkey") % 7).alias("n_sections_on_slide"),
        (F.col("o_orderpriority") != "5-LOW").alias("in_record"), (F.col("l_tax") != 0.08).alias("in_index"),
        (F.col("l_discount") <= 0.08).alias("exposure_is_standard"), (0.325 + F.col("l_tax") / 50).alias("pixel_size_um"),
        F.col("c_mktsegment").alias("group"), arm.alias("arm"),
        F.when(F.col("l_tax") == 0.07, "count mismatch; not binding pixels").when(flag == "R", "needs confirmation").otherwise("").alias("notes"),
        (flag == "N").alias("use_for_measurement"),
        F.when(F.col("o_custkey") % 10 == 0, "x").otherwise(F.col("l_orderkey").cast("string")).alias("tube_id_in_file"), F.concat(F.lit("/raw/"), F.col("l_orderkey").cast("string")).alias("path"))
    only = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select(F.lit("record_only").alias("row_kind"), F.col("o_orderkey").alias("tube_id"), F.lit("original").alias("scan"))
    return rows.unionByName(only, allowMissingColumns=True)


MANIFEST = """m AS (SELECT 'section' AS row_kind, l_orderkey AS tube_id, CASE WHEN l_linestatus = 'F' THEN 'original' ELSE 'rescan' END AS scan,
  CASE WHEN l_quantity = 50 THEN CAST(l_linenumber AS VARCHAR) ELSE '0' || l_linenumber END AS section_label, '0' || l_linenumber AS physical_section_label,
  CASE l_returnflag WHEN 'R' THEN 'unresolved' WHEN 'A' THEN 'negative' ELSE 'positive' END AS condition,
  CASE WHEN l_discount < 0.03::DOUBLE THEN '' WHEN l_returnflag = 'N' THEN 'near_label' ELSE 'far_label' END AS box, o_orderstatus = 'F' AS has_negative_control,
  o_custkey % 7 AS n_rec, l_orderkey % 7 AS n_idx, o_orderpriority <> '5-LOW' AS in_record, l_tax <> 0.08::DOUBLE AS in_index, l_discount <= 0.08::DOUBLE AS std, 0.325::DOUBLE + l_tax / 50 AS px,
  c_mktsegment AS grp, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'diet' WHEN c_mktsegment = 'FURNITURE' THEN 'ip' ELSE '' END AS arm,
  CASE WHEN l_tax = 0.07::DOUBLE THEN 'count mismatch; not binding pixels' WHEN l_returnflag = 'R' THEN 'needs confirmation' ELSE '' END AS notes, l_returnflag = 'N' AS kept,
  CASE WHEN o_custkey % 10 = 0 THEN 'x' ELSE CAST(l_orderkey AS VARCHAR) END AS in_file, '/raw/' || l_orderkey AS path
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey),
only_rec AS (SELECT o_orderkey AS tube_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))"""
#: Every rule over a section table ``m`` and records without data ``only_rec``.
PROBLEMS = """prob AS (
  SELECT 'label_format' AS rule, section_label AS key, 'not a zero-padded two-character label' AS message FROM m WHERE NOT regexp_matches(section_label, '^0[1-9]$') GROUP BY section_label
  UNION ALL SELECT 'pixel_size', tube_id || '/' || scan || '/' || section_label, 'pixel size out of tolerance' FROM m WHERE abs(px - 0.325::DOUBLE) > 0.001::DOUBLE
  UNION ALL SELECT 'section_count', tube_id || '/original', min(n_rec) || ' vs ' || min(n_idx) FROM m WHERE scan = 'original' GROUP BY tube_id HAVING min(n_rec) <> min(n_idx)
  UNION ALL SELECT 'no_positive', tube_id || '/' || scan, 'no positive section' FROM m GROUP BY tube_id, scan HAVING NOT bool_and(condition = 'unresolved') AND NOT bool_or(condition = 'positive')
  UNION ALL SELECT 'no_box_yet_condition', tube_id || '/' || scan, 'condition without a box' FROM m GROUP BY tube_id, scan HAVING bool_and(box = '') AND bool_or(condition <> 'unresolved')
  UNION ALL SELECT 'unresolved', CAST(tube_id AS VARCHAR), count(*) || ': ' || coalesce(min(nullif(notes, '')), 'no reason recorded') FROM m WHERE condition = 'unresolved' AND in_index GROUP BY tube_id
  UNION ALL SELECT 'record_without_data', CAST(tube_id AS VARCHAR), 'in the record, no index file' FROM only_rec
  UNION ALL SELECT DISTINCT 'data_without_record', CAST(tube_id AS VARCHAR), 'index file without a record' FROM m WHERE NOT coalesce(in_record, false) AND in_index
  UNION ALL SELECT 'flag_not_constant', CAST(tube_id AS VARCHAR), 'entity flag varies' FROM m GROUP BY tube_id HAVING count(DISTINCT has_negative_control) > 1
  UNION ALL SELECT 'flag_vs_counts', CAST(tube_id AS VARCHAR), CAST(count(*) FILTER (condition = 'negative') AS VARCHAR) FROM m GROUP BY tube_id
    HAVING count(DISTINCT has_negative_control) = 1 AND bool_or(has_negative_control) <> bool_or(condition = 'negative')
  UNION ALL SELECT 'non_standard', CAST(tube_id AS VARCHAR), 'non-standard and not rescanned' FROM m GROUP BY tube_id HAVING bool_or(NOT std) AND NOT (bool_or(scan = 'rescan') AND NOT bool_or(NOT std AND scan = 'rescan'))
  UNION ALL SELECT 'forbidden_entity', CAST(tube_id AS VARCHAR), 'must not appear' FROM (SELECT tube_id FROM m UNION SELECT tube_id FROM only_rec) WHERE tube_id = 59
  UNION ALL SELECT 'unknown_group', CAST(tube_id AS VARCHAR), min(grp) FROM m WHERE grp <> '' AND arm = '' GROUP BY tube_id
  UNION ALL SELECT 'entity_vanishes', CAST(tube_id AS VARCHAR), 'no row survives the measurement filter' FROM m GROUP BY tube_id HAVING NOT bool_or(kept)
  UNION ALL SELECT 'entity_vanishes', CAST(tube_id AS VARCHAR), 'no row survives the measurement filter' FROM only_rec
  UNION ALL SELECT 'no_positive_kept', CAST(tube_id AS VARCHAR), 'no positive row survives' FROM m WHERE kept GROUP BY tube_id HAVING NOT bool_or(condition = 'positive')
  UNION ALL SELECT 'double_counted', tube_id || '/' || physical_section_label, CAST(count(*) AS VARCHAR) FROM m WHERE kept GROUP BY tube_id, physical_section_label HAVING count(*) > 1
  UNION ALL SELECT 'id_mismatch', path, min(in_file) FROM m GROUP BY path HAVING min(in_file) <> CAST(min(tube_id) AS VARCHAR)
  UNION ALL SELECT DISTINCT 'unreadable', path, 'index could not be read' FROM m WHERE NOT in_index
  UNION ALL SELECT 'refused_binding', path, min(notes) FROM m WHERE contains(notes, 'not binding') GROUP BY path
  UNION ALL SELECT 'duplicate_key', tube_id || '/' || scan || '/' || section_label, CAST(count(*) AS VARCHAR) FROM m GROUP BY tube_id, scan, section_label HAVING count(*) > 1)"""


@query("d12_manifest_rules", f"WITH {MANIFEST}, {PROBLEMS} SELECT rule, 'ERROR' AS severity, key, message FROM prob")
def _rules(t):
    return U.validate_manifest(_manifest(t), forbidden=[59])


@query("f04_examples_per_rule", f"""WITH {MANIFEST}, {PROBLEMS} SELECT rule, 'ERROR' AS severity, key, message, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY rule ORDER BY key, message) AS place FROM prob) WHERE place <= 8""")
def _examples(t):
    return U.examples(U.validate_manifest(_manifest(t), forbidden=[59]))


@query("d13_record_rules", """SELECT rule, severity, key, message FROM (
  SELECT 'key_range' AS rule, 'ERROR' AS severity, CAST(o_custkey AS VARCHAR) AS key, CAST(o_custkey AS VARCHAR) AS message FROM orders WHERE o_custkey NOT BETWEEN 29 AND 1400
  UNION ALL SELECT 'domain_o_orderstatus', 'ERROR', CAST(o_custkey AS VARCHAR), o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
  UNION ALL SELECT 'both_needs_no_control', 'ERROR', CAST(o_custkey AS VARCHAR), 'fields contradict' FROM orders WHERE (o_orderstatus = 'P') <> (o_orderpriority = '1-URGENT')
  UNION ALL SELECT 'forbidden', 'ERROR', CAST(o_custkey AS VARCHAR), CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey = 59
  UNION ALL SELECT 'needs_confirmation', 'WARN', CAST(o_custkey AS VARCHAR), 'check' FROM orders WHERE o_totalprice > 400000
  UNION ALL SELECT 'duplicate', 'ERROR', CAST(o_custkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM orders GROUP BY o_custkey HAVING count(*) > 1
  UNION ALL SELECT 'row_count', 'WARN', '', CAST(count(*) AS VARCHAR) FROM orders HAVING count(*) <> 31)""")
def _record(t):
    d = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority", F.when(F.col("o_totalprice") > 400000, " check ").alias("needs"))
    return U.validate_record(d, "o_custkey", key_range=(29, 1400), domains={"o_orderstatus": ("F", "O")},
                             implies=[("both_needs_no_control", F.col("o_orderstatus") == "P", F.col("o_orderpriority") == "1-URGENT")],
                             needs="needs", forbidden=[59], expected_rows=31)


def _limbs(source: str) -> str:
    return ", ".join(f"CAST(sum(('0x' || substr(h, {1 + 15 * i}, 15))::UBIGINT::HUGEINT) AS VARCHAR)" for i in range(4))


@query("d14_fingerprint", f"""WITH h AS (SELECT 'names' AS source, sha256('{{"c_name":"' || c_name || '"}}') AS h FROM customer
  UNION ALL SELECT 'record', sha256('{{"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus || '"}}') FROM orders)
SELECT source, count(*) AS n_items, sha256(concat_ws('|', CAST(count(*) AS VARCHAR), {_limbs('h')})) AS digest FROM h GROUP BY 1""")
def _fingerprint(t):
    return U.fingerprint({"names": t.customer.select("c_name"), "record": t.orders.select("o_orderstatus", "o_orderpriority")})


@query("d14_stale_inputs", "SELECT * FROM (VALUES ('names', false), ('record', true)) v(source, stale)")
def _stale(t):
    now = U.fingerprint({"names": t.customer.select("c_name"), "record": t.orders.select("o_orderstatus")})
    then = U.fingerprint({"names": t.customer.select("c_name"), "record": t.orders.where("o_orderkey <> 7").select("o_orderstatus")})
    return U.is_stale(now, then)


@query("d17_separation", """WITH s AS (SELECT o_custkey, round(min(o_totalprice) FILTER (o_orderstatus = 'F') / greatest(max(o_totalprice) FILTER (o_orderstatus = 'O'), 1e-9::DOUBLE), 2)
  AS separation, count(*) FILTER (o_orderstatus = 'O') AS n_neg FROM orders GROUP BY 1)
SELECT o_orderkey, CASE WHEN n_neg > 0 THEN separation END AS separation FROM orders JOIN s USING (o_custkey)""")
def _separation(t):
    c = F.when(F.col("o_orderstatus") == "F", "positive").when(F.col("o_orderstatus") == "O", "negative").otherwise("unresolved")
    return S.separation(t.orders.withColumn("condition", c), ["o_custkey"], "o_totalprice").select("o_orderkey", "separation")


def _audited(t):
    """Document quality as the recorded condition, text length as the measured index."""
    return t.labels.join(t.documents, "doc_id").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("condition"), (F.col("n_chars") / 400).alias("index"),
        (F.length(F.regexp_replace("text", "[^aeiou]", "")) / F.length("text")).alias("tissue_fraction"))


AUDITED = """aud AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS condition, n_chars / 400.0::DOUBLE AS idx,
  length(regexp_replace(text, '[^aeiou]', '', 'g')) / length(text)::DOUBLE AS tf FROM labels JOIN documents USING (doc_id))"""


@query("d16_audit_verdict", f"""WITH {AUDITED}, v AS (SELECT *, CASE WHEN idx >= 3 THEN 'positive' WHEN idx <= 2 THEN 'negative' ELSE 'inconclusive' END AS seen FROM aud)
SELECT doc_id, condition, CASE WHEN doc_id % 10 = 0 THEN 'not_checked' WHEN seen = 'inconclusive' THEN 'inconclusive' WHEN seen = condition THEN 'agree' ELSE 'CONTRADICTS' END AS agreement FROM v""")
def _verdict(t):
    rec = F.when(F.col("doc_id") % 10 == 0, "unresolved").otherwise(F.col("condition"))
    return _audited(t).select("doc_id", "condition", S.audit_verdict(F.col("index"), rec).alias("agreement"))


@query("d18_overlap_rows", f"""WITH {AUDITED}, g AS (SELECT * FROM aud WHERE tf > 0.2), e AS (SELECT min(idx) FILTER (condition = 'positive') AS lo, max(idx) FILTER (condition = 'negative') AS hi FROM g)
SELECT doc_id, condition, round(idx, 6) AS idx FROM g, e WHERE (condition = 'positive' AND idx < hi) OR (condition = 'negative' AND idx > lo)""")
def _overlap(t):
    return S.overlap_rows(_audited(t), "index", "tissue_fraction", 0.2).select("doc_id", "condition", rnd(F.col("index")).alias("idx"))


@query("d18_class_ranges", f"""WITH {AUDITED} SELECT count(*) FILTER (condition = 'positive') AS n_positive, min(idx) FILTER (condition = 'positive') AS min_positive, max(idx) FILTER (condition = 'positive') AS max_positive,
  count(*) FILTER (condition = 'negative') AS n_negative, min(idx) FILTER (condition = 'negative') AS min_negative, max(idx) FILTER (condition = 'negative') AS max_negative FROM aud""")
def _ranges(t):
    return S.class_ranges(_audited(t), "index")


@query("d20_area_weighted", """SELECT l_suppkey, round(sum(l_tax) / sum(l_extendedprice), 12) AS weighted, round(avg(l_tax / l_extendedprice), 12) AS mean_ratio, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1""")
def _weighted(t):
    d = S.area_weighted(t.lineitem, ["l_suppkey"], "l_tax", "l_extendedprice", F.col("l_returnflag") == "R")
    return d.withColumns({"weighted": rnd(F.col("weighted"), 12), "mean_ratio": rnd(F.col("mean_ratio"), 12)})


@query("d21_tally", "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def _tally(t):
    return S.tally(t.orders, ["o_orderpriority", "o_orderstatus"])


@query("d21_describe_by", """SELECT o_orderpriority, count(*) AS n, round(quantile_cont(o_totalprice, 0.5), 4) AS median, min(o_totalprice) AS low, max(o_totalprice) AS high,
  round(avg(CASE WHEN o_orderstatus <> 'P' THEN 1.0::DOUBLE ELSE 0 END), 6) AS kept FROM orders GROUP BY 1""")
def _describe(t):
    d = S.describe(t.orders, ["o_orderpriority"], "o_totalprice", F.col("o_orderstatus") != "P")
    return d.withColumns({"kept": rnd(F.col("kept")), "median": rnd(F.col("median"), 4)})
