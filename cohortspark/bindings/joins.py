"""Joins, matching, conditions and preference on the test tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.text import display_key
from ..operators import conditions as C
from ..operators import matching as M
from ..operators.rules import validate_manifest
from ..operators.summarise import attach
from ..plans.manifest import build_manifest, section_conditions, section_table, slide_report
from .checks import PROBLEMS
from .registry import query, rnd
from .shapes import ARM, RECORD, SCANS, SECTIONS, SIDES, gap_sql, record, scans, sections, split_sql


@query("slide_report", f"""WITH {SIDES},
flag AS (SELECT animal, CASE WHEN bool_or(condition <> 'unresolved') THEN bool_or(condition = 'negative') END AS has_negative_control
  FROM cond WHERE animal IS NOT NULL GROUP BY animal)
SELECT slide, animal, positive_box, has_negative_control, reason, count(*) AS n_sections,
  coalesce(string_agg(CASE WHEN condition = 'positive' THEN section_label END, ',' ORDER BY section_label), '') AS positive_labels,
  coalesce(string_agg(CASE WHEN condition = 'negative' THEN section_label END, ',' ORDER BY section_label), '') AS negative_labels,
  coalesce(string_agg(CASE WHEN condition = 'unresolved' THEN section_label END, ',' ORDER BY section_label), '') AS unresolved_labels,
  count(*) FILTER (condition = 'unresolved') AS n_unresolved
FROM cond LEFT JOIN flag USING (animal) GROUP BY slide, animal, positive_box, has_negative_control, reason""")
def _slide_report(t):
    return slide_report(sections(t), record(t))


@query("c01_enrich", f"""WITH {SCANS}, {RECORD}
SELECT slide, scan, section_label, animal, positive_box, needs_confirmation, rec.slide IS NOT NULL AS in_record
FROM scn LEFT JOIN rec USING (slide)""")
def _enrich(t):
    return C.enrich(scans(t), record(t), "slide").select(
        "slide", "scan", "section_label", "animal", "positive_box", "needs_confirmation", "in_record")


@query("c02_three_state_condition", f"""WITH {SIDES}
SELECT slide, section_label, animal, positive_box, box, round(gap_ratio, 6) AS gap_ratio, condition, reason FROM cond""")
def _condition(t):
    return section_conditions(sections(t), record(t)).select(
        "slide", "section_label", "animal", "positive_box", "box", rnd(F.col("gap_ratio")).alias("gap_ratio"), "condition", "reason")


@query("c03_reconcile", """SELECT key, CASE WHEN a AND b THEN 'section' WHEN b THEN 'record_only' ELSE 'data_only' END AS row_kind
FROM (SELECT coalesce(x.k, y.k) AS key, x.k IS NOT NULL AS a, y.k IS NOT NULL AS b
  FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P') x
  FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_acctbal >= 0) y ON x.k = y.k)""")
def _reconcile(t):
    data = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("key"))
    return C.reconcile(data, t.customer.where("c_acctbal >= 0").select(F.col("c_custkey").alias("key")), "key")


@query("c03_bookkeeping_rows", f"""WITH {SECTIONS}, {RECORD}
SELECT slide, section_label, x, NULL AS positive_box, 'section' AS row_kind FROM sec
UNION ALL SELECT slide, NULL, NULL, positive_box, 'record_only' FROM rec WHERE slide NOT IN (SELECT slide FROM sec)""")
def _bookkeeping(t):
    return C.bookkeeping_rows(sections(t), record(t).select("slide", "positive_box"), "slide").select(
        "slide", "section_label", "x", "positive_box", "row_kind")


MATCH = f"""{SCANS}, l AS (SELECT * FROM scn WHERE scan = 'original'), r AS (SELECT * FROM scn WHERE scan = 'rescan'),
{gap_sql('l')},
lp AS (SELECT slide, x, min(section_label) AS ll, count(*) AS c FROM l GROUP BY 1, 2),
st AS (SELECT slide, x, c, x - lag(x) OVER (PARTITION BY slide ORDER BY x) AS d FROM lp),
sp AS (SELECT slide, sum(c) AS n_left, CASE WHEN max(c) > 1 THEN 0.0 ELSE min(d) END AS spacing FROM st GROUP BY 1),
cand AS (SELECT r.slide, r.section_label, r.x, lp.ll, abs(lp.x - r.x) AS off,
  row_number() OVER (PARTITION BY r.slide, r.section_label ORDER BY abs(lp.x - r.x), lp.x) AS rn
  FROM r LEFT JOIN lp USING (slide)),
best AS (SELECT cand.slide, section_label, cand.x, ll, off, coalesce(n_left >= 2, false) AS enough,
  coalesce(n_left >= 2 AND off <= 0.25 * spacing, false) AS hit,
  CASE WHEN split_gap IS NULL OR coalesce(split_gap < 1.5 * other_gap, false) OR (cand.x > split_lo AND cand.x < split_hi) THEN NULL
       WHEN cand.x <= split_lo THEN 'near_label' ELSE 'far_label' END AS side
  FROM cand LEFT JOIN sp USING (slide) LEFT JOIN gp USING (slide) WHERE rn = 1),
k AS (SELECT slide, max(k) > 1 AS clash FROM (SELECT slide, ll, count(*) AS k FROM best WHERE hit GROUP BY 1, 2) GROUP BY 1),
lost AS (SELECT slide, bool_or(NOT hit AND side IS NULL) AS lost FROM best GROUP BY 1),
m AS (SELECT best.*, CASE WHEN NOT enough THEN 'fewer than two originals'
    WHEN lost THEN 'a section is beyond the tolerance and on no clear side'
    WHEN clash THEN 'two sections claim one original' END AS match_reason
  FROM best LEFT JOIN k USING (slide) LEFT JOIN lost USING (slide))"""


@query("c04_nearest_match", f"""WITH {MATCH}
SELECT slide, section_label, x, CASE WHEN match_reason IS NOT NULL THEN 'void' WHEN hit THEN 'matched' ELSE 'new' END AS match_status,
  match_reason, CASE WHEN match_reason IS NOT NULL THEN NULL WHEN hit THEN ll ELSE 'new' || section_label END AS matched_label,
  round(CASE WHEN match_reason IS NOT NULL THEN NULL WHEN hit THEN off ELSE 0.0 END, 6) AS match_offset,
  CASE WHEN match_reason IS NULL AND NOT hit THEN side END AS side FROM m""")
def _nearest(t):
    s = scans(t)
    return M.nearest_match(s.where("scan = 'original'"), s.where("scan = 'rescan'"), ["slide"], "x", "section_label").withColumn(
        "match_offset", rnd(F.col("match_offset")))


@query("c05_place_by_gap", f"""WITH {SCANS}, l AS (SELECT * FROM scn WHERE scan = 'original'), {gap_sql('l')}
SELECT scn.slide, section_label, x,
  CASE WHEN split_gap IS NULL OR coalesce(split_gap < 1.5 * other_gap, false) OR (x > split_lo AND x < split_hi) THEN NULL
       WHEN x <= split_lo THEN 'near_label' ELSE 'far_label' END AS side
FROM scn LEFT JOIN gp USING (slide) WHERE scan = 'rescan'""")
def _place(t):
    s = scans(t)
    return M.place_by_gap(s.where("scan = 'rescan'"), s.where("scan = 'original'"), ["slide"], "x").select("slide", "section_label", "x", "side")


@query("c06_ordinal_join", f"""WITH {SECTIONS},
a AS (SELECT slide, section_label, CAST(section_label AS INTEGER) AS label_no, row_number() OVER (PARTITION BY slide ORDER BY section_label) AS p,
  count(*) OVER (PARTITION BY slide) AS na FROM sec),
stk AS (SELECT DISTINCT l_orderkey AS slide, l_suppkey AS stack_id FROM lineitem),
b AS (SELECT slide, stack_id, row_number() OVER (PARTITION BY slide ORDER BY stack_id) AS p, count(*) OVER (PARTITION BY slide) AS nb FROM stk),
nb AS (SELECT slide, count(*) AS nb FROM stk GROUP BY 1)
SELECT a.slide, section_label, label_no, CASE WHEN na = nb.nb THEN stack_id END AS stack_id,
  CASE WHEN nb.nb IS NULL THEN 'no_payload' WHEN na <> nb.nb THEN 'count_mismatch' ELSE 'bound' END AS bind_status
FROM a LEFT JOIN b USING (slide, p) LEFT JOIN nb USING (slide)""")
def _ordinal(t):
    a = sections(t).select("slide", "section_label", F.col("section_label").cast("int").alias("label_no"))
    b = t.lineitem.select(F.col("l_orderkey").alias("slide"), F.col("l_suppkey").alias("stack_id")).distinct()
    return M.ordinal_join(a, b, ["slide"], "label_no", "stack_id")


@query("c07_attach_digests", """WITH d AS (SELECT o_orderkey AS k, sha256(o_orderkey || ':' || o_orderpriority) AS digest FROM orders WHERE o_orderstatus <> 'P')
SELECT l_orderkey, l_linenumber, count(*) AS n, coalesce(max(digest), '') AS digest FROM lineitem LEFT JOIN d ON l_orderkey = k GROUP BY 1, 2""")
def _digests(t):
    d = t.orders.where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("l_orderkey"), F.sha2(F.concat_ws(":", F.col("o_orderkey").cast("string"), "o_orderpriority"), 256).alias("digest"))
    rows = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return attach(rows, d, ["l_orderkey"]).withColumn("digest", F.coalesce("digest", F.lit("")))


@query("c09_paired_acquisitions", f"""WITH {SCANS},
g AS (SELECT slide, section_label, min(flag) IS NOT DISTINCT FROM max(flag) AS pair_ok FROM scn GROUP BY 1, 2 HAVING count(DISTINCT scan) = 2)
SELECT scn.slide, scn.section_label, scan, flag, pair_ok FROM scn JOIN g USING (slide, section_label)""")
def _pairs(t):
    return M.select_pairs(scans(t), ["slide", "section_label"], "scan", condition="flag").select(
        "slide", "section_label", "scan", "flag", "pair_ok")


@query("c10_exactly_one_lookup", """WITH s AS (SELECT s_nationkey AS k, count(*) AS m, min(s_name) AS v FROM supplier GROUP BY 1)
SELECT c_custkey, c_nationkey, CASE WHEN m = 1 THEN v END AS s_name,
  CASE WHEN m IS NULL THEN 'missing' WHEN m > 1 THEN 'ambiguous' ELSE 'ok' END AS lookup_status
FROM customer LEFT JOIN s ON c_nationkey = k""")
def _lookup(t):
    ref = t.supplier.select(F.col("s_nationkey").alias("c_nationkey"), "s_name")
    return M.lookup_one(t.customer.select("c_custkey", "c_nationkey"), ref, ["c_nationkey"], "s_name")


def _manifest(t):
    """Scans with a record condition and a physical label: the input of patches and preference."""
    return scans(t).select(
        F.col("slide").alias("tube_id"), "scan", "section_label", F.col("section_label").alias("physical_section_label"),
        F.when(F.col("flag") == "R", "unresolved").when(F.col("flag") == "A", "negative").otherwise("positive").alias("condition"),
        (F.col("flag") != "R").alias("analysis_include"), (F.col("scan") == "rescan").alias("scan_is_preferred"))


MANIFEST = f"""{SCANS}, man AS (SELECT slide AS tube_id, scan, section_label, section_label AS physical_section_label,
  CASE flag WHEN 'R' THEN 'unresolved' WHEN 'A' THEN 'negative' ELSE 'positive' END AS condition,
  flag <> 'R' AS analysis_include, scan = 'rescan' AS scan_is_preferred FROM scn)"""


def _notes(t):
    """Bench notes from orders: the priority picks the action, the key the wildcards."""
    k = F.col("o_orderkey")
    p = F.substring("o_orderpriority", 1, 1)
    return t.orders.select(
        k.alias("ord"), F.floor(k / 2).alias("tube_id"),
        F.when((k % 3 == 0) & (p != "5"), "").when(k % 2 == 0, "original").otherwise("rescan").alias("scan"),
        F.when((k % 5 < 3) & (p != "5"), F.lpad((k % 7 + 1).cast("string"), 2, "0")).otherwise("").alias("section_label"),
        F.when(p == "1", "exclude_section").when(p == "2", "flag_artefact").when(p == "3", "flag_quality")
        .when(p == "4", "prefer_section").otherwise("prefer_scan").alias("action"),
        F.concat(F.lit("note "), k.cast("string")).alias("note"))


NOTES = """nts AS (SELECT o_orderkey AS ord, o_orderkey // 2 AS tube_id,
  CASE WHEN o_orderkey % 3 = 0 AND p <> '5' THEN '' WHEN o_orderkey % 2 = 0 THEN 'original' ELSE 'rescan' END AS scan,
  CASE WHEN o_orderkey % 5 < 3 AND p <> '5' THEN lpad(CAST(o_orderkey % 7 + 1 AS VARCHAR), 2, '0') ELSE '' END AS section_label,
  CASE p WHEN '1' THEN 'exclude_section' WHEN '2' THEN 'flag_artefact' WHEN '3' THEN 'flag_quality' WHEN '4' THEN 'prefer_section' ELSE 'prefer_scan' END AS action,
  'note ' || o_orderkey AS note FROM (SELECT *, substr(o_orderpriority, 1, 1) AS p FROM orders)),
hit AS (SELECT man.tube_id, man.scan, man.section_label, n.ord, n.action, n.note, n.scan AS nscan
  FROM man JOIN nts n ON n.tube_id = man.tube_id AND (n.action = 'prefer_scan'
    OR ((n.scan = '' OR n.scan = man.scan) AND (n.section_label = '' OR n.section_label = man.section_label)))),
agg AS (SELECT tube_id, scan, section_label, arg_max(note, ord) AS bench_note,
  arg_max(action, ord) FILTER (action <> 'prefer_scan' OR nscan = scan) AS bench_action,
  bool_or(action = 'flag_artefact') AS art, bool_or(action = 'flag_quality') AS low, bool_or(action = 'exclude_section') AS cut,
  arg_max(nscan, ord) FILTER (action = 'prefer_scan') AS pin FROM hit GROUP BY 1, 2, 3),
pat AS (SELECT man.tube_id, man.scan, man.section_label, physical_section_label, condition, coalesce(bench_note, '') AS bench_note,
  coalesce(bench_action, '') AS bench_action, coalesce(art, false) AS has_flagged_artefact, coalesce(low, false) AS flagged_lower_quality,
  analysis_include AND NOT coalesce(cut, false) AS analysis_include,
  CASE WHEN pin IS NOT NULL THEN man.scan = pin ELSE scan_is_preferred END AS scan_is_preferred
  FROM man LEFT JOIN agg USING (tube_id, scan, section_label))"""

_PATCHED = ["tube_id", "scan", "section_label", "condition", "bench_note", "bench_action", "has_flagged_artefact",
            "flagged_lower_quality", "analysis_include", "scan_is_preferred"]


@query("c11_patch_overlay", f"WITH {MANIFEST}, {NOTES} SELECT {', '.join(_PATCHED)} FROM pat")
def _patches(t):
    return C.apply_patches(_manifest(t), _notes(t)).select(*_PATCHED)


_PREFER_TAIL = """pin AS (SELECT tube_id, arg_min(scan, scan || section_label) AS pinned FROM pat WHERE bench_action = 'prefer_scan' GROUP BY 1),
rk AS (SELECT pat.*, condition IN ('positive', 'negative') AND analysis_include AS usable, row_number() OVER (
  PARTITION BY tube_id, physical_section_label ORDER BY CASE WHEN scan = pinned THEN 0
    WHEN condition IN ('positive', 'negative') AND analysis_include AND scan = 'rescan' THEN 1
    WHEN condition IN ('positive', 'negative') AND analysis_include THEN 2 ELSE 3 END, scan, section_label) AS rn
  FROM pat LEFT JOIN pin USING (tube_id)),
pref AS (SELECT tube_id, scan, section_label, physical_section_label, condition, analysis_include, rn = 1 AS scan_is_preferred,
  rn = 1 AND usable AS use_for_measurement FROM rk)"""
PREFER = f"{MANIFEST}, {NOTES}, {_PREFER_TAIL}"


@query("e02_preferred_row", f"WITH {PREFER} SELECT * FROM pref")
def _prefer(t):
    return C.patch_and_prefer(_manifest(t), _notes(t)).select(
        "tube_id", "scan", "section_label", "physical_section_label", "condition", "analysis_include",
        "scan_is_preferred", "use_for_measurement")


@query("e01_gap_split", f"""WITH {SECTIONS}, {gap_sql('sec')}, {split_sql()}
SELECT slide, n, n_low, n_high, split_lo, round(split_gap / 1000, 6) AS split_gap_mm, round(other_gap / 1000, 6) AS within_gap_mm,
  round(gap_ratio, 6) AS gap_ratio, status, status = 'ok' AND coalesce(gap_ratio < 1.5, false) AS marginal FROM spl""")
def _gap(t):
    g = M.gap_split(sections(t), ["slide"], "x")
    return g.select("slide", "n", "n_low", "n_high", "split_lo", *[rnd(F.col(c)).alias(c) for c in ("split_gap_mm", "within_gap_mm", "gap_ratio")],
                    "status", "marginal")


@query("b11_display_key", f"""WITH {SCANS} SELECT slide, scan, section_label,
  'K' || slide || CASE WHEN scan = 'rescan' THEN 'b' ELSE '' END || '_s' || section_label AS image FROM scn""")
def _display(t):
    code = F.concat(F.lit("K"), F.col("slide").cast("string"))
    return scans(t).select("slide", "scan", "section_label",
                           display_key(code, F.col("scan") == "rescan", F.col("section_label")).alias("image"))


@query("e06_joint_exclusion", """WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n_rows,
  string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS conditions_seen FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, n_rows, conditions_seen, 'ambiguous_duplicate_rows' AS reason FROM g WHERE n_rows > 1""")
def _collisions(t):
    return C.exclude_collisions(t.lineitem, ["l_orderkey", "l_linenumber"], "l_linestatus")[1]


@query("e06_rows_kept", """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) = 1)""")
def _kept(t):
    return C.exclude_collisions(t.lineitem, ["l_orderkey", "l_linenumber"], "l_linestatus")[0].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("e07_first_per_group", """SELECT l_orderkey, l_extendedprice, l_partkey FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey) AS rn FROM lineitem) WHERE rn = 1""")
def _first(t):
    return C.first_per(t.lineitem.select("l_orderkey", "l_extendedprice", "l_partkey"), ["l_orderkey"], ["l_extendedprice", "l_partkey"])


@query("e08_monotone_sequence", """WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS d FROM orders)
SELECT o_custkey, count(*) AS n, count(*) >= 3 AND coalesce(bool_and(d > 0) FILTER (d IS NOT NULL), true) AS rising,
  count(*) >= 3 AND coalesce(bool_and(d < 0) FILTER (d IS NOT NULL), true) AS falling FROM o GROUP BY 1""")
def _monotone(t):
    return M.is_monotone(t.orders, ["o_custkey"], "o_orderkey", "o_totalprice", 3)


BUILD = f"""{MATCH}, {split_sql()}, {RECORD},
ob AS (SELECT l.slide AS tube_id, 'original' AS scan, section_label, section_label AS phys, CASE WHEN status = 'ok' THEN CASE WHEN x <= split_lo THEN 'near_label' ELSE 'far_label' END END AS box, status = 'ok' AS has_box FROM l JOIN spl USING (slide)),
rb AS (SELECT m.slide AS tube_id, 'rescan' AS scan, m.section_label, CASE WHEN match_reason IS NOT NULL THEN m.section_label WHEN hit THEN ll ELSE 'new' || m.section_label END AS phys,
  CASE WHEN match_reason IS NOT NULL OR coalesce(spl.status, '') <> 'ok' THEN NULL WHEN hit THEN ob.box ELSE side END AS box FROM m LEFT JOIN spl USING (slide) LEFT JOIN ob ON ob.tube_id = m.slide AND ob.section_label = ll),
al AS (SELECT * FROM ob UNION ALL SELECT *, bool_or(box IS NOT NULL) OVER (PARTITION BY tube_id) FROM rb),
cd AS (SELECT al.*, CASE WHEN r.slide IS NULL OR needs_confirmation <> '' OR coalesce(positive_box, '') NOT IN ('near_label', 'far_label', 'both') THEN 'unresolved' WHEN positive_box = 'both' THEN 'positive'
  WHEN NOT has_box OR box IS NULL THEN 'unresolved' WHEN box = positive_box THEN 'positive' ELSE 'negative' END AS condition FROM al LEFT JOIN rec r ON r.slide = al.tube_id),
man AS (SELECT tube_id, scan, section_label, phys AS physical_section_label, condition, condition <> 'unresolved' AS analysis_include, false AS scan_is_preferred FROM cd),
{NOTES}, {_PREFER_TAIL},
fl AS (SELECT tube_id, CASE WHEN bool_or(condition <> 'unresolved') THEN bool_or(condition = 'negative') END AS has_negative_control FROM cd GROUP BY 1)"""


@query("manifest_build", f"""WITH {BUILD}
SELECT 'section' AS row_kind, pref.*, box, has_negative_control FROM pref JOIN fl USING (tube_id) JOIN cd USING (tube_id, scan, section_label)
UNION ALL SELECT 'record_only', slide, 'original', '', '', 'unresolved', false, true, false, NULL, NULL FROM rec WHERE slide NOT IN (SELECT slide FROM scn)""".replace("SELECT 'section' AS row_kind, pref.*, box", "SELECT 'section' AS row_kind, pref.*, cd.box"))
def _build(t):
    s = scans(t).withColumnRenamed("slide", "tube_id").select("tube_id", "scan", "section_label", "x")
    m = build_manifest(s.where("scan = 'original'"), s.where("scan = 'rescan'"), record(t).withColumnRenamed("slide", "tube_id"), _notes(t))
    return m.select("row_kind", "tube_id", "scan", "section_label", "physical_section_label", "condition", "analysis_include", "scan_is_preferred",
                    "use_for_measurement", "box", "has_negative_control")


STANDARD = (20.0, 30.0, 40.0)


def _finished(t):
    """The section table from end to end: sections with sizes, exposures and files, records with groups and counts."""
    k = F.col("tube_id")
    s = scans(t).withColumnRenamed("slide", "tube_id").select(
        "tube_id", "scan", "section_label", "x", F.lit(0.325).cast("double").alias("pixel_base"), F.col("qty").cast("bigint").alias("width_px"), F.lit(3).cast("bigint").alias("height_px"))
    s = s.withColumns({
        "pixel_size_um": F.col("pixel_base") + F.when(k % 11 == 0, 0.01).otherwise(0.0), "exposure_DAPI_ms": F.when((k % 7 == 0) & (F.col("scan") == "original"), 25.0).when(k % 70 == 1, 26.0).otherwise(20.0),
        "exposure_FITC_ms": F.lit(30.0), "exposure_Cy3_ms": F.lit(40.0), "in_vsi_index": k % 13 != 0, "vsi_path": F.concat_ws("/", F.lit("/raw"), "scan", k.cast("string")),
        "tube_id_in_file": F.when(k % 17 == 0, "x").otherwise(k.cast("string"))}).drop("pixel_base")
    r = record(t).join(t.customer.select(F.col("c_custkey").alias("animal"), F.col("c_mktsegment").alias("group")), "animal", "left").withColumnRenamed("slide", "tube_id")
    r = r.withColumn("n_sections_recorded", F.col("animal") % 5 + 1)
    return section_table(s.where("scan = 'original'"), s.where("scan = 'rescan'"), r, _notes(t), ARM, STANDARD)


FINISHED = f"""{BUILD},
fin AS (SELECT 'section' AS row_kind, pref.tube_id, pref.scan, pref.section_label, pref.physical_section_label, pref.condition, coalesce(cd.box, '') AS box, has_negative_control, r.animal % 5 + 1 AS n_rec,
  count(*) OVER (PARTITION BY pref.tube_id, pref.scan) AS n_idx, r.slide IS NOT NULL AS in_record, pref.tube_id % 13 <> 0 AS in_index,
  NOT ((pref.tube_id % 7 = 0 AND pref.scan = 'original') OR pref.tube_id % 70 = 1) AS std, CASE WHEN pref.tube_id % 11 = 0 THEN 0.335 ELSE 0.325 END::DOUBLE AS px, coalesce(c_mktsegment, '') AS grp,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'a' WHEN 'BUILDING' THEN 'a' WHEN 'FURNITURE' THEN 'b' WHEN 'MACHINERY' THEN 'b' ELSE '' END AS arm,
  CASE WHEN r.slide IS NULL THEN 'no record' WHEN needs_confirmation <> '' THEN 'needs confirmation: ' || needs_confirmation WHEN coalesce(positive_box, '') NOT IN ('near_label', 'far_label', 'both') THEN 'positive box is ' || coalesce(positive_box, '')
    WHEN positive_box <> 'both' AND NOT cd.has_box THEN 'no box could be derived' ELSE '' END AS notes,
  use_for_measurement AS kept, CASE WHEN pref.tube_id % 17 = 0 THEN 'x' ELSE CAST(pref.tube_id AS VARCHAR) END AS in_file, '/raw/' || pref.scan || '/' || pref.tube_id AS path
  FROM pref JOIN fl USING (tube_id) JOIN cd USING (tube_id, scan, section_label) LEFT JOIN rec r ON r.slide = pref.tube_id LEFT JOIN customer ON c_custkey = r.animal),
only_rec AS (SELECT slide AS tube_id FROM rec WHERE slide NOT IN (SELECT slide FROM scn)), {re.sub(r"FROM m\b", "FROM fin", PROBLEMS)}"""


@query("manifest_validate", f"WITH {FINISHED} SELECT rule, 'ERROR' AS severity, key, message FROM prob")
def _validated(t):
    return validate_manifest(_finished(t), forbidden=[59])


@query("manifest_columns", f"""WITH {FINISHED} SELECT tube_id, scan, section_label, condition, arm, n_idx AS n_sections_on_slide, count(*) FILTER (condition = 'positive') OVER (PARTITION BY tube_id, scan) AS n_positive_sections_on_slide, std AS exposure_is_standard,
  notes, kept AS use_for_measurement FROM fin""")
def _columns(t):
    return _finished(t).where("row_kind = 'section'").select("tube_id", "scan", "section_label", "condition", "arm", "n_sections_on_slide", "n_positive_sections_on_slide", "exposure_is_standard", "notes", "use_for_measurement")
