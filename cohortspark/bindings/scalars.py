"""Scalar expressions on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as X
from ..operators.blinding import split_columns
from .registry import query, rnd


@query("b01_int_or_null", """SELECT event_id, TRY_CAST(trim(v) AS INTEGER) AS k FROM (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ' ' || regexp_extract(props, '(\\d+)', 1) || ' ' WHEN event_id % 3 = 1 THEN ' ' ELSE event_type END AS v FROM events)""")
def _int(t):
    v = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" "), F.regexp_extract("props", r"(\d+)", 1), F.lit(" "))).when(
        F.col("event_id") % 3 == 1, " ").otherwise(F.col("event_type"))
    return t.events.select("event_id", X.int_or_null(v).alias("k"))


@query("b02_id_from_path", """SELECT c_custkey, CAST(regexp_extract(c_name, '(\\d+)', 1) AS BIGINT) AS id,
  CAST(regexp_extract(c_name, '(\\d+)', 1) AS BIGINT) <> c_custkey + (CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END) AS mismatch FROM customer""")
def _id(t):
    path = F.concat(F.lit("/raw/batch"), F.col("c_nationkey").cast("string"), F.lit("/"), F.col("c_name"))
    inside = F.col("c_custkey") + F.when(F.col("c_custkey") % 7 == 0, 1).otherwise(0)
    return t.customer.select("c_custkey", X.id_from_path(path).alias("id"), X.id_mismatch(X.id_from_path(path), inside).alias("mismatch"))


@query("b03_series_kind", """WITH s AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 6 THEN 'Label' WHEN 7 THEN 'overview'
  WHEN 5 THEN '' WHEN 4 THEN 'FocusMap' ELSE '20x_' || l_shipmode || '_0' || l_linenumber END AS series_name
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag AS l_shipmode FROM lineitem))
SELECT l_orderkey, l_linenumber, series_name, nullif(regexp_extract(series_name, '_(0[1-9])$', 1), '') AS section_label,
  CASE WHEN trim(series_name) = '' THEN 'unnamed' WHEN regexp_matches(series_name, '_(0[1-9])$') THEN 'tissue'
  WHEN lower(series_name) = 'label' THEN 'label' WHEN lower(series_name) = 'overview' THEN 'overview' ELSE 'other' END AS kind FROM s""")
def _kind(t):
    n = F.col("l_linenumber")
    name = F.when(n == 6, "Label").when(n == 7, "overview").when(n == 5, "").when(n == 4, "FocusMap").otherwise(
        F.concat(F.lit("20x_"), F.col("l_returnflag"), F.lit("_0"), n.cast("string")))
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag").distinct().withColumn("series_name", name)
    return d.select("l_orderkey", "l_linenumber", "series_name", X.trailing_label(F.col("series_name")).alias("section_label"),
                    X.series_kind(F.col("series_name")).alias("kind"))


@query("b04_map_lookup", """SELECT c_custkey, c_mktsegment, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'diet' WHEN 'BUILDING' THEN 'diet'
  WHEN 'FURNITURE' THEN 'ip' WHEN 'MACHINERY' THEN 'ip' ELSE '' END AS arm FROM customer""")
def _lookup(t):
    arms = {"AUTOMOBILE": "diet", "BUILDING": "diet", "FURNITURE": "ip", "MACHINERY": "ip"}
    return t.customer.select("c_custkey", "c_mktsegment", X.map_lookup(F.col("c_mktsegment"), arms).alias("arm"))


@query("b05_within_tolerance", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  coalesce(abs(l_discount - 0.05::DOUBLE) <= 0.025::DOUBLE AND abs(l_tax - 0.04::DOUBLE) <= 0.025::DOUBLE, false) AS standard,
  coalesce(abs(l_quantity - 25.0::DOUBLE) <= 0.2::DOUBLE * greatest(abs(l_quantity), 25.0::DOUBLE), false) AS relative FROM lineitem""")
def _tol(t):
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             N.within_tol([F.col("l_discount"), F.col("l_tax")], [0.05, 0.04], 0.025).alias("standard"),
                             N.within_tol([q], [25.0], 0.2, relative=True).alias("relative"))


@query("b06_area_um2", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(nullif(l_quantity * p_size, 0) * 0.325::DOUBLE * 0.325::DOUBLE, 1) AS area_um2
FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _area(t):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    N.area_um2(F.col("l_quantity"), F.col("p_size"), F.lit(0.325)).alias("area_um2"))


@query("b07_units_and_time", """SELECT event_id, value / 1000.0::DOUBLE AS value_ms,
  strftime(make_timestamp(epoch_us(ts) // 1000000 * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS acquired FROM events""")
def _units(t):
    epoch = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return t.events.select("event_id", N.us_to_ms(F.col("value")).alias("value_ms"), N.iso_utc(epoch).alias("acquired"))


PRIORITY = {"positive": ("1_urgent", "2_high"), "negative": ("3_medium", "5_low")}


@query("b08_normalise_enum", """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'unresolved' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'positive'
  WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 'negative' ELSE 'error' END AS condition FROM orders""")
def _enum(t):
    raw = F.when(F.col("o_orderkey") % 11 == 0, F.lit("  ")).otherwise(F.initcap(F.col("o_orderpriority")))
    return t.orders.select("o_orderkey", X.normalise_enum(raw, PRIORITY, "unresolved").alias("condition"))


@query("b09_normalise_label", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_quantity < 10 THEN '0' || CAST(l_quantity AS INTEGER) END AS label FROM lineitem""")
def _label(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                             X.normalise_label(F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string"))).alias("label"))


@query("b10_alias_columns", """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderstatus END, o_orderpriority) AS field FROM orders""")
def _alias(t):
    d = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, " nan ").otherwise(F.col("o_orderstatus")).alias("Section"),
                        F.col("o_orderpriority").alias("section_number"))
    return d.select("o_orderkey", X.coalesce_alias(d, ["section_label", "section", "section_number"]).alias("field"))


@query("b12_flags", """SELECT event_id, event_id % 4 IN (0, 1) AS truthy, event_id % 4 IN (0, 3) AS is_flag FROM events""")
def _flags(t):
    words = F.element_at(F.array(F.lit(" YES "), F.lit("1"), F.lit("No"), F.concat(F.lit("see "), F.col("event_type"))), (F.col("event_id") % 4 + 1).cast("int"))
    flag = F.when(F.col("event_id") % 4 == 1, "-").otherwise(words)
    return t.events.select("event_id", X.truthy(words).alias("truthy"), X.is_flag(flag).alias("is_flag"))


@query("b13_join_notes", """SELECT o_orderkey, concat_ws('; ', CASE WHEN o_orderstatus = 'P' THEN 'both boxes' END,
  CASE WHEN o_totalprice > 300000 THEN 'price ' || o_orderpriority END, CASE WHEN o_custkey % 2 = 0 THEN 'even' END) AS notes FROM orders""")
def _notes(t):
    return t.orders.select("o_orderkey", X.join_notes(
        F.when(F.col("o_orderstatus") == "P", "both boxes").otherwise(""),
        F.when(F.col("o_totalprice") > 300000, F.concat(F.lit("price "), F.col("o_orderpriority"))),
        F.when(F.col("o_custkey") % 2 == 0, "even")).alias("notes"))


@query("b14_natural_order", """SELECT p_brand, row_number() OVER (ORDER BY CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER)) AS place FROM (SELECT DISTINCT p_brand FROM part)""")
def _natural(t):
    from ..operators.skew import ordered
    d = t.part.select("p_brand").distinct().withColumn("key", X.natural_key(F.col("p_brand")))
    # The key's digits (their number, then they) order as one number does.
    d = d.withColumn("num", F.regexp_extract("key", r"(\d+)", 1).cast("double"))
    return ordered(d, [], "num", {"before": ("sum", F.lit(1), "before")}, ties=["key"]).select("p_brand", (F.col("before") + 1).alias("place"))


@query("b15_text_tokens_subset", """WITH d AS (SELECT l_orderkey AS k, list(DISTINCT CAST(l_linenumber AS VARCHAR)) AS s FROM lineitem GROUP BY 1)
SELECT o_orderkey, NOT list_contains(s, substr(o_orderpriority, 1, 1)) AS contradicts FROM orders JOIN d ON o_orderkey = k""")
def _tokens(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set(F.col("l_linenumber").cast("string")).alias("s"))
    return t.orders.join(lines, "o_orderkey").select(
        "o_orderkey", (F.size(X.tokens_outside(F.col("o_orderpriority"), r"\b([1-9])\b", F.col("s"))) > 0).alias("contradicts"))


IDS = "29|[3-5][0-9]|60"
_SQL_BARE = r"(^|[^0-9A-Za-z])(29|[3-5][0-9]|60)($|[^0-9A-Za-z])"

#: Every third text gets a planted file name, every fifth a bare number.
_PLANT = """SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' see Image_' || doc_id % 100 || '.vsx' ELSE '' END
  || CASE WHEN doc_id % 5 = 0 THEN ' tube ' || doc_id % 70 || ' K42' ELSE '' END AS text FROM documents"""


def _planted(t):
    k = F.col("doc_id")
    return t.documents.select("doc_id", F.concat(
        "text", F.when(k % 3 == 0, F.concat(F.lit(" see Image_"), (k % 100).cast("string"), F.lit(".vsx"))).otherwise(""),
        F.when(k % 5 == 0, F.concat(F.lit(" tube "), (k % 70).cast("string"), F.lit(" K42"))).otherwise("")).alias("text"))


# DuckDB has no lookaround: neighbours that share one separator are counted after doubling it.
_BARE_LIST = r"regexp_extract_all(regexp_replace(text, '([^0-9A-Za-z])', '\1\1', 'g'), '(^|[^0-9A-Za-z])(29|[3-5][0-9]|60)($|[^0-9A-Za-z])', 2)"


@query("b16_scan_identifiers", f"""SELECT doc_id, len(f) AS n_names, len(b) AS n_bare, array_to_string(f || b, ',') AS hits FROM (
  SELECT doc_id, regexp_extract_all(text, '(?i)image[ _\\-]?[0-9]{{1,4}}') AS f, {_BARE_LIST} AS b FROM ({_PLANT}))""")
def _scan(t):
    d = _planted(t).select("doc_id", X.scan_ids(F.col("text"), IDS, False).alias("f"), X.scan_ids(F.col("text"), IDS).alias("all"))
    return d.select("doc_id", F.size("f").cast("bigint").alias("n_names"), (F.size("all") - F.size("f")).cast("bigint").alias("n_bare"),
                    F.array_join("all", ",").alias("hits"))


@query("b17_scan_path", r"""SELECT page_id, path, len(regexp_extract_all(path, '(?i)image[ _\-]?[0-9]{1,4}')) + len(regexp_extract_all(
  regexp_replace(regexp_extract(path, '([^/]*)$', 1), '([^0-9A-Za-z])', '\1\1', 'g'), '(^|[^0-9A-Za-z])(29|[3-5][0-9]|60)($|[^0-9A-Za-z])', 2)) AS n_hits
FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN url || '/_Image_' || page_id || '_/frame.dat' ELSE url END AS path FROM pages)""")
def _path(t):
    path = F.when(F.col("page_id") % 4 == 0, F.concat("url", F.lit("/_Image_"), F.col("page_id").cast("string"), F.lit("_/frame.dat"))).otherwise(F.col("url"))
    d = t.pages.select("page_id", path.alias("path"))
    return d.select("page_id", "path", F.size(X.scan_path(F.col("path"), IDS)).cast("bigint").alias("n_hits"))


@query("b18_redact", f"""WITH a AS (SELECT doc_id, regexp_replace(text, '(?i)image[ _\\-]?[0-9]{{1,4}}', '<redacted>', 'g') AS text FROM ({_PLANT})),
b AS (SELECT doc_id, regexp_replace(regexp_replace(text, '{_SQL_BARE}', '\\1<redacted>\\3', 'g'), '{_SQL_BARE}', '\\1<redacted>\\3', 'g') AS text FROM a)
SELECT doc_id, sha256(text) AS text_sha, length(text) AS n_chars FROM b""")
def _redact(t):
    d = _planted(t).select("doc_id", X.redact(F.col("text"), IDS).alias("text"))
    return d.select("doc_id", F.sha2("text", 256).alias("text_sha"), F.length("text").cast("bigint").alias("n_chars"))


_NOISE_SQL = r"\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}:\d{2}(?:[.,]\d+)?(?:Z|[+-]\d{2}:?\d{2})?)?|\d{1,2}:\d{2}(?::\d{2})?|\d+[.,]\d+"


@query("b19_mask_numeric_noise", f"""SELECT doc_id, sha256(regexp_replace(text || ' 2026-07-18T23:30:42+00:00 at 9:41, ' || n_chars / 8.0::DOUBLE, '{_NOISE_SQL}', ' ', 'g')) AS masked FROM documents""")
def _noise(t):
    c = F.concat("text", F.lit(" 2026-07-18T23:30:42+00:00 at 9:41, "), (F.col("n_chars") / 8.0).cast("string"))
    return t.documents.select("doc_id", F.sha2(X.mask_numeric_noise(c), 256).alias("masked"))


_VOCAB = ("automobile", "building", "control", "email", "the", "und")


@query("b20_vocabulary_hits", f"""WITH m AS (SELECT doc_id, replace(lower(regexp_replace(text || CASE WHEN doc_id % 4 = 0 THEN ' has_negative_control'
  WHEN doc_id % 4 = 1 THEN ' Extra Control, BUILDING' ELSE '' END,
  '(?i)(?:\\bno[_\\- ]?|\\bhas[_\\- ]?)?(?:negative|positive|neg|pos)[_\\- ]?controls?\\b', ' ', 'g')), '_', ' ') AS x FROM documents)
SELECT doc_id, array_to_string(list_filter([{', '.join(f"CASE WHEN regexp_matches(x, '(^|[^a-z]){w}($|[^a-z])') THEN '{w}' END" for w in _VOCAB)}], lambda v: v IS NOT NULL), ',') AS terms FROM m""")
def _vocab(t):
    k = F.col("doc_id")
    c = F.concat("text", F.when(k % 4 == 0, " has_negative_control").when(k % 4 == 1, " Extra Control, BUILDING").otherwise(""))
    return t.documents.select("doc_id", F.array_join(X.vocabulary_hits(c, _VOCAB), ",").alias("terms"))


@query("b21_string_leaves", """SELECT event_id, 'spec.kind' AS json_path, event_type AS text FROM events
UNION ALL SELECT event_id, 'spec.images[' || i || '].name', event_type || '_' || i FROM events, (VALUES (0), (1)) v(i)
UNION ALL SELECT event_id, 'props.' || 'k', json_extract_string(props, '$.k') FROM events""")
def _leaves(t):
    e = F.col("event_type")
    image = lambda i: F.struct(F.concat(e, F.lit(f"_{i}")).alias("name"), F.lit(i).alias("n"))
    d = t.events.select("event_id", F.struct(e.alias("kind"), F.array(image(0), image(1)).alias("images")).alias("spec"),
                        F.from_json("props", "map<string,string>").alias("props"))
    return X.string_leaves(d, ["event_id"])


@query("b22_canonical_name", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN 'Tissue' WHEN o_orderkey % 4 = 2 THEN 'Isocortex' END AS region FROM orders""")
def _canon(t):
    raw = F.element_at(F.array(*[F.lit(v) for v in ("Tisssue", " TISSUE", "isocortes", "lobe")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select("o_orderkey", X.canonical_name(raw, {
        "tissue": "Tissue", "tisssue": "Tissue", "hippocampus": "Hippocampus", "isocortex": "Isocortex",
        "isocortes": "Isocortex", "cortex": "Isocortex"}).alias("region"))


@query("b23_column_policy", """SELECT c_custkey AS code, o_orderstatus AS condition, 'code,condition' AS kept, 'group,scan_path,tube_id,unlisted' AS dropped FROM orders JOIN customer ON o_custkey = c_custkey""")
def _policy(t):
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("code"), F.col("o_orderstatus").alias("condition"), F.col("c_mktsegment").alias("group"),
        F.col("o_orderkey").alias("tube_id"), F.col("o_orderpriority").alias("scan_path"), F.col("o_totalprice").alias("unlisted"))
    out, report = split_columns(d, allow=("code", "condition", "scan_path"))
    kept = ",".join(sorted(c for c, k, _ in report if k))
    dropped = ",".join(sorted(c for c, k, _ in report if not k))
    return out.withColumn("kept", F.lit(kept)).withColumn("dropped", F.lit(dropped))


@query("b24_coarsen", "SELECT c_custkey, round(c_acctbal, -2) + 0.0::DOUBLE AS bal FROM customer")
def _coarsen(t):
    return t.customer.select("c_custkey", rnd(N.coarsen(F.col("c_acctbal"), -2), 6).alias("bal"))
