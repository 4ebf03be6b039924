"""Sources and sinks on the test tables. Round trips write to a folder of their own."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import classify_file
from ..operators.skew import hash_key
from ..sources import records as R
from ..sources import sinks as S
from ..sources.regions import parse_regions
from ..session import new_folder
from ..sources.tiles import decode_tile_index, read_tile_index
from .registry import query, rnd
from .shapes import SCANS, scans


def _folder(t, name: str) -> str:
    return new_folder(t.spark, name)


@query("a01_read_record", "SELECT o_orderkey AS tube_id, o_orderstatus AS box, o_orderpriority AS note FROM orders")
def _record(t):
    path = _folder(t, "record")
    pad = lambda c: F.concat(F.lit(" "), c.cast("string"), F.lit("  "))
    t.orders.select(pad(F.col("o_orderkey")).alias("tube_id"), pad(F.col("o_orderstatus")).alias("box"),
                    pad(F.col("o_orderpriority")).alias("note")).write.option("header", True).csv(path)
    return R.cast_key(R.read_record(t.spark, path, "tube_id", ["tube_id", "box", "note"]), "tube_id")


@query("a01_record_problems", """SELECT CAST(k AS VARCHAR) AS key, 'duplicate key' AS problem FROM (SELECT o_custkey AS k FROM orders WHERE o_orderstatus <> 'P')
GROUP BY k HAVING count(*) > 1 UNION ALL SELECT o_orderpriority, 'key is not a whole number' FROM orders WHERE o_orderstatus = 'P'""")
def _problems(t):
    key = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))
    return R.record_problems(R.trim_cells(t.orders.select(key.alias("k")), "k"), "k")


@query("a02_typed_round_trip", f"""WITH {SCANS} SELECT slide, scan, section_label, CASE WHEN flag = 'R' THEN '' ELSE flag END AS flag,
  CASE WHEN qty > 20 THEN CAST(qty AS BIGINT) END AS n, qty > 20 AS big FROM scn""")
def _typed(t):
    path = _folder(t, "typed")
    d = scans(t).select("slide", "scan", "section_label", F.when(F.col("flag") != "R", F.col("flag")).alias("flag"),
                        F.when(F.col("qty") > 20, F.col("qty").cast("bigint")).alias("n"), (F.col("qty") > 20).alias("big"))
    d.write.option("header", True).csv(path)
    return R.read_typed(t.spark, path, d.schema)


@query("a03_optional_table", "SELECT c_custkey, '' AS treatment FROM customer")
def _optional(t):
    schema = T.StructType.fromDDL("c_custkey bigint, treatment string")
    side = R.read_optional(t.spark, f"{t.folder}/no-such-table", schema)
    return t.customer.select("c_custkey").join(side, "c_custkey", "left").fillna("", subset=["treatment"])


@query("a04_flatten_report", """SELECT '/raw/' || o_orderkey AS index_path, sha256(CAST(o_orderkey AS VARCHAR)) AS index_sha256, '01' AS section,
  sha256(o_orderpriority) AS sha256, o_orderstatus = 'F' AS verified_ok FROM orders
UNION ALL SELECT '/raw/' || o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)), '02', NULL, o_orderstatus = 'F' FROM orders WHERE o_orderstatus <> 'P'""")
def _report(t):
    k = F.col("o_orderkey").cast("string")
    stack = lambda role, sec, sha: F.struct(role.alias("role"), F.lit(sec).alias("section"), sha.alias("sha256"))
    tissue_or_label = F.when(F.col("o_orderstatus") == "P", "label").otherwise("tissue")
    d = F.struct(F.concat(F.lit("/raw/"), k).alias("index_path"), F.sha2(k, 256).alias("index_sha256"),
                 (F.col("o_orderstatus") == "F").alias("ok"),
                 F.array(stack(F.lit("tissue"), "01", F.sha2("o_orderpriority", 256)),
                         stack(tissue_or_label, "02", F.lit(None).cast("string"))).alias("stacks"))
    reports = t.orders.select(F.to_json(F.struct(F.array(d).alias("datasets"))).alias("report"))
    return R.flatten_report(reports, "report")


@query("a05_key_map", "SELECT event_id, 'k' AS id, json_extract_string(props, '$.k') AS code FROM events")
def _key(t):
    return R.explode_key(t.events, F.col("props"), "event_id")


@query("a06_region_reader", """SELECT p_partkey, CAST(0 AS INTEGER) AS feature_no, p_type AS raw_name, CAST(0 AS INTEGER) AS polygon_no, CAST(1 AS INTEGER) AS n_rings, CAST(4 AS INTEGER) AS n_points FROM part
UNION ALL SELECT p_partkey, 1, '', 0, 1, 4 FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_partkey, 1, '', 1, 1, 4 FROM part WHERE p_size % 2 = 0""")
def _regions(t):
    s = F.col("p_size").cast("string")
    ring = F.concat(F.lit("[[[0,0],["), s, F.lit(",0],["), s, F.lit(","), s, F.lit("],[0,0]]]"))
    one = F.concat(F.lit('{"type":"Feature","properties":{"name":" '), F.col("p_type"), F.lit(' "},"geometry":{"type":"Polygon","coordinates":'), ring, F.lit("}}"))
    two = F.concat(F.lit('{"type":"Feature","properties":{},"geometry":{"type":"MultiPolygon","coordinates":['), ring, F.lit(","), ring, F.lit("]}}"))
    text = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('{"type":"FeatureCollection","features":['), one, F.lit(","), two, F.lit("]}"))).otherwise(
        F.concat(F.lit("["), one, F.lit("]")))
    d = parse_regions(t.part.select("p_partkey", text.alias("v")), "p_partkey", "v")
    return d.select("p_partkey", "feature_no", "raw_name", "polygon_no", F.size("rings").alias("n_rings"), F.size(F.col("rings")[0]).alias("n_points"))


@query("a07_file_inventory")
def _inventory(t):
    return R.file_inventory(t.spark, t.folder, "*.parquet").select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "n_bytes", "sha256")


def _written(t):
    """A file a nation, in a folder of its key."""
    folder = _folder(t, "names")
    t.nation.select("n_nationkey", "n_name").write.partitionBy("n_nationkey").text(folder)
    return folder, F.regexp_extract("path", r"n_nationkey=(\d+)", 1).cast("bigint").alias("n_nationkey")


_WRITTEN = "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(strlen(n_name) + 1 AS BIGINT) AS n_bytes, sha256(n_name || chr(10)) AS sha256 FROM nation"


@query("a07_written_files", _WRITTEN)
def _written_files(t):
    folder, key = _written(t)
    return R.file_inventory(t.spark, folder, "*.txt").select(key, "n_bytes", "sha256")


@query("a07_streamed_digests", _WRITTEN)
def _streamed(t):
    folder, key = _written(t)
    return R.streamed_digests(R.file_inventory(t.spark, folder, "*.txt", digest=False), tasks=4).select(key, "n_bytes", "sha256")


@query("a07_content_digests", "SELECT doc_id, sha256(text) AS digest, CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents")
def _digests(t):
    return t.documents.select("doc_id", F.sha2("text", 256).alias("digest"), F.octet_length("text").cast("bigint").alias("n_bytes"))


_FILES = """SELECT page_id, url, CASE page_id % 7 WHEN 0 THEN 'frame_t.dat' WHEN 1 THEN 'blob_' || page_id || '_f.meta' WHEN 2 THEN '.DS_Store'
  WHEN 3 THEN 'frame_t (conflicted copy).dat' WHEN 4 THEN 'frame_t_0.dat' WHEN 5 THEN 'Thumbs.db' ELSE regexp_extract(url, '([^/]*)$', 1) END AS name FROM pages"""


@query("a08_file_roles", f"""SELECT page_id, name, CASE WHEN regexp_matches(name, '^\\.DS_Store$|^\\._|^(?i:thumbs\\.db)$') THEN 'ignored' WHEN name IN ('frame_t.dat', 'frame_t_0.dat') THEN 'data'
  WHEN regexp_matches(name, '^blob_\\d+_f\\.meta$') THEN 'auxiliary' WHEN regexp_matches(name, '(?i)conflicted copy|- *conflict') THEN 'conflict' ELSE 'unexpected' END AS file_role FROM ({_FILES})""")
def _roles(t):
    k = F.col("page_id")
    m = k % 7
    name = (F.when(m == 0, "frame_t.dat").when(m == 1, F.concat(F.lit("blob_"), k.cast("string"), F.lit("_f.meta"))).when(m == 2, ".DS_Store")
            .when(m == 3, "frame_t (conflicted copy).dat").when(m == 4, "frame_t_0.dat").when(m == 5, "Thumbs.db")
            .otherwise(F.regexp_extract("url", "([^/]*)$", 1)))
    d = t.pages.select("page_id", name.alias("name"))
    return d.withColumn("file_role", classify_file(F.col("name"), ("frame_t.dat", "frame_t_0.dat"), r"^blob_\d+_f\.meta$",
                                                   r"^\.DS_Store$|^\._|^(?i:thumbs\.db)$", r"(?i)conflicted copy|- *conflict"))


@query("a09_exact_stem_pairing", """WITH f AS (SELECT DISTINCT l_partkey AS k, CASE l_partkey % 3 WHEN 0 THEN '_Image_' || l_partkey || '_' WHEN 1 THEN '_Image_' || l_partkey ELSE 'Image_' || l_partkey END AS name
  FROM lineitem WHERE l_quantity > 40)
SELECT p_partkey, '/raw/Image_' || p_partkey || '.idx' AS path, name AS payload FROM part LEFT JOIN f ON k = p_partkey""")
def _pairing(t):
    k = F.col("l_partkey")
    stem = F.concat(F.lit("Image_"), k.cast("string"))
    name = F.when(k % 3 == 0, F.concat(F.lit("_"), stem, F.lit("_"))).when(k % 3 == 1, F.concat(F.lit("_"), stem)).otherwise(stem)
    folders = t.lineitem.where("l_quantity > 40").select(name.alias("name")).distinct()
    index = t.part.select("p_partkey", F.concat(F.lit("/raw/Image_"), F.col("p_partkey").cast("string"), F.lit(".idx")).alias("path"))
    return R.pair_payload(index, folders)


def _le(c, nbytes):
    """Little-endian hex of a non-negative integer column."""
    h = F.lpad(F.hex(c.cast("bigint")), 2 * nbytes, "0")
    return F.concat(*[F.substring(h, 2 * (nbytes - i) - 1, 2) for i in range(nbytes)])


@query("a10_tile_index", """SELECT 'tile-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS path, CAST(NULL AS VARCHAR) AS problem, CAST(l_partkey % 32 AS INTEGER) AS col, CAST(l_suppkey % 32 AS INTEGER) AS row,
  CAST(l_linenumber % 3 AS INTEGER) AS channel, CAST(CAST(l_quantity AS BIGINT) % 4 AS INTEGER) AS level, l_orderkey AS "offset", CAST(l_quantity AS INTEGER) AS nbytes, CAST(4 AS INTEGER) AS pixel_type
FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT 'tile-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, 'chunk table runs past the end of the file', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM lineitem WHERE l_returnflag = 'R'""")
def _tiles(t):
    c = F.col
    z = lambda n: F.lit("00" * n)
    record = F.concat(z(4), _le(c("l_partkey") % 32, 4), _le(c("l_suppkey") % 32, 4), _le(c("l_linenumber") % 3, 4),
                      _le(c("l_quantity").cast("bigint") % 4, 4), _le(c("l_orderkey"), 8), _le(c("l_quantity"), 4), z(4))
    n = F.when(c("l_returnflag") == "R", 2).otherwise(1)
    head = F.concat(F.lit("53495300"), z(4), _le(F.lit(1), 4), _le(F.lit(4), 4), _le(F.lit(64), 8), z(8), _le(F.lit(104), 8), _le(n, 4), z(20))
    block = F.concat(F.lit("45545300"), z(4), *[_le(F.lit(v), 4) for v in (4, 1, 1, 2, 90, 512, 512, 1)])
    name = F.concat_ws("-", F.lit("tile"), c("l_orderkey").cast("string"), c("l_linenumber").cast("string"), c("l_partkey").cast("string"), c("l_suppkey").cast("string"))
    files = t.lineitem.select(name.alias("path"), F.unhex(F.concat(head, block, record)).alias("content"))
    return decode_tile_index(files).select("path", "problem", "col", "row", "channel", "level", "offset", "nbytes", "pixel_type")


#: A container a supplier: a chunk record a line, behind it payload that nobody needs to read.
PAYLOAD = 200_000


@query("a10_ranged_reads", f"""WITH f AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT CAST(l_suppkey AS BIGINT) AS supplier, 104 + n * 36 + {PAYLOAD} AS file_bytes, CAST(l_partkey % 32 AS INTEGER) AS col, CAST(l_orderkey % 1000 AS INTEGER) AS row, CAST(l_linenumber % 3 AS INTEGER) AS channel,
  CAST(CAST(l_quantity AS BIGINT) % 4 AS INTEGER) AS level, l_orderkey AS "offset", CAST(l_quantity AS INTEGER) AS nbytes, CAST(512 AS INTEGER) AS tile_x FROM lineitem JOIN f USING (l_suppkey)""")
def _ranged(t):
    import struct

    folder = _folder(t, "containers")

    def write(table):
        import os

        import pyarrow as pa
        import pyarrow.fs as pafs

        n, key = table.num_rows, table["k"][0].as_py()
        head = b"SIS\0" + bytes(4) + struct.pack("<II", 1, 4) + struct.pack("<QQQI", 64, 0, 104, n) + bytes(20)
        block = b"ETS\0" + bytes(4) + struct.pack("<8i", 4, 1, 1, 2, 90, 512, 512, 1)
        store, name = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(name, recursive=True)
        with store.open_output_stream(os.path.join(name, f"frame-{key}.dat")) as out:
            out.write(head + block + b"".join(struct.pack("<i4iQii", 0, *row, 0) for row in zip(*(table[c].to_pylist() for c in ("col", "row", "channel", "level", "at", "size")), strict=True)))
            out.write(bytes(PAYLOAD))
        return pa.table({"n": [n]})

    c = F.col
    lines = t.lineitem.select(c("l_suppkey").alias("k"), (c("l_partkey") % 32).alias("col"), (c("l_orderkey") % 1000).alias("row"), (c("l_linenumber") % 3).alias("channel"),
                              (c("l_quantity").cast("bigint") % 4).alias("level"), c("l_orderkey").alias("at"), c("l_quantity").cast("int").alias("size"))
    lines.groupBy("k").applyInArrow(write, "n bigint").agg(F.sum("n")).collect()
    d = read_tile_index(t.spark, folder, ".dat")
    return d.select(F.regexp_extract("path", r"frame-(\d+)\.dat$", 1).cast("bigint").alias("supplier"), "file_bytes", "col", "row", "channel", "level", "offset", "nbytes", "tile_x")


@query("a11_series_table", """SELECT o_orderkey, CASE i WHEN 0 THEN '01' ELSE '02' END AS section_label, round(o_totalprice + i, 6) + 0.0 AS stage_x_um, 128.5::DOUBLE AS exposure_DAPI_ms,
  CASE WHEN i = 1 THEN o_custkey::DOUBLE END AS exposure_FITC_ms, NULL::DOUBLE AS exposure_Cy3_ms FROM orders, (VALUES (0), (1)) v(i)""")
def _series(t):
    def one(i):
        m = F.create_map(F.lit("DAPI"), F.lit(128.5), *([F.lit("FITC"), F.col("o_custkey").cast("double")] if i else []))
        return F.struct(F.lit(f"0{i + 1}").alias("section_label"), (F.col("o_totalprice") + i).alias("stage_x_um"), m.alias("exposure_ms"))
    d = t.orders.select("o_orderkey", F.array(one(0), one(1)).alias("series"))
    return R.series_table(d, ["o_orderkey"]).withColumn("stage_x_um", rnd(F.col("stage_x_um")))


@query("a12_run_header", """SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_entities, count(*) FILTER (o_orderstatus = 'F') AS n_positive,
  count(*) FILTER (o_orderstatus = 'O') AS n_negative, count(*) FILTER (o_orderstatus = 'P') AS n_unresolved FROM orders""")
def _header(t):
    c = F.when(F.col("o_orderstatus") == "F", "positive").when(F.col("o_orderstatus") == "O", "negative").otherwise("unresolved")
    return S.run_header(t.orders.withColumn("condition", c), "o_custkey")


@query("a12_artifact_set", """SELECT o_orderkey, o_orderstatus <> 'P' AS analysis_include FROM orders WHERE o_orderstatus <> 'P'""")
def _artifacts(t):
    path = _folder(t, "artifacts")
    c = F.when(F.col("o_orderstatus") == "F", "positive").when(F.col("o_orderstatus") == "O", "negative").otherwise("unresolved")
    d = t.orders.select("o_orderkey", "o_custkey", c.alias("condition"), (F.col("o_orderstatus") != "P").alias("analysis_include"))
    S.write_artifacts(d, d.where("condition = 'unresolved'").select("o_orderkey"), path, "o_custkey")
    return t.spark.read.parquet(f"{path}/analysis").select("o_orderkey", "analysis_include")


@query("a13_gated_blinded_output", "SELECT c_custkey % 7 AS region, c_acctbal AS value FROM customer")
def _gated(t):
    path = _folder(t, "gated")
    d = t.customer.select(hash_key(F.col("c_custkey"), seed="gate").alias("code"), "c_custkey", (F.col("c_custkey") % 7).alias("region"), F.col("c_acctbal").alias("value"))
    findings = t.customer.where("c_custkey < 0").select(F.lit("LEAK").alias("severity"), F.lit("x").alias("check"), F.lit("y").alias("column"))
    S.write_blinded(d, d.select("code", "region", "value"), d.select("c_custkey", "code"), findings, f"{path}/private", f"{path}/blinded")
    return t.spark.read.parquet(f"{path}/blinded/blinded").select("region", "value")


@query("a14_partitioned_output", "SELECT l_returnflag AS region, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY 1")
def _partitioned(t):
    path = _folder(t, "regions")
    S.write_by(t.lineitem.withColumnRenamed("l_returnflag", "region"), ["region"], path, spread=4)
    return t.spark.read.parquet(path).groupBy("region").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("l_quantity"), 2).alias("qty"))


@query("a15_append_log", "SELECT event_id, value FROM events")
def _append(t):
    path = _folder(t, "log")
    for flag in (0, 1):
        S.append_rows(t.events.where(F.col("event_id") % 2 == flag).select("event_id", "value"), path)
    return t.spark.read.parquet(path)
