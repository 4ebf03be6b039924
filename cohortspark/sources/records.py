"""Readers for delimited records, reports and key files: explicit schemas, no inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_record(spark: SparkSession, path: str, key: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """All-text reader: every cell trimmed, rows with a blank key dropped, key kept as text.

    ``record_problems`` says whether the key is usable; ``cast_key`` makes it a number.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", True).option("sep", sep).option("enforceSchema", False).csv(path)
    return trim_cells(raw, key)


def trim_cells(raw: DataFrame, key: str) -> DataFrame:
    cells = raw.select(*[F.trim(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in raw.columns])
    return cells.where(F.col(key) != "")


def record_problems(record: DataFrame, key: str) -> DataFrame:
    """Structural problems of a record: keys that are not whole numbers or occur twice."""
    value = F.col(key).try_cast("bigint")
    bad = record.where(value.isNull()).select(F.col(key).alias("key"), F.lit("key is not a whole number").alias("problem"))
    twice = record.where(value.isNotNull()).groupBy(value.cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return bad.unionByName(twice.select("key", F.lit("duplicate key").alias("problem")))


def cast_key(record: DataFrame, key: str) -> DataFrame:
    return record.withColumn(key, F.col(key).try_cast("bigint"))


def read_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Round-trip reader: labels stay text, missing text becomes '', the rest keeps its type."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return blank_text(df)


def blank_text(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna("", subset=text) if text else df


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A side table that may be absent: no file is an empty table, not an error."""
    if path_exists(spark, path):
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.createDataFrame([], schema)


REPORT_SCHEMA = (
    "datasets array<struct<index_path:string,index_sha256:string,ok:boolean,"
    "stacks:array<struct<role:string,section:string,sha256:string>>>>"
)


def flatten_report(reports: DataFrame, column: str | None = None) -> DataFrame:
    """Nested verification report to ``index_path, section, sha256, verified_ok`` rows."""
    parsed = reports.select(F.from_json(column, REPORT_SCHEMA).alias("r")).select("r.*") if column else reports
    d = parsed.select(F.explode("datasets").alias("d")).where(F.coalesce("d.index_path", F.lit("")) != "")
    s = d.select("d.index_path", "d.index_sha256", F.col("d.ok").alias("verified_ok"), F.explode("d.stacks").alias("s"))
    return s.where((F.col("s.role") == "tissue") & (F.coalesce("s.section", F.lit("")) != "")).select(
        "index_path", "index_sha256", F.col("s.section").alias("section"), F.col("s.sha256").alias("sha256"), "verified_ok")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return flatten_report(spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(path))


def explode_key(df: DataFrame, column: Column, *keep: str) -> DataFrame:
    """Map-shaped key text ``{id: code}`` to ``id, code`` rows."""
    return df.select(*keep, F.explode(F.from_json(column, "map<string,string>")).alias("id", "code"))


def read_key(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("wholetext", True).text(path)
    inner = F.coalesce(F.get_json_object("value", "$.codes"), F.col("value"))
    return explode_key(text.select(inner.alias("value")), F.col("value"))


SERIES_SCHEMA = (
    "array<struct<section_label:string,series_name:string,stage_x_um:double,stage_y_um:double,"
    "width_px:bigint,height_px:bigint,pixel_size_um:double,exposure_ms:map<string,double>>>"
)


def series_table(slides: DataFrame, keys: Sequence[str], series: str = "series", channels: Sequence[str] = ("DAPI", "FITC", "Cy3")) -> DataFrame:
    """One row per image series of a slide, its exposure map spread into columns."""
    d = slides.select(*keys, F.explode(series).alias("s"))
    fields = [f.name for f in d.schema["s"].dataType.fields if f.name != "exposure_ms"]
    return d.select(*keys, *[F.col("s")[f].alias(f) for f in fields],
                    *[F.try_element_at(F.col("s")["exposure_ms"], F.lit(c)).alias(f"exposure_{c}_ms") for c in channels])


#: Bytes of a file whose content may stand in a row.
WHOLE_FILE = 64 << 20


def file_inventory(spark: SparkSession, path: str, pattern: str = "*", digest: bool = True, whole_file: int = WHOLE_FILE) -> DataFrame:
    """One row per file. Without the digest the file content is never read.

    Files of at most ``whole_file`` bytes are read by Spark, a file a row; larger ones are streamed in blocks (``streamed_digests``). A SHA-256
    runs through a file from its first byte to its last, so one task reads each file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    base = files.select("path", F.col("length").alias("n_bytes"))
    if not digest:
        return base
    small = files.where(F.col("length") <= whole_file).select("path", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))
    return small.unionByName(streamed_digests(base.where(F.col("n_bytes") > whole_file)))


def streamed_digests(files: DataFrame, path: str = "path", chunk_bytes: int = 8 << 20, tasks: int = 64) -> DataFrame:
    """SHA-256 of files of any size, read in chunks on the executors (shared file system)."""

    def run(batches):
        import hashlib

        import pyarrow.fs as pafs

        for pdf in batches:
            out = []
            for uri in pdf[path]:
                # Spark's names of local files are not escaped, as those of a URI would be.
                local = uri.startswith("file:/")
                fs, name = (pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")) if local else pafs.FileSystem.from_uri(uri)
                h = hashlib.sha256()
                with fs.open_input_stream(name) as stream:
                    while block := stream.read(chunk_bytes):
                        h.update(block)
                out.append(h.hexdigest())
            yield pdf.assign(sha256=out)

    fields = T.StructType([*files.schema.fields, T.StructField("sha256", T.StringType())])
    return files.repartition(tasks, path).mapInPandas(run, fields)


def index_stem(path: Column) -> Column:
    """File name without its extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def payload_stem(name: Column) -> Column:
    """Stem a payload folder belongs to: ``_stem_``, ``_stem`` or ``stem``."""
    return F.regexp_replace(F.regexp_replace(name, "^_", ""), "_$", "")


def pair_payload(index: DataFrame, folders: DataFrame, path: str = "path", name: str = "name", group: str | None = None) -> DataFrame:
    """Pair index files with payload folders by exact stem; a missing payload is NULL.

    The preferred spelling wins: ``_stem_``, then ``_stem``, then ``stem``.
    """
    keys = ["_stem", *([group] if group else [])]
    f = folders.withColumn("_stem", payload_stem(F.col(name))).withColumn(
        "_order", F.when(F.col(name).rlike("^_.*_$"), 0).when(F.col(name).startswith("_"), 1).otherwise(2))
    best = f.groupBy(*keys).agg(F.min(F.struct("_order", name))[name].alias("payload"))
    return index.withColumn("_stem", index_stem(F.col(path))).join(best, keys, "left").drop("_stem")
