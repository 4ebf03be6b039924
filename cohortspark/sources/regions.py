"""Region files: a feature collection or a bare list of features, as edge-ready rings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FEATURE = "struct<properties:struct<name:string>,geometry:struct<type:string,coordinates:string>>"


def parse_regions(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, feature_no, raw_name, polygon_no, rings``: one row per polygon; ring 0 is the
    outline and the others are holes."""
    bare = F.ltrim(F.col(text)).startswith("[")
    collection = F.from_json(text, f"struct<features:array<{_FEATURE}>>")["features"]
    features = F.when(bare, F.from_json(text, f"array<{_FEATURE}>")).otherwise(collection)
    f = df.select(key, F.posexplode(features).alias("feature_no", "f"))
    coords = F.col("f.geometry.coordinates")
    rings = "array<array<array<double>>>"
    polygons = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json(coords, rings))).otherwise(
        F.from_json(coords, f"array<{rings}>"))
    return f.where(F.col("f.geometry.type").isin("Polygon", "MultiPolygon")).select(
        key, "feature_no", F.trim(F.coalesce("f.properties.name", F.lit(""))).alias("raw_name"),
        F.posexplode(polygons).alias("polygon_no", "rings"))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    return parse_regions(text, "file", "value")
