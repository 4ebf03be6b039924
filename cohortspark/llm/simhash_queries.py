"""Query of the SimHash near-duplicates; XXH64 is not at hand in the SQL twin, so tests hold it against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .simhash import near_duplicates


@query("op8_simhash")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"), words=4, radius=4)
    return found.select(F.col("doc").alias("doc_id"), F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
