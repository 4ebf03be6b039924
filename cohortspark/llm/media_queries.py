"""Query of the media columns; tests hold it against exact round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .media import BLOCK, load_media, store_texts
from .registry import query, table


@query("op4_media")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    stored = store_texts(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    found = load_media(stored, tensors=False)
    size = F.octet_length("payload").cast("bigint")
    return found.select("doc_id", "n_bytes", size.alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
                        F.crc32(F.substring("payload", -BLOCK, BLOCK)).alias("tail_crc32"), F.octet_length("media").cast("bigint").alias("media_bytes"),
                        F.sha2("media", 256).alias("media_sha256"), "feature")
