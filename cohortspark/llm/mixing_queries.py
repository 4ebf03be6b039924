"""Query of the mixing; a trained model has no SQL twin, so tests hold it against held-out labels and a plain solver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .mixing import label_domains, mix
from .registry import query, table

TARGETS = {"good": 0.9, "poor": 0.1, "toxic": 0.0}


@query("op6_mixing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = mix(table(spark, folder, "documents").select("doc_id", "text"), label_domains(table(spark, folder, "labels")), TARGETS)
    shares = [F.get("posterior", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(TARGETS)]
    return found.select("doc_id", "n_tokens", "domain", *shares, "rate", "copies")
