"""Query of the language identification; a trained model has no SQL twin, so tests hold it against held-out labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .language_id import held_out, identify, train
from .registry import query, table


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    models = train(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), models).select("doc_id", "held_out", "lang_pred", "score", "family_pred")
