"""Query of the role repair: one row a turn, with its share of the rendered conversation; tests hold it against all repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .roles import Costs, repair


@query("op9_roles")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = repair(table(spark, folder, "conversations"), costs=Costs(end={"user": 2, "system": 4}))
    return found.select(F.col("conv").cast("bigint").alias("conv_id"), "turn", "role", "action", "new_role", F.array_join("inserted", ",").alias("inserted"), "cost", "rendered")
