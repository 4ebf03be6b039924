"""Set operations on rows and on groupings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_scans(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column absent from one frame is NULL there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def inventory_difference(observed: DataFrame, expected: DataFrame, key: str, mandatory: DataFrame | None = None) -> DataFrame:
    """Unexpected keys seen, and mandatory keys missing: ``key, finding``."""
    seen, known = observed.select(key).distinct(), expected.select(key).distinct()
    extra = seen.join(known, key, "left_anti").withColumn("finding", F.lit("unexpected"))
    need = (mandatory if mandatory is not None else expected).select(key).distinct()
    return extra.unionByName(need.join(seen, key, "left_anti").withColumn("finding", F.lit("missing")))


def partition_relation(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: do groupings by ``a`` and ``b`` give the same cells, or only b-pure cells."""
    pairs = df.select(F.col(a).alias("_a"), F.col(b).alias("_b")).distinct()
    impure = lambda x: pairs.groupBy(x).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("cells"), F.max("n").alias("worst"))
    pa, pb = impure("_a"), impure("_b")
    return pa.select("cells", "worst").withColumn("k", F.lit(1)).join(
        pb.select(F.col("cells").alias("cells_b"), F.col("worst").alias("worst_b")).withColumn("k", F.lit(1)), "k"
    ).select(
        F.col("cells").alias("n_cells_a"), F.col("cells_b").alias("n_cells_b"),
        (F.col("worst") == 1).alias("refines"), ((F.col("worst") == 1) & (F.col("worst_b") == 1)).alias("equal"),
    )


def first_groups(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows of the first ``n`` groups in key order (a limit on groups, not rows)."""
    chosen = df.select(*keys).distinct().orderBy(*keys).limit(n)
    return df.join(F.broadcast(chosen), list(keys), "left_semi")


def schema_missing(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]
