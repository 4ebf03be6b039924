"""Writers: artefact sets, gated output, per-key layout, append-only logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blinding import destroy_order
from ..session import exists, remove


def run_header(df: DataFrame, entity: str, condition: str = "condition") -> DataFrame:
    """One row: rows, entities and counts by condition."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(entity).alias("n_entities"),
        *[F.count_if(F.col(condition) == c).alias(f"n_{c}") for c in ("positive", "negative", "unresolved")])


def write_artifacts(df: DataFrame, problems: DataFrame, folder: str, entity: str, mode: str = "errorifexists") -> None:
    """Full table, analysis subset, problems and run header; the others read the table as written."""
    df.write.mode(mode).parquet(f"{folder}/manifest")
    kept = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/manifest")
    kept.where(F.coalesce("analysis_include", F.lit(False))).write.mode(mode).parquet(f"{folder}/analysis")
    problems.write.mode(mode).json(f"{folder}/problems")
    run_header(kept, entity).write.mode(mode).json(f"{folder}/header")


def write_blinded(private: DataFrame, blinded: DataFrame, key: DataFrame, findings: DataFrame, private_dir: str, blinded_dir: str) -> None:
    """Write both sides, or nothing: any LEAK, any existing part or nested folders refuse.

    The blinded side comes last, so it stands only beside a whole private one; what a failure
    leaves of the parts is removed.
    """
    a, b = private_dir.rstrip("/") + "/", blinded_dir.rstrip("/") + "/"
    if a.startswith(b) or b.startswith(a):
        raise ValueError("private and blinded folders must not contain each other")
    worst = findings.where(F.col("severity") == "LEAK").limit(5).collect()
    if worst:
        raise ValueError(f"blinding refused: {[(r['check'], r['column']) for r in worst]}")
    spark = key.sparkSession
    parts = [f"{private_dir}/{n}" for n in ("key", "provenance", "findings")] + [f"{blinded_dir}/blinded"]
    there = [p for p in parts if exists(spark, p)]
    if there:
        raise ValueError(f"already there: {there}")
    try:
        key.write.parquet(parts[0])
        private.write.parquet(parts[1])
        findings.write.json(parts[2])
        destroy_order(blinded).write.parquet(parts[3])
    except Exception:
        for p in parts:
            remove(spark, p)
        raise


def write_by(df: DataFrame, keys: Sequence[str], folder: str, *, spread: int = 1, mode: str = "errorifexists") -> None:
    """One folder per key value. ``spread`` salts the shuffle so that a key with very many
    rows is written by several tasks."""
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c not in keys]), F.lit(spread))
    df.repartition(*keys, salt).write.mode(mode).partitionBy(*keys).parquet(folder)


def append_rows(df: DataFrame, folder: str) -> None:
    df.write.mode("append").parquet(folder)
