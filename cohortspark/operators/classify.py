"""Trained pixel classes and the entity-level split of a cohort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import GROUP_LIMIT, permutation_index
from .summarise import attach


def pool_samples(*frames: DataFrame) -> DataFrame:
    """Labelled pixels of several images as one training table, tagged by image order."""
    out = None
    for i, f in enumerate(frames):
        f = f.withColumn("sample", F.lit(i))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def train_forest(samples: DataFrame, features: Sequence[str], label: str, trees: int = 50, depth: int = 8, seed: int = 1) -> PipelineModel:
    """Random forest over multiscale features; rows with a missing feature are left out."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"),
              RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)]
    return Pipeline(stages=stages).fit(samples.withColumn(label, F.col(label).cast("double")))


def apply_forest(model: PipelineModel, px: DataFrame) -> DataFrame:
    return model.transform(px).drop("features", "rawPrediction", "probability")


def stratified_split(entities: DataFrame, key: str, stratum: str, shares: Mapping[str, float], seed: str, *, limit: int = GROUP_LIMIT) -> DataFrame:
    """Whole entities to named parts: each stratum is cut in its seeded random order, so
    shares hold inside every stratum and an entity is never divided."""
    d = entities.select(key, stratum).distinct()
    placed = permutation_index(d, key, seed=seed, by=[stratum], limit=limit)
    n = d.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n"))
    at = (F.col("pos") + 0.5) / F.col("_n")
    total, part = 0.0, None
    for name, share in list(shares.items())[:-1]:
        total = round(total + share, 12)
        part = F.when(at < total, name) if part is None else part.when(at < total, name)
    last = list(shares)[-1]
    return attach(placed, n, [stratum]).select(key, stratum, (part.otherwise(last) if part is not None else F.lit(last)).alias("split"))
