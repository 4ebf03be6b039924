"""Rank statistics and cohort statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import GROUP_LIMIT, mid_ranks, ordered, percentiles
from .summarise import attach


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = (), *, limit: int = GROUP_LIMIT) -> DataFrame:
    """Rank correlation with average ranks: ``by, n, rho`` (0 when it is not defined).

    Rows are first reduced to distinct ``(x, y)`` pairs with counts.
    """
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(x).alias("_x"), F.col(y).alias("_y"))
    keys = list(by) or ["_all"]
    if not by:
        d = d.withColumn("_all", F.lit(0))
    pairs = d.groupBy(*keys, "_x", "_y").agg(F.count(F.lit(1)).alias("_w"))
    rx = mid_ranks(d, keys, "_x", limit=limit).select(*keys, "_x", F.col("mid_rank").alias("_rx"))
    ry = mid_ranks(d, keys, "_y", limit=limit).select(*keys, "_y", F.col("mid_rank").alias("_ry"))
    n = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    p = attach(attach(attach(pairs, rx, [*keys, "_x"]), ry, [*keys, "_y"]), n, keys)
    mean = (F.col("n") + 1) / 2.0
    a, b, w = F.col("_rx") - mean, F.col("_ry") - mean, F.col("_w")
    g = p.groupBy(*keys).agg(F.max("n").alias("n"), F.sum(w * a * b).alias("_ab"), F.sum(w * a * a).alias("_aa"), F.sum(w * b * b).alias("_bb"))
    rho = F.when((F.col("n") < 3) | (F.col("_aa") <= 0) | (F.col("_bb") <= 0), 0.0).otherwise(F.col("_ab") / F.sqrt(F.col("_aa") * F.col("_bb")))
    return g.select(*by, "n", rho.alias("rho"))


def adjacent_equal(df: DataFrame, order: str, group: str, by: Sequence[str] = (), *, ties: Sequence[str] = (), limit: int = GROUP_LIMIT) -> DataFrame:
    """How many rows have the same group as the row before them along ``order``."""
    last = F.struct(F.col(order).alias("o"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)], F.col(group).alias("g"))
    d = ordered(df, by, order, {"_prev": ("max", last, "before")}, ties=ties, limit=limit)
    return d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_prev")["g"] == F.col(group)).alias("n_adjacent"))


def log_log_correlation(df: DataFrame, x: str, y: str, by: Sequence[str] = (), keep: Column | None = None) -> DataFrame:
    """Pearson correlation of logarithms over the kept, positive rows."""
    d = df.where((F.col(x) > 0) & (F.col(y) > 0) & (keep if keep is not None else F.lit(True)))
    return d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.corr(F.log(x), F.log(y)).alias("r"))


def class_separation(df: DataFrame, value: str, is_positive: Column, by: Sequence[str] = (), *, limit: int = GROUP_LIMIT) -> DataFrame:
    """Extremes of both classes, whether they are separated, AUC, and rows on the wrong
    side of the other class' extreme."""
    d = df.select(*by, F.col(value).alias("_v"), is_positive.alias("_pos")).where(F.col("_v").isNotNull() & F.col("_pos").isNotNull())
    keys = list(by) or ["_all"]
    if not by:
        d = d.withColumn("_all", F.lit(0))
    ranks = mid_ranks(d, keys, "_v", limit=limit).select(*keys, "_v", "mid_rank")
    counts = d.groupBy(*keys, "_v").agg(F.count_if("_pos").alias("_np"), F.count_if(~F.col("_pos")).alias("_nn"))
    ends = d.groupBy(*keys).agg(
        F.count_if("_pos").alias("n_positive"), F.count_if(~F.col("_pos")).alias("n_negative"),
        F.min(F.when(F.col("_pos"), F.col("_v"))).alias("positive_min"), F.max(F.when(~F.col("_pos"), F.col("_v"))).alias("negative_max"))
    c = attach(attach(counts, ranks, [*keys, "_v"]), ends, keys)
    g = c.groupBy(*keys).agg(
        *[F.first(k).alias(k) for k in ("n_positive", "n_negative", "positive_min", "negative_max")],
        F.sum(F.col("_np") * F.col("mid_rank")).alias("_sum"),
        (F.sum(F.when(F.col("_v") < F.col("negative_max"), F.col("_np")).otherwise(0)) + F.sum(F.when(F.col("_v") > F.col("positive_min"), F.col("_nn")).otherwise(0))).alias("n_overlapping"))
    np_, nn = F.col("n_positive"), F.col("n_negative")
    return g.select(*by, "n_positive", "n_negative", "positive_min", "negative_max", (F.col("positive_min") > F.col("negative_max")).alias("separated"),
                    F.try_divide(F.col("_sum") - np_ * (np_ + 1) / 2.0, (np_ * nn).cast("double")).alias("auc"), "n_overlapping")


def variance_components(df: DataFrame, entity: str, value: str) -> DataFrame:
    """One-way random effects from sums per entity: between, within and ICC."""
    v = F.col(value).cast("double")
    g = df.where(v.isNotNull()).groupBy(entity).agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("m"), F.var_samp(v).alias("s2"))
    t = g.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * F.col("m")).alias("s"), F.sum(F.col("n") * F.col("m") * F.col("m")).alias("sm"),
        F.sum((F.col("n") - 1) * F.coalesce("s2", F.lit(0.0))).alias("ssw"))
    c = F.col
    ssb = c("sm") - c("s") * c("s") / c("n")
    msb, msw = F.try_divide(ssb, (c("k") - 1).cast("double")), F.try_divide(c("ssw"), (c("n") - c("k")).cast("double"))
    n0 = F.try_divide(c("n") - c("nn") / c("n"), (c("k") - 1).cast("double"))
    between = F.greatest(F.try_divide(msb - msw, n0), F.lit(0.0))
    return t.select(c("k").alias("n_entities"), c("n").alias("n_rows"), between.alias("between_var"), msw.alias("within_var"),
                    F.try_divide(between, between + msw).alias("icc"))


def repeat_agreement(df: DataFrame, by: Sequence[str], kind: str, value: str, brightness: str, *, first: str = "original", second: str = "rescan",
                     bad: Column | None = None, strata: float = 5.0) -> DataFrame:
    """Ratio and relative difference of each repeated measurement, with its brightness
    stratum and whether both members pass the quality rule. One row per pair."""
    q = bad if bad is not None else F.lit(False)
    pick = lambda k, c: F.max(F.when(F.col(kind) == k, c))
    g = df.groupBy(*by).agg(
        pick(first, F.col(value)).alias("a"), pick(second, F.col(value)).alias("b"), pick(first, F.col(brightness)).alias("_ba"), pick(second, F.col(brightness)).alias("_bb"),
        F.bool_or(F.coalesce(q, F.lit(False))).alias("_bad")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    lo, hi = F.least("_ba", "_bb"), F.greatest("_ba", "_bb")
    return g.select(*by, F.try_divide(F.col("b"), F.col("a")).alias("ratio"),
                    F.try_divide(F.abs(F.col("b") - F.col("a")), (F.col("a") + F.col("b")) / 2).alias("relative_difference"),
                    F.when(F.try_divide(hi, lo) > strata, "unmatched").otherwise("matched").alias("stratum"), (~F.col("_bad")).alias("clean"))


def agreement_summary(pairs: DataFrame) -> DataFrame:
    """Medians per brightness stratum, for clean pairs and for all of them."""
    both = pairs.withColumn("pair_set", F.explode(F.when(F.col("clean"), F.array(F.lit("clean"), F.lit("all"))).otherwise(F.array(F.lit("all")))))
    keys = ["pair_set", "stratum"]
    r = percentiles(both, keys, "ratio", {"median_ratio": 0.5}).drop("n_values")
    d = percentiles(both, keys, "relative_difference", {"median_difference": 0.5})
    return r.join(d.withColumnRenamed("n_values", "n_pairs"), keys)


def dim_bright(df: DataFrame, brightness: str, value: str, by: Sequence[str], arm: str | None = None) -> DataFrame:
    """Median of the dim half over the median of the bright half, split at the median
    brightness of each group; ``spread`` is max over min of the value."""
    mid = percentiles(df, by, brightness, {"_mid": 0.5}).drop("n_values")
    d = attach(df, mid, by).withColumn("_half", F.when(F.col(brightness) <= F.col("_mid"), "dim").otherwise("bright"))
    m = percentiles(d, [*by, "_half"], value, {"m": 0.5}).groupBy(*by).agg(
        F.max(F.when(F.col("_half") == "dim", F.col("m"))).alias("dim_median"), F.max(F.when(F.col("_half") == "bright", F.col("m"))).alias("bright_median"))
    s = df.groupBy(*by).agg(F.try_divide(F.max(value), F.min(value)).alias("spread"))
    return attach(m, s, by).withColumn("dim_bright_ratio", F.try_divide(F.col("dim_median"), F.col("bright_median")))


def agreement_metrics(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Bias, mean absolute error and 95 % limits of agreement."""
    d = F.col(a) - F.col(b)
    return df.groupBy(*by).agg(F.count(d).alias("n"), F.avg(d).alias("bias"), F.avg(F.abs(d)).alias("mae"), F.stddev_samp(d).alias("_s")).select(
        *by, "n", "bias", "mae", (F.col("bias") - 1.96 * F.col("_s")).alias("limit_low"), (F.col("bias") + 1.96 * F.col("_s")).alias("limit_high"))
