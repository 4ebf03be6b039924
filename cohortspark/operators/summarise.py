"""Grouped counts, flags and summaries. Everything here aggregates map-side first;
a group value goes back to its rows by a join, not by a window over the group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, values: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join of one-row-per-key ``values``; missing keys match each other."""
    renamed = values.select(
        *[F.col(k).alias(f"_j{i}") for i, k in enumerate(by)], *[c for c in values.columns if c not in by]
    )
    cond = F.lit(True)
    for i, k in enumerate(by):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_j{i}"))
    return df.join(renamed, cond, "left").drop(*[f"_j{i}" for i in range(len(by))])


def rollup_counts(df: DataFrame, by: Sequence[str], conditions: Mapping[str, Column], distinct: Column | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(c).alias(n) for n, c in conditions.items()]
    if distinct is not None:
        aggs.append(F.count_distinct(distinct).alias("n_distinct"))
    return df.groupBy(*by).agg(*aggs)


def entity_flag(df: DataFrame, by: str, condition: str = "condition", name: str = "has_negative_control") -> DataFrame:
    """True if any row of the entity is negative, False if none, NULL if all unresolved."""
    resolved = F.col(condition) != "unresolved"
    flags = df.where(F.col(by).isNotNull()).groupBy(by).agg(
        F.when(F.coalesce(F.bool_or(resolved), F.lit(False)), F.bool_or(F.col(condition) == "negative")).alias(name)
    )
    return attach(df, flags, [by])


def slide_summary(df: DataFrame, by: Sequence[str], payload: str | None = None, standard: str | None = None) -> DataFrame:
    """One row per slide. Labels are two-digit text, which bounds the label sets."""
    def labels(cond):
        chosen = F.collect_set(F.when(F.col("condition") == cond, F.col("section_label")))
        return F.array_join(F.array_sort(chosen), ",").alias(f"{cond}_labels")

    aggs = [F.count(F.lit(1)).alias("n_sections"), labels("positive"), labels("negative"), labels("unresolved"),
            F.count_if(F.col("condition") == "unresolved").alias("n_unresolved")]
    if payload:
        aggs.append(F.when(F.bool_and(payload), "yes").when(F.bool_or(payload), "part").otherwise("index").alias("payload"))
    if standard:
        aggs.append(F.when(F.bool_and(standard), "std").otherwise("NON").alias("exposure"))
    return df.groupBy(*by).agg(*aggs)


def modal_tuple(df: DataFrame, cols: Sequence[str], digits: int | None = 4) -> DataFrame:
    """Most frequent complete tuple, one row; the smallest tuple wins a tie."""
    parts = [F.round(F.col(c), digits).alias(c) if digits is not None else F.col(c) for c in cols]
    full = df.dropna(subset=list(cols)).select(*parts)
    return full.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *cols).limit(1)


def consistent_tuple(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Records and distinct tuples per entity; consistent means one distinct tuple."""
    g = df.groupBy(*by, *cols).agg(F.count(F.lit(1)).alias("_c"))
    return g.groupBy(*by).agg(F.sum("_c").alias("n_records"), F.count(F.lit(1)).alias("n_distinct")).withColumn(
        "consistent", F.col("n_distinct") == 1
    )


def rollup_status(problems: DataFrame, roster: DataFrame, key: str, group: str) -> DataFrame:
    """Pass and fail counts per group: a roster entry is ok without a problem."""
    bad = problems.groupBy(key).agg(F.count(F.lit(1)).alias("n_problems"))
    each = attach(roster, bad, [key]).withColumn("n_problems", F.coalesce("n_problems", F.lit(0)))
    return each.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(F.col("n_problems") == 0).alias("n_passed"),
        F.count_if(F.col("n_problems") > 0).alias("n_failed"),
        F.sum("n_problems").alias("n_problems"),
    ).withColumn("ok", F.col("n_failed") == 0)


def tally(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, by: Sequence[str], value: str, kept: Column) -> DataFrame:
    """Rows, median, extremes and the share of kept rows per group."""
    from .skew import percentiles

    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(F.when(kept, 1.0).otherwise(0.0)).alias("kept"))
    return attach(agg, percentiles(df, by, value, {"median": 0.5}).select(*by, "median"), by)


def area_weighted(df: DataFrame, by: Sequence[str], numerator: str, denominator: str, failed: Column | None = None) -> DataFrame:
    """Ratio of sums (primary) and mean of ratios (sensitivity) per entity."""
    d = df.where(~F.coalesce(failed, F.lit(False))) if failed is not None else df
    return d.groupBy(*by).agg(
        F.try_divide(F.sum(numerator), F.sum(denominator)).alias("weighted"),
        F.avg(F.try_divide(F.col(numerator), F.col(denominator))).alias("mean_ratio"),
        F.count(F.lit(1)).alias("n"),
    )


def separation(df: DataFrame, by: Sequence[str], value: str, condition: str = "condition", name: str = "separation") -> DataFrame:
    """min(positive) / max(negative, tiny) per group, NULL unless both classes occur."""
    sep = df.groupBy(*by).agg(
        F.min(F.when(F.col(condition) == "positive", F.col(value))).alias("_p"),
        F.max(F.when(F.col(condition) == "negative", F.col(value))).alias("_m"),
    ).select(*by, F.round(F.col("_p") / F.when(F.col("_m").isNotNull(), F.greatest(F.col("_m"), F.lit(1e-9))), 2).alias(name))
    return attach(df, sep, by)


def audit_verdict(index: Column, record: Column, negative_max: float = 2.0, positive_min: float = 3.0) -> Column:
    """Compare a measured index with the recorded condition."""
    seen = (
        F.when(index >= positive_min, "positive").when(index <= negative_max, "negative").otherwise("inconclusive")
    )
    return (
        F.when(record == "unresolved", "not_checked")
        .when(seen == "inconclusive", "inconclusive")
        .when(seen == record, "agree")
        .otherwise("CONTRADICTS")
    )


def class_ranges(df: DataFrame, value: str, condition: str = "condition") -> DataFrame:
    """One row: count and range of the measured index in each class."""
    aggs = []
    for c in ("positive", "negative"):
        v = F.when(F.col(condition) == c, F.col(value))
        aggs += [F.count(v).alias(f"n_{c}"), F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}")]
    return df.agg(*aggs)


def overlap_rows(df: DataFrame, value: str, support: str | None = None, min_support: float = 0.05, condition: str = "condition") -> DataFrame:
    """Rows whose index lies on the wrong side of the other class' extreme."""
    good = df.where(F.col(support) > min_support) if support else df
    ends = class_ranges(good, value, condition)
    low = ends.select("min_positive").scalar()
    high = ends.select("max_negative").scalar()
    v = F.col(value)
    return good.where(
        ((F.col(condition) == "positive") & (v < high)) | ((F.col(condition) == "negative") & (v > low))
    )
