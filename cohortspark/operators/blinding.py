"""Pseudonyms, column policy and the split into a private and a blinded table."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import is_flag, truthy
from .skew import GROUP_LIMIT, hash_key, hash_number, ordered, permutation_index, rows_in_small_groups, together
from .summarise import attach, modal_tuple

# Fixed values.
ALLOWED = (
    "code", "row_kind", "analysis_include", "physical_section_label", "section_label", "replicate", "series_index",
    "stack_id", "box", "condition", "region", "marker", "channel", "n_sections_on_slide", "n_sections_recorded",
    "n_positive_sections_on_slide", "has_negative_control", "pixel_size_um", "exposure_is_standard",
)
DENIED = (
    "tube", "animal", "subject", "mouse", "group", "arm", "treatment", "path", "file", "dir", "folder", "uri", "url",
    "series_name", "acquisition", "acq", "scan", "timestamp", "time", "date", "datetime", "batch", "session",
    "exposure_ms", "exposure_dapi", "exposure_fitc", "exposure_cy3", "exposure_us", "sha", "checksum", "hash", "md5",
    "label_image", "seed", "code_seed", "depth_index", "rescan", "needs_confirmation", "annotation", "warning",
)
UNRESOLVED = ("", "unresolved", "unknown", "pending", "pending_pi_decision", "nan", "none", "tbd", "needs_confirmation", "?")
DATE = r"(19|20)\d{2}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])"
NUMERIC_DIGITS, TEXT_LENGTH, TEXT_DISTINCT = 12, 16, 8
POOL_HEADROOM = 4
LETTERS = 26


def denied_token(column: str, deny: Sequence[str] = DENIED, whole_token: bool = False) -> str | None:
    """The deny token a column name contains (or equals one part of, in token mode)."""
    name = column.lower()
    for token in deny:
        if (token in name.split("_")) if whole_token else (token in name):
            return token
    return None


def split_columns(df: DataFrame, allow: Sequence[str] = ALLOWED, deny: Sequence[str] = DENIED, extra: Sequence[str] = ()):
    """Keep allow-listed columns whose name hits no deny token.

    Returns the narrowed table and ``(column, kept, token)`` for every column.
    """
    for e in extra:
        if denied_token(e, deny):
            raise ValueError(f"column {e!r} matches the denied token {denied_token(e, deny)!r}")
    ok = set(allow) | set(extra)
    report = [(c, c in ok and not denied_token(c, deny), denied_token(c, deny)) for c in df.columns]
    return df.select(*[F.col(c) for c, keep, _ in report if keep]), report


def check_seed(seed) -> str:
    """A seed is required and must not be guessable; 42 and '42' are the same seed."""
    text = "" if seed is None else str(seed).strip()
    if text in ("", "PENDING_PI_DECISION"):
        raise ValueError("an explicit secret seed is required")
    return text


def reject_weak_seed(seed: str) -> None:
    """Refuse seeds that can be found by trying: dates, numbers below twelve digits, and text below
    sixteen characters or eight distinct ones."""
    if re.fullmatch(DATE, seed) or (len(seed) < NUMERIC_DIGITS if seed.isdigit() else len(seed) < TEXT_LENGTH or len(set(seed)) < TEXT_DISTINCT):
        raise ValueError("the seed is too easy to guess: draw 128 random bits")


def _pool(n: int, width: int | None) -> tuple[int, int]:
    """Digits and size of a label pool with enough headroom."""
    d = width if width is not None else max(1, math.ceil(math.log10(max(1, POOL_HEADROOM * n / LETTERS))))
    if LETTERS * 10**d < POOL_HEADROOM * n:
        raise ValueError(f"{d} digits give too few labels for {n} entities")
    return d, LETTERS * 10**d


def pool_step(seed: str, size: int) -> tuple[int, int]:
    """Multiplier coprime to the pool size, and offset: spread the labels over the pool."""
    raw = int(hashlib.sha256(f"{seed}:pool".encode()).hexdigest(), 16)
    step = raw % size | 1
    while math.gcd(step, size) != 1:
        step += 2
    return step % size, (raw >> 64) % size


def label_of(index, digits: int):
    """Letter, a zero, then digits: the zero keeps a label from ever holding an id."""
    return F.concat(F.char((65 + index % LETTERS).cast("int")), F.lit("0"),
                    F.lpad(F.floor(index / LETTERS).cast("bigint").cast("string"), digits, "0"))


def assign_codes(ids: DataFrame, key: str, seed, *, width: int | None = None, allow_weak_seed: bool = False,
                 limit: int = GROUP_LIMIT) -> DataFrame:
    """``key, code``: distinct ids in a seeded random order, given labels from a pool at
    least four times their number. The same seed and ids give the same codes."""
    seed = check_seed(seed)
    if not allow_weak_seed:
        reject_weak_seed(seed)
    d = ids.select(key).where(F.col(key).isNotNull()).distinct()
    digits, size = _pool(d.count(), width)
    step, shift = pool_step(seed, size)
    placed = permutation_index(d, key, seed=seed, limit=limit)
    # Positions stay below 2**53 / step for any pool that fits memory; decimals keep it exact.
    index = ((F.col("pos").cast("decimal(38,0)") * F.lit(step)) + F.lit(shift)) % F.lit(size)
    return placed.select(key, label_of(index.cast("bigint"), digits).alias("code"))


def extend_codes(existing: DataFrame, ids: DataFrame, key: str, seed, *, width: int, allow_weak_seed: bool = False,
                 limit: int = GROUP_LIMIT) -> DataFrame:
    """Keep every issued code; give new ids labels the pool has not used.

    The k-th new id takes the k-th free label in pool order. Labels are walked only as
    far as issued plus new ids reach, so the walk is bounded by the roster.
    """
    seed = check_seed(seed)
    if not allow_weak_seed:
        reject_weak_seed(seed)
    issued = existing.select(key, "code")
    fresh = ids.select(key).where(F.col(key).isNotNull()).distinct().join(issued.select(key), key, "left_anti")
    n_new, n_old = fresh.count(), issued.count()
    digits, size = _pool(n_new + n_old, width)
    step, shift = pool_step(seed, size)
    spark = ids.sparkSession
    index = ((F.col("id").cast("decimal(38,0)") * F.lit(step)) + F.lit(shift)) % F.lit(size)
    walk = spark.range(n_new + n_old).select("id", label_of(index.cast("bigint"), digits).alias("code"))
    free = ordered(walk.join(issued.select("code"), "code", "left_anti"), [], "id", {"pos": ("sum", F.lit(1), "before")}, limit=limit)
    placed = permutation_index(fresh, key, seed=seed, limit=limit)
    new = placed.join(free.select("pos", "code"), "pos").select(key, "code")
    return issued.unionByName(new)


def replicate_index(df: DataFrame, keys: Sequence[str], name: str = "replicate", *, limit: int = GROUP_LIMIT) -> DataFrame:
    """1..n within rows that share ``keys``, ordered by a hash of the row's content, so the
    order tells nothing about the source. Exact copies are counted, ranked once, and
    written out again in chunks."""
    rest = [c for c in df.columns if c not in keys]
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rest]) if rest else F.lit("")
    rows = rows_in_small_groups([df], keys, limit) if keys else None
    if rows is not None:
        df = together(df, keys, rows)
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_h", F.sha2(text, 256))
    copies = copies.withColumn("_u", hash_number(F.col("_h")))
    chunk = 10_000
    if rows is not None:
        # Groups lie whole in their tasks and are small: nothing more is shuffled, and copies are written out where they are.
        before = W.partitionBy(*keys).orderBy("_u", "_h", *rest).rowsBetween(W.unboundedPreceding, -1)
        ranked = copies.withColumn("_before", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    else:
        ranked = ordered(copies, keys, "_u", {"_before": ("sum", F.col("_copies"), "before")}, ties=["_h", *rest], limit=limit)
    starts = ranked.withColumn("_start", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(chunk))))
    starts = starts.repartition("_h", "_start") if rows is None else starts
    each = starts.withColumn("_i", F.explode(F.sequence(F.col("_start"), F.least(F.col("_start") + chunk, F.col("_copies")) - 1)))
    return each.select(*df.columns, (F.col("_before") + F.col("_i") + 1).cast("bigint").alias(name))


def unresolved_rows(df: DataFrame) -> DataFrame:
    """Rows that must stop a blinding run: no condition, or flagged for confirmation."""
    bad = F.lower(F.trim(F.coalesce("condition", F.lit("")))).isin(*UNRESOLVED)
    if "needs_confirmation" in df.columns:
        bad = bad | is_flag(F.col("needs_confirmation"))
    return df.where(bad)


def standard_flag(df: DataFrame, cols: Sequence[str], rtol: float = 1e-3, name: str = "exposure_is_standard") -> DataFrame:
    """True where every value is close to the cohort's most frequent tuple; NULL if incomplete."""
    mode = modal_tuple(df, cols)
    mode = mode.select(*[F.col(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    std = [mode.select(f"_m{i}").scalar() for i in range(len(cols))]
    full, close = F.lit(True), F.lit(True)
    for c, s in zip(cols, std):
        full = full & F.col(c).isNotNull()
        close = close & (F.abs(F.col(c) - s) <= rtol * F.greatest(F.abs(F.col(c)), F.abs(s)))
    return df.withColumn(name, F.when(full, close))


def split_private_blinded(df: DataFrame, codes: DataFrame, entity: str, *, extra: Sequence[str] = (),
                          exposure: Sequence[str] = (), preferred_only: bool = False):
    """Private table (all columns and the code) and blinded table (policy columns only).

    Unresolved rows and rows without a code stop it: hidden behind a code nobody would find them.
    """
    stopped = unresolved_rows(df).select(entity).limit(5).collect()
    if stopped:
        raise ValueError(f"unresolved rows, e.g. of {[r[0] for r in stopped]}")
    nameless = df.select(entity).join(codes.where(F.col("code").isNotNull()).select(entity), entity, "left_anti").limit(5).collect()
    if nameless:
        raise ValueError(f"rows without a code, e.g. of {[r[0] for r in nameless]}")
    work = standard_flag(df, exposure) if exposure and "exposure_is_standard" not in df.columns else df
    private = attach(work, codes, [entity])
    chosen = private.where(truthy(F.col("scan_is_preferred"))) if preferred_only else private
    blinded, report = split_columns(chosen, extra=extra)
    if "pixel_size_um" in blinded.columns:
        blinded = blinded.withColumn("pixel_size_um", F.round("pixel_size_um", 4))
    if "section_label" in blinded.columns and "replicate" not in blinded.columns:
        blinded = replicate_index(blinded, ["code", "section_label"])
    return private, blinded, report


def destroy_order(df: DataFrame) -> DataFrame:
    """Sort by code before writing, so that row order carries nothing else."""
    keys = [c for c in ("code", "section_label", "replicate", "region", "series_index") if c in df.columns]
    return df.orderBy(*keys, *[c for c in df.columns if c not in keys])


