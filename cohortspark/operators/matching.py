"""One-dimensional clustering and matching of sections along a stage coordinate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpoint
from .skew import GROUP_LIMIT, ordered, rows_in_small_groups, together, top_k
from .summarise import attach

# Fixed values.
SHAPES = ((2, 2), (2, 1), (1, 2))
MIN_RATIO = 1.3
MARGINAL_RATIO = 1.5
MATCH_FRACTION = 0.25
SIDE_RATIO = 1.5


def widest_gaps(df: DataFrame, by: Sequence[str], x: str, *, limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per group: size, the widest gap (the first of equal ones), its two ends,
    the points on each side and the widest other gap."""
    points = df.groupBy(*by, F.col(x).cast("double").alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    g = ordered(points, by, "_x", {
        "_lo": ("max", F.col("_x"), "before"),
        "_low": ("sum", F.col("_c"), "before"),
        "_above": ("sum", F.col("_c"), "after"),
    }, limit=limit).withColumn("_gap", F.col("_x") - F.col("_lo"))
    two = top_k(g, by, [F.col("_gap").desc_nulls_last(), F.col("_x")], 2, "_r")
    first = lambda c: F.max(F.when(F.col("_r") == 1, c))
    return two.groupBy(*by).agg(
        first(F.col("_low") + F.col("_above") + F.col("_c")).alias("n"),
        first(F.col("_low")).alias("n_low"),
        first(F.col("_above") + F.col("_c")).alias("n_high"),
        first(F.col("_lo")).alias("split_lo"),
        first(F.when(F.col("_gap").isNotNull(), F.col("_x"))).alias("split_hi"),
        first(F.col("_gap")).alias("split_gap"),
        F.max(F.when(F.col("_r") == 2, F.col("_gap"))).alias("other_gap"),
    )


def gap_split(
    df: DataFrame, by: Sequence[str], x: str, *, shapes: Sequence[tuple[int, int]] | None = SHAPES,
    min_ratio: float = MIN_RATIO, marginal: float = MARGINAL_RATIO, limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Split every group at its widest gap, or say why not (``status``).

    ``status`` is ``ok``, ``too_few``, ``bad_shape`` or ``ambiguous``; the coordinate is
    in micrometres and gaps are reported in millimetres.
    """
    g = widest_gaps(df, by, x, limit=limit)
    ratio = F.try_divide(F.col("split_gap"), F.col("other_gap"))
    status = split_status(shapes, min_ratio)
    return g.select(
        *by, "n", "n_low", "n_high", "split_lo", "split_hi",
        (F.col("split_gap") / 1000).alias("split_gap_mm"), (F.col("other_gap") / 1000).alias("within_gap_mm"),
        ratio.alias("gap_ratio"), status.alias("status"),
        ((status == "ok") & F.coalesce(ratio < marginal, F.lit(False))).alias("marginal"),
    )


def split_status(shapes: Sequence[tuple[int, int]] | None = SHAPES, min_ratio: float = MIN_RATIO) -> Column:
    """Verdict on ``n, n_low, n_high, split_gap, other_gap``."""
    good_shape = F.lit(True)
    if shapes is not None:
        good_shape = F.lit(False)
        for lo, hi in shapes:
            good_shape = good_shape | ((F.col("n_low") == lo) & (F.col("n_high") == hi))
    return (
        F.when(F.col("n") < 3, "too_few")
        .when(F.col("split_gap").isNull(), "ambiguous")
        .when(~good_shape, "bad_shape")
        .when(F.try_divide(F.col("split_gap"), F.col("other_gap")) < min_ratio, "ambiguous")
        .otherwise("ok")
    )


def assign_sides(df: DataFrame, splits: DataFrame, by: Sequence[str], x: str) -> DataFrame:
    """``box`` of every row: near_label below the split, far_label above, NULL if refused."""
    d = attach(df, splits.select(*by, F.col("split_lo").alias("_lo"), F.col("status").alias("split_status"),
                                 "gap_ratio"), by)
    return d.withColumn(
        "box", F.when(F.col("split_status") == "ok", F.when(F.col(x) <= F.col("_lo"), "near_label").otherwise("far_label"))
    ).drop("_lo")


def side_of_gap(x: Column, lo: Column, hi: Column, gap: Column, other: Column, ratio: float = SIDE_RATIO) -> Column:
    """Side of the widest gap for a new point; NULL if the gap is not clearly the widest
    or the point falls inside it."""
    unclear = gap.isNull() | F.coalesce(gap < ratio * other, F.lit(False)) | ((x > lo) & (x < hi))
    return F.when(~unclear, F.when(x <= lo, "near_label").otherwise("far_label"))


def place_by_gap(points: DataFrame, reference: DataFrame, by: Sequence[str], x: str, *, limit: int = GROUP_LIMIT) -> DataFrame:
    """Put unmatched points on a side of the reference group's widest gap."""
    g = widest_gaps(reference, by, x, limit=limit).select(*by, "split_lo", "split_hi", "split_gap", "other_gap")
    d = attach(points, g, by)
    side = side_of_gap(F.col(x), F.col("split_lo"), F.col("split_hi"), F.col("split_gap"), F.col("other_gap"))
    return d.withColumn("side", side).drop("split_lo", "split_hi", "split_gap", "other_gap")


def matched_within(d: DataFrame, by: Sequence[str], label: str, fraction: float = MATCH_FRACTION) -> DataFrame:
    """The work of ``nearest_match`` on groups that lie whole in their tasks (``skew.together``), by windows alone.

    ``d`` has ``_l`` and ``_r`` (a left, a right row; rows that are neither pass), ``_x`` and ``_ll``, the label of left rows. Adds
    ``n, n_low, n_high, split_lo, split_hi, split_gap, other_gap`` of the group's left rows (``n`` is 0 without any), and for right rows
    ``_best, _left_label, _off, _hit, _side, _status, _reason``.
    """
    c, back, ahead = F.col, W.unboundedPreceding, W.unboundedFollowing
    # All windows want one order: group, place, left rows first.
    here, along = W.partitionBy(*by, "_x").orderBy(F.desc("_l")), W.partitionBy(*by).orderBy("_x", F.desc("_l"))
    spot, group, before = here.rowsBetween(back, ahead), along.rowsBetween(back, ahead), along.rowsBetween(back, -1)
    lefts = lambda v: F.when(c("_l"), v)
    d = d.withColumns({
        "_spot": F.struct(F.min(lefts(c("_ll"))).over(spot).alias("label"), F.count(lefts(c("_l"))).over(spot).alias("n"), F.row_number().over(here).alias("at")),
        "_pv": F.last(lefts(c("_x")), ignorenulls=True).over(before), "n_low": F.count(lefts(c("_l"))).over(before)})
    # A place of several left rows counts once, at its first row.
    d = d.withColumns({"_gap": F.when(c("_l") & (c("_spot.at") == 1), c("_x") - c("_pv")), "_point": F.when(c("_l") & c("_x").isNotNull(), F.struct(c("_x").alias("x"), c("_spot.label").alias("label")))})
    names = ", ".join(f"`{k}`" for k in by)
    wide = F.when(c("_gap").isNotNull(), F.struct(c("_gap").alias("gap"), (-c("_x")).alias("first"), c("_x").alias("hi"), c("_pv").alias("lo"), c("n_low").alias("low")))
    d = d.withColumns({
        "_dn": F.last("_point", ignorenulls=True).over(along.rowsBetween(back, 0)),
        "_up": F.expr(f"lead(_point) IGNORE NULLS OVER (PARTITION BY {names} ORDER BY _x, _l DESC)"),
        "n": F.count(lefts(c("_l"))).over(group), "_most": F.max(lefts(c("_spot.n"))).over(group), "_least": F.min("_gap").over(group), "_wide": F.max(wide).over(group)})
    d = d.withColumn("other_gap", F.max(F.when(c("_gap").isNotNull() & (c("_x") != c("_wide.hi")), c("_gap"))).over(group))
    best = F.when(c("_dn").isNull() | (c("_up.x") - c("_x") < c("_x") - c("_dn.x")), c("_up")).otherwise(c("_dn"))
    d = d.withColumns({"n_low": F.coalesce(c("_wide.low"), F.lit(0)), "split_lo": c("_wide.lo"), "split_hi": c("_wide.hi"), "split_gap": c("_wide.gap"), "_best": F.when(c("_r"), best)}).drop("_dn", "_up", "_wide", "_pv", "_gap", "_point", "_spot")
    off = F.abs(c("_best.x") - c("_x"))
    spacing = F.when(c("_most") > 1, F.lit(0.0)).otherwise(c("_least"))
    d = d.withColumns({
        "n_high": c("n") - c("n_low"), "_left_label": c("_best.label"), "_off": off, "_hit": F.coalesce(c("_r") & (c("n") >= 2) & (off <= fraction * spacing), F.lit(False)),
        "_side": side_of_gap(c("_x"), c("split_lo"), c("split_hi"), c("split_gap"), c("other_gap"))}).drop("_most", "_least")
    claims = W.partitionBy(*by, "_left_label")
    d = d.withColumn("_k", F.count(F.when(c("_hit"), 1)).over(claims))
    whole = W.partitionBy(*by).orderBy("_left_label").rowsBetween(back, ahead)
    d = d.withColumns({"_clash": F.max(F.when(c("_hit"), c("_k") > 1)).over(whole), "_lost": F.max(F.when(c("_r"), ~c("_hit") & c("_side").isNull())).over(whole)})
    reason = (
        F.when(c("n") < 2, "fewer than two originals")
        .when(c("_lost"), "a section is beyond the tolerance and on no clear side")
        .when(F.coalesce("_clash", F.lit(False)), "two sections claim one original")
    )
    d = d.withColumn("_reason", F.when(c("_r"), reason)).drop("_k", "_clash", "_lost")
    return d.withColumn("_status", F.when(c("_r"), F.when(c("_reason").isNotNull(), "void").when(c("_hit"), "matched").otherwise("new")))


def match_columns(label: str) -> dict[str, Column]:
    """What ``nearest_match`` says of a row of ``matched_within``."""
    status = F.col("_status")
    return {
        "matched_label": F.when(status == "matched", F.col("_left_label")).when(status == "new", F.concat(F.lit("new"), F.col(label))),
        "match_offset": F.when(status == "matched", F.col("_off")).when(status == "new", F.lit(0.0)),
        "side": F.when(status == "new", F.col("_side")), "match_status": status, "match_reason": F.col("_reason")}


def nearest_match(
    left: DataFrame, right: DataFrame, by: Sequence[str], x: str, label: str, *,
    fraction: float = MATCH_FRACTION, limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Match every ``right`` row to the nearest ``left`` row of its group.

    The tolerance is ``fraction`` of the smallest spacing on the left. A right row beyond
    it may be a new one, placed by the widest gap (``new``). One row that is neither, or
    two that claim the same left row, void the whole group. Columns: ``by, label, x,
    matched_label, match_offset, side, match_status, match_reason``. Groups are counted first: where none has more than
    ``limit`` rows, rows are shuffled once.
    """
    rows = rows_in_small_groups([left, right], by, limit)
    if rows is not None:
        double = F.col(x).cast("double").alias("_x")
        d = left.select(*by, double, F.lit(True).alias("_l"), F.lit(False).alias("_r"), F.col(label).alias("_ll")).unionByName(
            right.select(*by, double, F.lit(False).alias("_l"), F.lit(True).alias("_r"), F.col(label).alias("_own")), allowMissingColumns=True)
        d = matched_within(together(d, by, rows), by, "_own", fraction).where("_r")
        said = match_columns("_own")
        return d.select(*by, F.col("_own").alias(label), F.col("_x").alias(x), *[said[n].alias(n) for n in ("matched_label", "match_offset", "side", "match_status", "match_reason")])
    lpts = left.groupBy(*by, F.col(x).cast("double").alias("_x")).agg(
        F.count(F.lit(1)).alias("_c"), F.min(label).alias("_left_label"))
    rpts = right.select(*by, F.col(x).cast("double").alias("_x")).distinct()
    both = lpts.select(*by, "_x", F.lit(1).alias("_l"), F.lit(0).alias("_q")).unionByName(
        rpts.select(*by, "_x", F.lit(0).alias("_l"), F.lit(1).alias("_q")))
    both = both.groupBy(*by, "_x").agg(F.max("_l").alias("_l"), F.max("_q").alias("_q"))
    is_left = F.when(F.col("_l") == 1, F.col("_x"))
    near = ordered(both, by, "_x", {"_dn": ("max", is_left, "upto"), "_up": ("min", is_left, "onward")}, limit=limit)
    near = near.where(F.col("_q") == 1).select(
        *by, "_x",
        F.when(F.col("_dn").isNull() | (F.col("_up") - F.col("_x") < F.col("_x") - F.col("_dn")), F.col("_up"))
        .otherwise(F.col("_dn")).alias("_best"))
    # Smallest spacing on the left; two rows at one place make it zero.
    steps = ordered(lpts, by, "_x", {"_pv": ("max", F.col("_x"), "before")}, limit=limit)
    spacing = steps.groupBy(*by).agg(
        F.sum("_c").alias("_n_left"),
        F.when(F.max("_c") > 1, F.lit(0.0)).otherwise(F.min(F.col("_x") - F.col("_pv"))).alias("_spacing"))
    gaps = widest_gaps(left, by, x, limit=limit).select(*by, "split_lo", "split_hi", "split_gap", "other_gap")

    d = right.select(*by, label, F.col(x).cast("double").alias("_x"))
    d = attach(d, near, [*by, "_x"])
    d = attach(d, lpts.select(*by, F.col("_x").alias("_best"), "_left_label"), [*by, "_best"])
    d = attach(attach(d, spacing, by), gaps, by)
    off = F.abs(F.col("_best") - F.col("_x"))
    enough = F.coalesce(F.col("_n_left") >= 2, F.lit(False))
    hit = enough & (off <= fraction * F.col("_spacing"))
    side = side_of_gap(F.col("_x"), F.col("split_lo"), F.col("split_hi"), F.col("split_gap"), F.col("other_gap"))
    d = d.select(
        *by, label, "_x", "_left_label", off.alias("_off"), enough.alias("_enough"),
        F.coalesce(hit, F.lit(False)).alias("_hit"), side.alias("_side"))
    d = checkpoint(d)  # read three times below
    claims = d.where("_hit").groupBy(*by, "_left_label").agg(F.count(F.lit(1)).alias("_k"))
    clash = claims.groupBy(*by).agg((F.max("_k") > 1).alias("_clash"))
    lost = d.groupBy(*by).agg(F.bool_or(~F.col("_hit") & F.col("_side").isNull()).alias("_lost"))
    d = attach(attach(d, clash, by), lost, by)
    reason = (
        F.when(~F.col("_enough"), "fewer than two originals")
        .when(F.col("_lost"), "a section is beyond the tolerance and on no clear side")
        .when(F.coalesce("_clash", F.lit(False)), "two sections claim one original")
    )
    status = F.when(reason.isNotNull(), "void").when(F.col("_hit"), "matched").otherwise("new")
    return d.select(
        *by, label, F.col("_x").alias(x),
        F.when(status == "matched", F.col("_left_label")).when(status == "new", F.concat(F.lit("new"), F.col(label))).alias("matched_label"),
        F.when(status == "matched", F.col("_off")).when(status == "new", F.lit(0.0)).alias("match_offset"),
        F.when(status == "new", F.col("_side")).alias("side"),
        status.alias("match_status"), reason.alias("match_reason"),
    )


def ordinal_join(
    a: DataFrame, b: DataFrame, by: Sequence[str], order_a: str, order_b: str, *,
    ties_a: Sequence[str] = (), ties_b: Sequence[str] = (), fits: Column | None = None, limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Pair the k-th row of ``a`` with the k-th row of ``b`` in each group.

    Only groups with equal counts whose every pair satisfies ``fits`` are bound; the
    others keep the rows of ``a`` with NULLs and a ``bind_status``.
    """
    pa = ordered(a, by, order_a, {"_pos": ("sum", F.lit(1), "before")}, ties=ties_a, limit=limit)
    pb = ordered(b, by, order_b, {"_pos": ("sum", F.lit(1), "before")}, ties=ties_b, limit=limit)
    na = a.groupBy(*by).agg(F.count(F.lit(1)).alias("_na"))
    nb = b.groupBy(*by).agg(F.count(F.lit(1)).alias("_nb"))
    extra = [c for c in b.columns if c not in by]
    d = attach(pa, pb.select(*by, "_pos", *extra), [*by, "_pos"])
    d = attach(attach(d, na, by), nb, by)
    ok = F.coalesce(F.col("_na") == F.col("_nb"), F.lit(False))
    status = F.when(F.col("_nb").isNull(), "no_payload").when(~ok, "count_mismatch")
    if fits is not None:
        bad = d.groupBy(*by).agg(F.bool_and(F.coalesce(fits, F.lit(True))).alias("_fits"))
        d = attach(d, bad, by)
        status = status.when(~F.col("_fits"), "does_not_fit")
    d = d.withColumn("bind_status", status.otherwise("bound"))
    bound = F.col("bind_status") == "bound"
    return d.select(
        *[F.col(c) for c in a.columns], *[F.when(bound, F.col(c)).alias(c) for c in extra], "bind_status"
    )


def grid_fits(cols: Column, rows: Column, tile_w: Column, tile_h: Column, width: Column, height: Column) -> Column:
    """The tile grid exceeds the image by at most one tile each way. It may fall short:
    edge columns without sample are never stored."""
    return (cols * tile_w <= width + tile_w) & (rows * tile_h <= height + tile_h)


def select_pairs(df: DataFrame, by: Sequence[str], kind: str, values: Sequence[str] = ("original", "rescan"),
                 condition: str | None = None) -> DataFrame:
    """Rows of groups that hold exactly the given kinds; ``pair_ok`` says the members
    agree on the condition."""
    aggs = [F.bool_or(F.col(kind) == v).alias(f"_has{i}") for i, v in enumerate(values)]
    aggs.append(F.bool_and(F.col(kind).isin(*values)).alias("_only"))
    agree = (F.min(condition).eqNullSafe(F.max(condition)) if condition else F.lit(True)).alias("pair_ok")
    g = df.groupBy(*by).agg(*aggs, agree).where(F.col("_only"))
    for i in range(len(values)):
        g = g.where(F.col(f"_has{i}"))
    return df.join(g.select(*by, "pair_ok"), list(by))


def lookup_one(df: DataFrame, ref: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Attach the one matching reference value; none or several is a failure row."""
    found = ref.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"), F.min(value).alias("_v"))
    d = attach(df, found, keys)
    m = F.coalesce("_m", F.lit(0))
    return d.select(
        *df.columns, F.when(m == 1, F.col("_v")).alias(value),
        F.when(m == 0, "missing").when(m > 1, "ambiguous").otherwise("ok").alias("lookup_status"),
    )


def is_monotone(df: DataFrame, by: Sequence[str], order: str, value: str, min_rows: int = 6, *, limit: int = GROUP_LIMIT) -> DataFrame:
    """Per group: is ``value`` strictly rising or falling along ``order``."""
    prev = ordered(df, by, order, {"_p": ("max", F.struct(F.col(order).alias("o"), F.col(value).alias("v")), "before")}, limit=limit)
    step = F.col(value) - F.col("_p")["v"]
    return prev.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count(F.lit(1)) >= min_rows).alias("_many"),
        F.coalesce(F.bool_and(F.when(step.isNotNull(), step > 0)), F.lit(True)).alias("_up"),
        F.coalesce(F.bool_and(F.when(step.isNotNull(), step < 0)), F.lit(True)).alias("_down"),
    ).select(*by, "n", (F.col("_many") & F.col("_up")).alias("rising"), (F.col("_many") & F.col("_down")).alias("falling"))
