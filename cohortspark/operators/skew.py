"""Ordered computations inside groups that stay distributed when a group is huge.

A plain ``Window.partitionBy(key)`` sorts one key in one task. So groups are counted first. Where none has more
than ``limit`` rows that is all there is to do: one window, one shuffle. Otherwise the large groups are
cut into cells as in a sample sort: a sample of each gives splitters, rows find their cell by
bisection, the window runs inside each ``(key, cell)``, and a small summary a cell carries the running totals
across cells. Splitters follow the rows, not their values, so neither an outlier nor a common prefix fills one cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpoint

#: Rows of one group that a single task may sort.
GROUP_LIMIT = 2_000_000
#: Rows of a task that holds whole groups, on average.
ROWS_A_TASK = 250_000
#: Cells of a large group at most, and sampled rows a cell.
MOST_CELLS, SAMPLED = 1 << 14, 16
#: Share of ranks to both sides of a percentile that is looked at exactly, and the size of the sketch that brackets it.
BRACKET, SKETCH = 0.01, 1000

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def _same(by: Sequence[str], prefix: str = "_k") -> Column:
    """Keys equal to their copies under other names; missing keys match each other."""
    cond = F.lit(True)
    for i, k in enumerate(by):
        cond = cond & F.col(k).eqNullSafe(F.col(f"{prefix}{i}"))
    return cond


def _named(df: DataFrame, by: Sequence[str], *cols: str, prefix: str = "_k") -> DataFrame:
    return df.select(*[F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(by)], *cols)


def large_groups(df: DataFrame, by: Sequence[str], limit: int) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)


def rows_in_small_groups(frames: Sequence[DataFrame], by: Sequence[str], limit: int) -> int | None:
    """How many rows the frames have; None if a group has more than ``limit`` in all of them."""
    keys = frames[0].select(*by)
    for f in frames[1:]:
        keys = keys.unionAll(f.select(*by))
    sizes = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum("_n").alias("rows"), F.max("_n").alias("most")).first()
    return None if (sizes.most or 0) > limit else sizes.rows or 0


def together(df: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """``df`` dealt by ``by`` into tasks of bounded size, for groups known to be small: windows and groupings that begin with ``by`` shuffle no more."""
    tasks = max(rows // ROWS_A_TASK, min(df.sparkSession.sparkContext.defaultParallelism, rows // 10_000)) + 1
    return df.repartition(tasks, *[F.col(c) for c in by])


def cells(df: DataFrame, by: Sequence[str], order: Sequence[str], limit: int, ranges: int = MOST_CELLS) -> DataFrame:
    """``df`` with ``_cell``, NULL outside large groups; cells of a group are ordered as its rows are by ``order``.

    A group of n rows has about ``4 n / limit`` cells, ``ranges`` at most. Rows equal in ``order`` share one.
    """
    sizes = large_groups(df, by, limit).withColumn("_cells", F.least(F.ceil(4 * F.col("_n") / limit), F.lit(ranges)).cast("int"))
    key = F.struct(*order)
    some = df.join(_named(sizes, by, "_n", "_cells"), _same(by)).where(F.rand(17) < SAMPLED * F.col("_cells") / F.col("_n"))
    # A sample of a group has at most about SAMPLED * MOST_CELLS rows.
    drawn = some.groupBy(*by).agg(F.sort_array(F.collect_list(key)).alias("_sample"), F.max("_cells").alias("_cells"))
    at = lambda i: F.get(F.col("_sample"), F.floor(i * F.size("_sample") / F.col("_cells")).cast("int"))
    splitters = checkpoint(_named(drawn.withColumn("_cuts", F.transform(F.sequence(F.lit(1), F.greatest(F.col("_cells") - 1, F.lit(1))), at)), by, "_cuts"))
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(MOST_CELLS.bit_length()))))
    cell = F.aggregate(steps, F.lit(0), lambda pos, step: pos + F.when(F.get(F.col("_cuts"), pos + step - 1) <= key, step).otherwise(0))
    return df.join(splitters, _same(by), "left").select(*df.columns, F.when(F.col("_cuts").isNotNull(), cell).alias("_cell"))


def ordered(
    df: DataFrame,
    by: Sequence[str],
    x: str,
    specs: Mapping[str, tuple[str, Column, str]],
    *,
    ties: Sequence[str] = (),
    limit: int = GROUP_LIMIT,
    ranges: int = MOST_CELLS,
) -> DataFrame:
    """Add running aggregates along ``x`` (then ``ties``) inside each ``by`` group.

    ``specs`` maps an output name to ``(agg, expression, side)``; ``agg`` is ``sum``,
    ``max`` or ``min``; ``side`` is ``before``/``after`` (strictly, by row),
    ``upto``/``onward`` (including rows with the same ``x``; needs ``ties`` empty) or ``all``.
    An empty ``by`` orders the whole table. Running sums start at 0, others at NULL.
    """
    keys, kept = list(by), df.columns
    if not keys:
        df = df.withColumn("_all", F.lit(0))
        keys = ["_all"]
    large = not large_groups(df, keys, limit).isEmpty()
    if large:
        df = checkpoint(cells(df, keys, [x, *ties], limit, ranges))
    return _running(df, keys, [x, *ties], specs, large).select(*kept, *specs)


def _running(df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Mapping[str, tuple[str, Column, str]], large: bool) -> DataFrame:
    """The aggregates of ``ordered``; with ``large`` groups the rows have their ``_cell``."""
    inner = [*keys, "_cell"] if large else keys
    order = [F.col(c) for c in order]
    w = W.partitionBy(*inner).orderBy(*order)
    # Frames that look ahead run backwards: a growing frame is linear, a shrinking one is not.
    back = W.partitionBy(*inner).orderBy(*[o.desc() for o in order])
    frames = {
        "before": w.rowsBetween(W.unboundedPreceding, -1),
        "after": back.rowsBetween(W.unboundedPreceding, -1),
        "upto": w.rangeBetween(W.unboundedPreceding, W.currentRow),
        "onward": back.rangeBetween(W.unboundedPreceding, W.currentRow),
        "all": W.partitionBy(*inner),
    }
    inside = df.select("*", *[_AGG[a](e).over(frames[s]).alias(f"_in_{n}") for n, (a, e, s) in specs.items()])
    empty = {n: F.lit(0) if a == "sum" else F.lit(None) for n, (a, _, _) in specs.items()}
    if not large:
        return inside.select(*df.columns, *[F.coalesce(F.col(f"_in_{n}"), empty[n]).alias(n) for n in specs])
    cell_w = W.partitionBy(*keys).orderBy("_cell")
    carry_frames = {
        "before": cell_w.rowsBetween(W.unboundedPreceding, -1),
        "upto": cell_w.rowsBetween(W.unboundedPreceding, -1),
        "after": cell_w.rowsBetween(1, W.unboundedFollowing),
        "onward": cell_w.rowsBetween(1, W.unboundedFollowing),
        "all": W.partitionBy(*keys),
    }
    # At most MOST_CELLS rows a large group.
    totals = df.where(F.col("_cell").isNotNull()).groupBy(*keys, "_cell").agg(*[_AGG[a](e).alias(f"_t_{n}") for n, (a, e, _) in specs.items()])
    carry = totals.select(*keys, "_cell", *[_AGG[a](F.col(f"_t_{n}")).over(carry_frames[s]).alias(f"_c_{n}") for n, (a, _, s) in specs.items()])
    carry = _named(carry, [*keys, "_cell"], *[f"_c_{n}" for n in specs])
    joined = inside.join(carry, _same([*keys, "_cell"]), "left")
    out = []
    for n, (a, _, side) in specs.items():
        i, c = F.col(f"_in_{n}"), F.col(f"_c_{n}")
        if side == "all":
            v = F.when(F.col("_cell").isNull(), i).otherwise(c)
        elif a == "sum":
            v = F.coalesce(i, F.lit(0)) + F.coalesce(c, F.lit(0))
        elif a == "max":
            v = F.when(i.isNull() | (c > i), c).otherwise(i)
        else:
            v = F.when(i.isNull() | (c < i), c).otherwise(i)
        out.append(F.coalesce(v, empty[n]).alias(n))
    return joined.select(*df.columns, *out)


def value_counts(df: DataFrame, by: Sequence[str], x: str, name: str = "_cnt", ties: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value, so copies of a value never reach a sort."""
    return df.where(F.col(x).isNotNull()).groupBy(*by, x, *ties).agg(F.count(F.lit(1)).alias(name))


def text_number(c: Column) -> Column:
    """Number whose order follows the first six bytes of a text; the text breaks ties."""
    return F.conv(F.rpad(F.substring(F.hex(c), 1, 12), 12, "0"), 16, 10).cast("double")


def mid_ranks(df: DataFrame, by: Sequence[str], x: str, *, ties: Sequence[str] = (), limit: int = GROUP_LIMIT) -> DataFrame:
    """Average rank of every distinct ``x`` (then ``ties``): ``by, x, ties, _cnt, mid_rank``."""
    counts = value_counts(df, by, x, ties=ties)
    before = ordered(counts, by, x, {"_before": ("sum", F.col("_cnt"), "before")}, ties=ties, limit=limit)
    return before.select(*by, x, *ties, "_cnt", (F.col("_before") + (F.col("_cnt") + 1) / 2.0).alias("mid_rank"))


def percentiles(
    df: DataFrame,
    by: Sequence[str],
    x: str,
    probs: Mapping[str, float],
    *,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Exact linear-interpolation percentiles per group, without one buffer per group.

    Columns: ``by``, one per entry of ``probs``, and ``n_values``.
    """
    return weighted_percentiles(value_counts(df, by, x), by, x, {n: ("_cnt", q) for n, q in probs.items()}, {"n_values": "_cnt"}, limit=limit)


def weighted_percentiles(
    counts: DataFrame,
    by: Sequence[str],
    x: str,
    asked: Mapping[str, tuple[str, float]],
    totals: Mapping[str, str] = {},
    *,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Percentiles of several masks from one table of distinct values.

    ``counts`` has a row for each ``by, x`` and columns that count its occurrences, one a mask. ``asked`` maps an output name
    to ``(count column, probability)``, ``totals`` another to a count column, whose sum it gets. A group
    without an occurrence in a mask has a NULL percentile. All ranks come from one ordered pass; groups with
    more than ``limit`` distinct values are not ordered whole, but bracketed by sketches first.
    """
    counts = counts.where(F.col(x).isNotNull())
    keys = list(by)
    if not keys:
        counts, keys = counts.withColumn("_all", F.lit(0)), ["_all"]
    weights = sorted({w for w, _ in asked.values()} | set(totals.values()))
    if not large_groups(counts, keys, limit).isEmpty():
        return _bracketed(checkpoint(counts), keys, x, asked, totals, weights, limit).drop("_all")
    specs = {f"_b_{w}": ("sum", F.col(w), "before") for w in weights} | {f"_n_{w}": ("sum", F.col(w), "all") for w in weights}
    return _picked(_running(counts, keys, [x], specs, False), keys, x, asked, totals).drop("_all")


def _picked(ranked: DataFrame, keys: Sequence[str], x: str, asked: Mapping[str, tuple[str, float]], totals: Mapping[str, str]) -> DataFrame:
    """Percentiles of values with ``_b_<weight>`` occurrences before them and ``_n_<weight>`` in all."""
    aggs, final = [], []
    for name, (w, q) in asked.items():
        n, first, last = F.col(f"_n_{w}"), F.col(f"_b_{w}"), F.col(f"_b_{w}") + F.col(w) - 1
        pos = (n - 1) * F.lit(float(q))
        for tag, p in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            aggs.append(F.max(F.when((first <= p) & (p <= last), F.col(x).cast("double"))).alias(f"_{tag}_{name}"))
        lo, hi, n = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), (F.col(f"_m_{w}") - 1) * F.lit(float(q))
        final.append((lo + (hi - lo) * (n - F.floor(n))).alias(name))
    used = sorted({w for w, _ in asked.values()} | set(totals.values()))
    agg = ranked.groupBy(*keys).agg(*aggs, *[F.max(f"_n_{w}").alias(f"_m_{w}") for w in used])
    return agg.select(*keys, *final, *[F.col(f"_m_{w}").alias(name) for name, w in totals.items()])


def _bracketed(counts: DataFrame, keys: Sequence[str], x: str, asked: Mapping[str, tuple[str, float]], totals: Mapping[str, str], weights: Sequence[str], limit: int) -> DataFrame:
    """Ranks of groups with very many distinct values: a sketch of a mask's values brackets each, and only what lies in a bracket is ordered.

    Sketches see distinct values; where copies push a rank out of its bracket (which the exact counts on both sides tell),
    the bracket is widened.
    """
    n_of = counts.groupBy(*keys).agg(*[F.sum(w).alias(f"_n_{w}") for w in weights], *[
        F.kll_sketch_agg_double(F.when(F.col(w) > 0, F.col(x).cast("double")), F.lit(SKETCH)).alias(f"_s_{w}") for w in {w for w, _ in asked.values()}])
    n_of = checkpoint(n_of)
    done = n_of.select(*keys, *[F.col(f"_n_{w}").alias(name) for name, w in totals.items()])
    for name, (w, q) in asked.items():
        left, width, found = _named(n_of.where(F.col(f"_n_{w}") > 0), keys, f"_n_{w}", f"_s_{w}"), BRACKET, None
        while True:
            edge = lambda r: F.kll_sketch_get_quantile_double(F.col(f"_s_{w}"), F.lit(float(r)))
            low = edge(q - width) if q > width else F.lit(float("-inf"))
            high = edge(q + width) if q + width < 1 else F.lit(float("inf"))
            bounds = checkpoint(left.withColumns({"_lo": low, "_hi": high}).drop(f"_s_{w}"))
            v = F.col(x).cast("double")
            met = counts.where(F.col(w) > 0).join(bounds, _same(keys)).where(v <= F.col("_hi"))
            below = met.groupBy(*keys).agg(F.sum(F.when(v < F.col("_lo"), F.col(w)).otherwise(0)).alias("_below"), F.sum(w).alias("_upto"), F.max(f"_n_{w}").alias("_n"))
            pos = (F.col("_n") - 1) * F.lit(float(q))
            fits = (F.col("_below") <= F.floor(pos)) & (F.ceil(pos) < F.col("_upto"))
            below = checkpoint(below.withColumn("_fits", fits))
            inside = met.where(v >= F.col("_lo")).select(*keys, x, w)
            some = ordered(inside, keys, x, {"_before": ("sum", F.col(w), "before")}, limit=limit)
            placed = some.join(_named(below.where("_fits"), keys, "_below", "_n"), _same(keys)).select(*keys, x, w, (F.col("_before") + F.col("_below")).alias(f"_b_{w}"), F.col("_n").alias(f"_n_{w}"))
            got = _picked(placed, keys, x, {name: (w, q)}, {})
            found = checkpoint(got) if found is None else checkpoint(found.unionByName(got))
            rest = _named(below.where(~F.col("_fits")), keys, prefix="_m")
            if rest.isEmpty():
                break
            left = left.join(rest, _same([f"_k{i}" for i in range(len(keys))], "_m"), "left_semi")
            width *= 4
        done = done.join(_named(found, keys, name), _same(keys), "left").drop(*[f"_k{i}" for i in range(len(keys))])
    return done.select(*keys, *asked, *totals)


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group. The rank filter is pushed below the shuffle as a
    per-task group limit, so a large group sends at most ``k`` rows per task."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def hash_key(*cols: Column, seed: str = "") -> Column:
    """SHA-256 text of a seeded key; its order is a reproducible random permutation."""
    return F.sha2(F.concat_ws(":", F.lit(seed), *[c.cast("string") for c in cols]), 256)


def hash_number(h: Column) -> Column:
    """First 52 bits of a SHA-256 text as a double: uniform, so its ranges are even."""
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double")


def permutation_index(df: DataFrame, key: str, *, seed: str, by: Sequence[str] = (), name: str = "pos",
                      limit: int = GROUP_LIMIT) -> DataFrame:
    """0-based place of each distinct ``key`` in the seeded random order.

    Hashes are uniform, so a group with more rows than a task should hold is cut into even ranges of them, without a sample.
    """
    keys, most = list(by) or ["_all"], min(limit, ROWS_A_TASK)
    d = df.withColumn("_h", hash_key(F.col(key), seed=seed)).withColumn("_u", hash_number(F.col("_h")))
    d = d if by else d.withColumn("_all", F.lit(0))
    sizes = checkpoint(large_groups(d, keys, most))
    large = not sizes.isEmpty()
    if large:
        cell = F.floor(F.col("_u") * F.ceil(2 * F.col("_n") / most) / 2**52).cast("int")
        d = checkpoint(d.join(_named(sizes, keys, "_n"), _same(keys), "left").select(*d.columns, cell.alias("_cell")))
    return _running(d, keys, ["_u", "_h"], {name: ("sum", F.lit(1), "before")}, large).select(*df.columns, name)


def set_digest(df: DataFrame, by: Sequence[str], text: Column, name: str = "digest", *, distinct: bool = True) -> DataFrame:
    """Order-free digest of the set (or bag) of ``text`` per group.

    Each element is hashed and the hash limbs are summed, so the state per group is a
    handful of numbers, never a list. Columns: ``by, n_items, name``.
    """
    d = df.select(*by, F.sha2(text, 256).alias("_h"))
    if distinct:
        d = d.distinct()
    names = [f"_l{i}" for i in range(4)]
    agg = d.groupBy(*by).agg(F.count(F.lit(1)).alias("n_items"), *digest_limbs(F.col("_h"), names))
    return agg.select(*by, "n_items", digest_of_limbs(F.col("n_items"), [F.col(n) for n in names]).alias(name))


def digest_limbs(h: Column, names: Sequence[str]) -> list[Column]:
    """Aggregates: sums of the limbs of SHA-256 texts, which add up over parts of a set."""
    return [F.sum(F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).alias(n) for i, n in enumerate(names)]


def digest_of_limbs(n: Column, limbs: Sequence[Column]) -> Column:
    return F.sha2(F.concat_ws("|", n.cast("string"), *[F.coalesce(x.cast("string"), F.lit("0")) for x in limbs]), 256)
