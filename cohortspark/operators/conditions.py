"""Record joins, the three-state condition, patches from the bench, and preference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import is_flag, join_notes
from .skew import GROUP_LIMIT, rows_in_small_groups, together
from .summarise import attach


def enrich(sections: DataFrame, record: DataFrame, key: str) -> DataFrame:
    """Left join of the record; ``in_record`` says whether there was one. Spark picks
    broadcast or a skew-split sort-merge join from the real sizes."""
    return attach(sections, record.withColumn("in_record", F.lit(True)), [key]).withColumn(
        "in_record", F.coalesce("in_record", F.lit(False)))


def derive_condition(df: DataFrame) -> DataFrame:
    """Three-state condition with its reason.

    Needs ``in_record, needs_confirmation, positive_box, box, slide_has_box``. Any text in
    ``needs_confirmation`` but a written "nan" leaves the row unresolved, even "no".
    """
    pb = F.coalesce("positive_box", F.lit(""))
    reason = (
        F.when(~F.col("in_record"), "no record")
        .when(~F.lower(F.trim(F.coalesce(F.col("needs_confirmation").cast("string"), F.lit("")))).isin("", "nan"), F.concat(F.lit("needs confirmation: "), F.col("needs_confirmation")))
        .when(~pb.isin("near_label", "far_label", "both"), F.concat(F.lit("positive box is "), pb))
        .when((pb != "both") & ~F.coalesce("slide_has_box", F.lit(False)), "no box could be derived")
        .otherwise("")
    )
    condition = (
        F.when(reason != "", "unresolved")
        .when(pb == "both", "positive")
        .when(F.col("box").isNull(), "unresolved")
        .when(F.col("box") == pb, "positive")
        .otherwise("negative")
    )
    return df.withColumn("condition", condition).withColumn("reason", reason)


def reconcile(data: DataFrame, record: DataFrame, key: str) -> DataFrame:
    """One row per key: ``section`` (both), ``record_only`` or ``data_only``."""
    a = data.select(key).distinct().withColumn("_a", F.lit(True))
    b = record.select(key).distinct().withColumn("_b", F.lit(True))
    return a.join(b, key, "full_outer").select(
        key,
        F.when(F.col("_a") & F.col("_b"), "section").when(F.col("_b"), "record_only").otherwise("data_only").alias("row_kind"),
    )


def bookkeeping_rows(sections: DataFrame, record: DataFrame, key: str) -> DataFrame:
    """Sections plus one ``record_only`` row for each record without data."""
    only = record.join(sections.select(key).distinct(), key, "left_anti").withColumn("row_kind", F.lit("record_only"))
    return sections.withColumn("row_kind", F.lit("section")).unionByName(only, allowMissingColumns=True)


def attach_codes(df: DataFrame, codes: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their code, and the ids that have none (must be empty to go on)."""
    missing = df.select(key).where(F.col(key).isNotNull()).distinct().join(codes, key, "left_anti")
    return df.join(codes, key), missing


def notes_as_rows(notes: DataFrame) -> DataFrame:
    """Notes under the keys of the sections, to be dealt out with them: ``_note`` is NULL for a section."""
    blank = F.lit("")
    return notes.select("tube_id", F.coalesce(F.trim("scan"), blank).alias("scan"), F.coalesce(F.trim("section_label"), blank).alias("section_label"),
                        F.struct("ord", "action", "note").alias("_note"))


def patched_within(d: DataFrame) -> DataFrame:
    """The work of ``apply_patches`` on tubes that lie whole in their tasks (``skew.together``): sections and ``notes_as_rows`` in one table."""
    c, blank = F.col, F.lit("")
    here, scan, tube = (W.partitionBy("tube_id", "scan", "section_label"), W.partitionBy("tube_id", "scan").orderBy("section_label"), W.partitionBy("tube_id").orderBy("scan", "section_label"))
    scan, tube = (w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing) for w in (scan, tube))
    label = W.partitionBy("tube_id", "section_label")
    pin = c("_note.action") == "prefer_scan"
    plain, any_scan, any_label = ~pin, c("scan") == blank, c("section_label") == blank
    # A section hears what was said at its point and at those with wildcards; a pinned scan speaks to the whole tube, and acts on its scan.
    heard = {"a": (here, plain, plain), "b": (scan, plain & any_label, (plain & any_label) | pin), "c": (tube, (plain & any_scan & any_label) | pin, any_scan & ((plain & any_label) | pin)),
             "d": (label, plain & any_scan, plain & any_scan)}
    flags = sum((F.when(c("_note.action") == a, 1 << i).otherwise(0) for i, a in enumerate(("flag_artefact", "flag_quality", "exclude_section"))), F.lit(0))
    for k, (w, says, acts) in heard.items():
        d = d.withColumns({f"_s{k}": F.max(F.when(says, F.struct("_note.ord", "_note.note"))).over(w), f"_a{k}": F.max(F.when(acts, F.struct("_note.ord", "_note.action"))).over(w),
                           f"_f{k}": F.bit_or(F.when(acts, flags)).over(w), **({"_pin": F.max(F.when(pin, F.struct("_note.ord", "scan"))).over(w)} if k == "c" else {})})
    said, done = F.greatest(*[c(f"_s{k}") for k in heard]), F.greatest(*[c(f"_a{k}") for k in heard])
    bits = F.lit(0)
    for k in heard:
        bits = bits.bitwiseOR(F.coalesce(f"_f{k}", F.lit(0)))
    return d.where(c("_note").isNull()).withColumns({
        "bench_note": F.coalesce(said["note"], blank), "bench_action": F.coalesce(done["action"], blank),
        "has_flagged_artefact": bits.bitwiseAND(1) != 0, "flagged_lower_quality": bits.bitwiseAND(2) != 0,
        "analysis_include": c("analysis_include") & (bits.bitwiseAND(4) == 0),
        "scan_is_preferred": F.when(c("_pin").isNotNull(), c("scan") == c("_pin.scan")).otherwise(c("scan_is_preferred")),
    }).drop("_note", "_pin", *[f"_{x}{k}" for x in "saf" for k in heard])


def preferred_within(d: DataFrame) -> DataFrame:
    """The work of ``prefer`` on tubes that lie whole in their tasks."""
    usable = F.col("condition").isin("positive", "negative") & F.coalesce("analysis_include", F.lit(False))
    pins = F.min(F.when(F.col("bench_action") == "prefer_scan", F.struct("scan", "section_label"))).over(W.partitionBy("tube_id"))
    d = d.withColumn("_pin", pins["scan"])
    d = d.withColumn("_rank", _rank(usable))
    return d.withColumn("_best", F.min("_rank").over(W.partitionBy("tube_id", "physical_section_label"))).withColumn(
        "scan_is_preferred", F.col("_rank") == F.col("_best")).withColumn("use_for_measurement", F.col("scan_is_preferred") & usable).drop("_pin", "_rank", "_best")


def patch_and_prefer(df: DataFrame, notes: DataFrame, *, limit: int = GROUP_LIMIT) -> DataFrame:
    """``prefer(apply_patches(df, notes))``. Where no tube has more than ``limit`` sections and notes, they are shuffled once."""
    rows = rows_in_small_groups([df, notes], ["tube_id"], limit)
    if rows is None:
        return prefer(apply_patches(df, notes))
    return preferred_within(patched_within(together(df.unionByName(notes_as_rows(notes), allowMissingColumns=True), ["tube_id"], rows)))


def _rank(usable) -> Column:
    return F.struct(
        F.when(F.coalesce(F.col("scan") == F.col("_pin"), F.lit(False)), 0)
        .when(usable & (F.col("scan") == "rescan"), 1).when(usable, 2).otherwise(3).alias("p"),
        F.col("scan").alias("s"), F.col("section_label").alias("l"))


def apply_patches(df: DataFrame, notes: DataFrame) -> DataFrame:
    """Overlay bench notes; a blank scan or label matches any, later notes win.

    ``df``: ``tube_id, scan, section_label, scan_is_preferred, analysis_include``;
    ``notes``: ``ord, tube_id, scan, section_label, action, note``. Notes are reduced to
    one row per key, wildcards as they stand; a section probes that table with its four keys.
    """
    n = notes.select("ord", "tube_id", F.coalesce(F.trim("scan"), F.lit("")).alias("scan"),
                     F.coalesce(F.trim("section_label"), F.lit("")).alias("section_label"), "action", "note")
    # A note speaks at one point of the lattice of wildcards; a pinned scan speaks to the whole tube, and acts on its scan.
    point = lambda scan, label, note, action, pin: F.struct(scan.alias("scan"), label.alias("section_label"), note.alias("says"), action.alias("acts"), pin.alias("pins"))
    yes, no, blank = F.lit(True), F.lit(False), F.lit("")
    spots = F.when(F.col("action") == "prefer_scan", F.array(point(blank, blank, yes, no, yes), point(F.col("scan"), blank, no, yes, no))).otherwise(
        F.array(point(F.col("scan"), F.col("section_label"), yes, yes, no)))
    each = n.select("ord", "tube_id", "action", "note", F.col("scan").alias("pinned"), F.explode(spots).alias("p")).select("*", "p.*").drop("p")
    last = lambda c, when: F.max(F.when(when, F.struct("ord", c)))
    flag = lambda action: F.bool_or(F.col("acts") & (F.col("action") == action))
    spoken = each.groupBy("tube_id", "scan", "section_label").agg(
        last("note", F.col("says")).alias("_note"), last("action", F.col("acts")).alias("_action"), last("pinned", F.col("pins")).alias("_pin"),
        flag("flag_artefact").alias("_art"), flag("flag_quality").alias("_low"), flag("exclude_section").alias("_cut"))
    # A section listens at its four points.
    own = ["tube_id", "scan", "section_label"]
    heard = F.array_distinct(F.array(*[F.struct(s.alias("s"), la.alias("l")) for s in (F.col("scan"), blank) for la in (F.col("section_label"), blank)]))
    asked = df.select(*own).distinct().withColumn("p", F.explode(heard)).select(*own, F.col("p.s").alias("_s"), F.col("p.l").alias("_l"))
    spoken = spoken.withColumnsRenamed({"tube_id": "_t", "scan": "_ps", "section_label": "_pl"})
    met = asked.join(spoken, (F.col("_s") == F.col("_ps")) & (F.col("_l") == F.col("_pl")) & F.col("tube_id").eqNullSafe(F.col("_t")))
    found = met.groupBy(*own).agg(*[F.max(c).alias(c) for c in ("_note", "_action", "_pin")], *[F.bool_or(c).alias(c) for c in ("_art", "_low", "_cut")])
    out = attach(df, found, own)
    sure = lambda c: F.coalesce(F.col(c), no)
    return out.withColumns({
        "bench_note": F.coalesce(F.col("_note")["note"], blank),
        "bench_action": F.coalesce(F.col("_action")["action"], blank),
        "has_flagged_artefact": sure("_art"),
        "flagged_lower_quality": sure("_low"),
        "analysis_include": F.col("analysis_include") & ~sure("_cut"),
        "scan_is_preferred": F.when(F.col("_pin").isNotNull(), F.col("scan") == F.col("_pin")["pinned"]).otherwise(F.col("scan_is_preferred")),
    }).drop("_note", "_action", "_pin", "_art", "_low", "_cut")


def prefer(df: DataFrame, entity: str = "tube_id", section: str = "physical_section_label") -> DataFrame:
    """Exactly one preferred row per physical section, and ``use_for_measurement``.

    Rank: scan pinned at the bench, usable rescan, usable scan first by name, first row.
    ``(entity, section, scan, section_label)`` must be unique.
    """
    usable = F.col("condition").isin("positive", "negative") & F.coalesce("analysis_include", F.lit(False))
    pins = df.where(F.col("bench_action") == "prefer_scan").groupBy(entity).agg(
        F.min_by("scan", F.struct("scan", "section_label")).alias("_pin"))
    d = attach(df, pins, [entity]).withColumn("_rank", _rank(usable))
    best = d.groupBy(entity, section).agg(F.min("_rank").alias("_best"))
    d = attach(d, best, [entity, section])
    return d.withColumn("scan_is_preferred", F.col("_rank") == F.col("_best")).withColumn(
        "use_for_measurement", F.col("scan_is_preferred") & usable).drop("_pin", "_rank", "_best")


def exclude_collisions(df: DataFrame, keys: Sequence[str], condition: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a unique key, and one row per key that collides. All colliding rows go:
    which of them is right cannot be known. Conditions are a closed vocabulary."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"),
                              F.array_join(F.array_sort(F.collect_set(condition)), ",").alias("conditions_seen"))
    kept = attach(df, g.select(*keys, "n_rows"), keys).where(F.col("n_rows") == 1).drop("n_rows")
    return kept, g.where(F.col("n_rows") > 1).withColumn("reason", F.lit("ambiguous_duplicate_rows"))


def first_per(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each group by ``order``, found by a combinable minimum."""
    rest = [c for c in df.columns if c not in by]
    pick = F.min(F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *rest)).alias("_f")
    return df.groupBy(*by).agg(pick).select(*by, *[F.col("_f")[c].alias(c) for c in rest])


def with_notes(df: DataFrame, reason: str, *notes: str) -> DataFrame:
    return df.withColumn("notes", join_notes(F.col(reason), *[F.col(n) for n in notes]))
