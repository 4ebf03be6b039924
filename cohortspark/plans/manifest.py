"""Section tables built from the operators: sections + record -> conditions -> report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import area_um2, within_tol
from ..functions.text import map_lookup
from ..operators.conditions import apply_patches, bookkeeping_rows, derive_condition, enrich, notes_as_rows, patched_within, prefer, preferred_within
from ..operators.matching import assign_sides, gap_split, match_columns, matched_within, nearest_match, split_status
from ..operators.sets import union_scans
from ..operators.skew import GROUP_LIMIT, rows_in_small_groups, together
from ..operators.summarise import attach, entity_flag, slide_summary
from ..session import checkpoint

#: The columns of the section table and their types, in order; those after ``warnings`` come from later passes.
COLUMNS = {
    "row_kind": "string", "tube_id": "bigint", "group": "string", "arm": "string", "scan": "string", "section_label": "string", "physical_section_label": "string", "series_name": "string",
    "box": "string", "condition": "string", "positive_box": "string", "has_negative_control": "boolean", "n_positive_sections_on_slide": "bigint", "analysis_include": "boolean",
    "slide_number_depth_index": "bigint", "n_sections_on_slide": "bigint", "n_sections_recorded": "bigint", "needs_confirmation": "string", "annotation": "string",
    "stage_x_um": "double", "stage_y_um": "double", "box_gap_ratio": "double", "box_split_gap_mm": "double", "pixel_size_um": "double", "width_px": "bigint", "height_px": "bigint",
    "area_px": "bigint", "area_um2": "double",
    "exposure_DAPI_ms": "double", "exposure_FITC_ms": "double", "exposure_Cy3_ms": "double", "exposure_is_standard": "boolean", "acquisition_time": "string",
    "in_slides_csv": "boolean", "in_vsi_index": "boolean", "payload_present": "boolean", "scan_is_preferred": "boolean", "stack_id": "bigint", "ets_path": "string", "ets_sha256": "string",
    "vsi_path": "string", "vsi_sha256": "string", "tube_id_in_file": "string", "rescan_matched_section_label": "string", "rescan_match_offset_um": "double", "notes": "string", "warnings": "string",
    "bench_note": "string", "bench_action": "string", "has_flagged_artefact": "boolean", "flagged_lower_quality": "boolean", "use_for_measurement": "boolean",
}
EXPOSURES = ("exposure_DAPI_ms", "exposure_FITC_ms", "exposure_Cy3_ms")


def section_conditions(sections: DataFrame, record: DataFrame, **split) -> DataFrame:
    """Condition and reason of every section, from stage geometry and the record.

    ``sections``: ``slide, section_label, x``; ``record``: ``slide, animal,
    positive_box, needs_confirmation``.
    """
    sides = assign_sides(sections, gap_split(sections, ["slide"], "x", **split), ["slide"], "x")
    sides = sides.withColumn("slide_has_box", F.col("split_status") == "ok")
    return derive_condition(enrich(sides, record, "slide"))


def slide_report(sections: DataFrame, record: DataFrame, **split) -> DataFrame:
    """One row per slide: section labels per condition, control flag and reason."""
    slides = slide_summary(section_conditions(sections, record, **split), ["slide", "animal", "positive_box", "reason"])
    # The flag needs only one row per slide, so sections are aggregated once.
    resolved, negative = F.col("n_unresolved") < F.col("n_sections"), F.col("negative_labels") != ""
    flags = slides.where(F.col("animal").isNotNull()).groupBy("animal").agg(
        F.when(F.bool_or(resolved), F.bool_or(negative)).alias("has_negative_control"))
    return attach(slides, flags, ["animal"])


def _within(originals: DataFrame, rescans: DataFrame, record: DataFrame, notes: DataFrame, rows: int, split: Mapping) -> DataFrame:
    """``build_manifest`` for tubes that each fit a task: all four inputs are dealt by tube once, the rest is windows."""
    c, no = F.col, F.lit(False)
    both = lambda d, left: d.withColumns({"_l": F.lit(left), "_r": F.lit(not left), "_x": c("x").cast("double"), "_ll": c("section_label") if left else F.lit(None), "scan": F.lit("original" if left else "rescan")})
    extra = [n for n in record.columns if n != "tube_id"]
    d = both(originals, True).unionByName(both(rescans, False), allowMissingColumns=True)
    d = d.unionByName(record.select("tube_id", F.struct(*extra).alias("_record")), allowMissingColumns=True).unionByName(notes_as_rows(notes), allowMissingColumns=True)
    d = together(d.withColumns({"_l": F.coalesce("_l", no), "_r": F.coalesce("_r", no)}), ["tube_id"], rows)
    d = matched_within(d, ["tube_id"], "section_label")

    section, tube = c("_l") | c("_r"), W.partitionBy("tube_id")
    said = match_columns("section_label")
    status = F.when(c("n") > 0, split_status(**{k: v for k, v in split.items() if k in ("shapes", "min_ratio")}))
    d = d.withColumns({
        "split_status": F.when(section, status), "gap_ratio": F.when(section, F.try_divide(c("split_gap"), c("other_gap"))), "in_record": F.first(c("_record"), ignorenulls=True).over(tube),
        "_sections": F.max(section).over(tube), **{k: F.when(c("_r"), v) for k, v in said.items()}})
    ok, side_at = c("split_status") == "ok", lambda x: F.when(x <= c("split_lo"), "near_label").otherwise("far_label")
    d = d.withColumn("box", F.when(ok, F.when(c("_l"), side_at(c("_x"))).when(c("match_status") == "matched", side_at(c("_best.x"))).when(c("match_status") == "new", c("side"))))
    d = d.withColumns({
        "slide_has_box": F.when(c("_l"), ok).when(c("_r"), F.max(c("_r") & c("box").isNotNull()).over(tube)), "physical_section_label": F.when(c("_r"), F.coalesce("matched_label", "section_label")).when(c("_l"), c("section_label")),
        # A section has its tube's record; a record without sections is a row of its own.
        **{k: F.when(section, c("in_record")[k]).otherwise(c("_record")[k]) for k in extra}, "in_record": F.when(section, c("in_record").isNotNull()),
        "row_kind": F.when(section, "section").when(c("_record").isNotNull(), "record_only")})
    d = d.where(section | c("_note").isNotNull() | (c("_record").isNotNull() & (c("tube_id").isNull() | ~c("_sections"))))
    d = derive_condition(d)
    resolved = section & (c("condition") != "unresolved")
    flag = F.when(F.max(resolved).over(tube), F.max(section & (c("condition") == "negative")).over(tube))
    d = d.withColumns({"has_negative_control": F.when(section & c("tube_id").isNotNull(), flag), "condition": F.when(section, c("condition")).otherwise("unresolved"), "reason": F.when(section, c("reason"))})
    only = c("row_kind") == "record_only"
    d = d.withColumns({
        "scan": F.when(only, "original").otherwise(c("scan")), "section_label": F.when(only, "").otherwise(c("section_label")), "physical_section_label": F.when(only, "").otherwise(c("physical_section_label")),
        "analysis_include": section & (c("condition") != "unresolved"), "scan_is_preferred": c("_r")})
    d = d.drop("_l", "_r", "_x", "_ll", "_record", "_sections", "_best", "_left_label", "_off", "_hit", "_side", "_status", "_reason", "side", "n", "n_low", "n_high", "split_lo", "split_hi", "split_gap", "other_gap")
    return preferred_within(patched_within(d))


def _counted(rows: DataFrame) -> DataFrame:
    """Sections of a slide and positive ones among them, on tubes that lie whole in their tasks."""
    section, slide = F.col("row_kind") == "section", W.partitionBy("tube_id", "scan")
    return rows.withColumns({"n_sections_on_slide": F.sum(section.cast("bigint")).over(slide), "n_positive_sections_on_slide": F.sum((section & (F.col("condition") == "positive")).cast("bigint")).over(slide)})


def section_table(originals: DataFrame, rescans: DataFrame, record: DataFrame, notes: DataFrame, arms: Mapping[str, str], standard: Sequence[float], tolerance: float = 1e-3, *, limit: int = GROUP_LIMIT, **split) -> DataFrame:
    """``finish_manifest`` of ``build_manifest``; the counts a slide take no further shuffle where tubes are small."""
    rows = rows_in_small_groups([originals, rescans, record, notes], ["tube_id"], limit)
    if rows is None:
        return finish_manifest(_spread(originals, rescans, record, notes, **split), arms, standard, tolerance)
    return _finished(_counted(_within(originals, rescans, record, notes, rows, split)), arms, standard, tolerance)


def build_manifest(originals: DataFrame, rescans: DataFrame, record: DataFrame, notes: DataFrame, *, limit: int = GROUP_LIMIT, **split) -> DataFrame:
    """One row per section per scan, plus one per record without data.

    ``originals`` and ``rescans``: ``tube_id, section_label, x`` and any other columns;
    ``record``: ``tube_id, positive_box, needs_confirmation``; ``notes`` as in
    ``apply_patches``. A rescan takes its box from the original it matches, or from its
    side of the gap when it is new. Write the result before checking it: the rules read
    it several times. Tubes are counted first: where none has more than ``limit`` rows, all inputs are shuffled once.
    """
    rows = rows_in_small_groups([originals, rescans, record, notes], ["tube_id"], limit)
    return _spread(originals, rescans, record, notes, **split) if rows is None else _within(originals, rescans, record, notes, rows, split)


def _spread(originals: DataFrame, rescans: DataFrame, record: DataFrame, notes: DataFrame, **split) -> DataFrame:
    """``build_manifest`` by joins that a huge tube does not hold up."""
    slide = ["tube_id"]
    # Each stage is read several times by the next one, so stages are written once.
    splits = checkpoint(gap_split(originals, slide, "x", **split))
    first = assign_sides(originals, splits, slide, "x").withColumns({
        "scan": F.lit("original"), "physical_section_label": F.col("section_label"), "slide_has_box": F.col("split_status") == "ok"})

    match = checkpoint(nearest_match(originals, rescans, slide, "x", "section_label").drop("x"))
    again = attach(rescans, match, ["tube_id", "section_label"])
    again = attach(again, first.select("tube_id", F.col("section_label").alias("matched_label"), F.col("box").alias("_box")), ["tube_id", "matched_label"])
    again = attach(again, splits.select("tube_id", F.col("status").alias("split_status"), "gap_ratio"), slide)
    box = F.when(F.col("split_status") == "ok", F.when(F.col("match_status") == "matched", F.col("_box")).when(F.col("match_status") == "new", F.col("side")))
    again = again.withColumns({"box": box, "scan": F.lit("rescan"), "physical_section_label": F.coalesce("matched_label", "section_label")}).drop("_box", "side")
    again = checkpoint(again)
    again = attach(again, again.groupBy("tube_id").agg(F.bool_or(F.col("box").isNotNull()).alias("slide_has_box")), slide)

    both = derive_condition(enrich(union_scans(first, again), record, "tube_id"))
    both = both.withColumns({"analysis_include": F.col("condition") != "unresolved", "scan_is_preferred": F.col("scan") == "rescan"})
    flagged = checkpoint(entity_flag(checkpoint(both), "tube_id"))
    # Records without data join after the flag, which only sections decide.
    rows = bookkeeping_rows(flagged, record, "tube_id").fillna(
        {"scan": "original", "section_label": "", "physical_section_label": "", "condition": "unresolved", "analysis_include": False, "scan_is_preferred": False})
    return prefer(checkpoint(apply_patches(rows, notes)))


def finish_manifest(rows: DataFrame, arms: Mapping[str, str], standard: Sequence[float], tolerance: float = 1e-3) -> DataFrame:
    """The rows of ``build_manifest`` with all ``COLUMNS``, as ``validate_manifest`` wants them.

    What sections and record brought along is kept under its name (``x`` is the stage coordinate); counts a slide, areas, the arm of
    the group and whether exposures are ``standard`` are worked out; the rest is NULL.
    """
    counts = rows.where(F.col("row_kind") == "section").groupBy("tube_id", "scan").agg(F.count(F.lit(1)).alias("n_sections_on_slide"), F.count_if(F.col("condition") == "positive").alias("n_positive_sections_on_slide"))
    return _finished(attach(rows.drop(*(c for c in counts.columns if c not in ("tube_id", "scan"))), counts, ["tube_id", "scan"]), arms, standard, tolerance)


def _finished(d: DataFrame, arms: Mapping[str, str], standard: Sequence[float], tolerance: float) -> DataFrame:
    section = F.col("row_kind") == "section"
    own = lambda c: F.col(c) if c in d.columns else F.lit(None).cast(COLUMNS.get(c, "string"))
    known: dict[str, Column] = {
        "arm": F.coalesce(map_lookup(own("group"), arms), F.lit("")), "stage_x_um": own("x"), "box_gap_ratio": own("gap_ratio"), "box_split_gap_mm": own("split_gap_mm"),
        "area_px": own("width_px") * own("height_px"), "area_um2": area_um2(own("width_px"), own("height_px"), own("pixel_size_um")),
        "exposure_is_standard": F.when(section & own(EXPOSURES[0]).isNotNull(), within_tol([own(c) for c in EXPOSURES], list(standard), tolerance)),
        "in_slides_csv": F.coalesce(own("in_record"), F.lit(False)) | ~section, "in_vsi_index": F.coalesce(own("in_vsi_index"), section),
        "rescan_matched_section_label": own("matched_label"), "notes": F.coalesce(own("reason"), F.lit("")), "warnings": F.coalesce(own("match_reason"), F.lit("")),
        "n_sections_on_slide": F.coalesce("n_sections_on_slide", F.lit(0).cast("bigint")), "n_positive_sections_on_slide": F.coalesce("n_positive_sections_on_slide", F.lit(0).cast("bigint")),
    }
    return d.select(*[known.get(c, own(c)).cast(kind).alias(c) for c, kind in COLUMNS.items()])
