"""Validation rules whose result is a table of problems: ``rule, severity, key, message``.

Rules that look at the same grouping share one aggregate: a pass over the rows, one per
slide, one per entity, one per file and one per key, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import LABEL_PATTERN
from ..session import checkpoint
from .skew import set_digest, top_k

Rule = tuple[str, str, Column, Column]
#: Rows of a file of the section table, which compresses to a tenth of what its rows take in a sort.
ROWS_A_FILE = 50_000
#: Names the rules have for columns of the section table, and the columns they look at.
SHORT = {"in_vsi_index": "in_index", "in_slides_csv": "in_record", "vsi_path": "path"}
INPUT = ("row_kind", "tube_id", "group", "arm", "scan", "section_label", "physical_section_label", "box", "condition", "has_negative_control", "n_sections_recorded", "n_sections_on_slide",
         "in_record", "in_index", "exposure_is_standard", "pixel_size_um", "notes", "use_for_measurement", "tube_id_in_file", "path")


def rules_to_rows(df: DataFrame, key: Column, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate ``(rule, severity, fails, message)`` on every row of ``df`` in one pass."""
    found = [
        F.when(F.coalesce(bad, F.lit(False)), F.struct(
            F.lit(name).alias("rule"), F.lit(sev).alias("severity"), key.alias("key"),
            F.coalesce(msg.cast("string"), F.lit("")).alias("message")))
        for name, sev, bad, msg in rules
    ]
    return df.select(F.inline(F.filter(F.array(*found), lambda p: p.isNotNull())))


def validate_manifest(df: DataFrame, *, forbidden: Sequence[int] = (), pixel_um: float = 0.325, pixel_tol: float = 0.001) -> DataFrame:
    """All rules of the section table, as ``finish_manifest`` gives it. The rules look at it in several ways, so it is written once, in
    files that keep the rows of a task bounded."""
    c = F.col
    df = checkpoint(df.withColumnsRenamed({a: b for a, b in SHORT.items() if a in df.columns and b not in df.columns}).select(*INPUT), rows_a_file=ROWS_A_FILE)
    sec = df.where(c("row_kind") == "section")
    text = lambda x: x.cast("string")
    tube, slide = text(c("tube_id")), F.concat_ws("/", text(c("tube_id")), c("scan"))
    unresolved = c("condition") == "unresolved"
    in_index, in_record = F.coalesce("in_index", F.lit(False)), F.coalesce("in_record", F.lit(False))
    off_pixel = F.abs(c("pixel_size_um") - pixel_um) > pixel_tol

    rows = rules_to_rows(sec, F.concat_ws("/", text(c("tube_id")), c("scan"), c("section_label")), [
        ("pixel_size", "ERROR", off_pixel, F.lit("pixel size out of tolerance")),
    ])
    labels = rules_to_rows(
        sec.where((c("section_label") != "") & ~c("section_label").rlike(LABEL_PATTERN)).select("section_label").distinct(),
        c("section_label"), [("label_format", "ERROR", F.lit(True), F.lit("not a zero-padded two-character label"))])

    per_slide = sec.groupBy("tube_id", "scan").agg(
        F.bool_and(unresolved).alias("all_un"), F.bool_or(c("condition") == "positive").alias("any_pos"),
        F.bool_and(F.coalesce("box", F.lit("")) == "").alias("no_box"),
        F.min("n_sections_recorded").alias("recorded"), F.min("n_sections_on_slide").alias("indexed"))
    slides = rules_to_rows(per_slide, slide, [
        ("section_count", "ERROR", (c("scan") == "original") & (c("recorded") != c("indexed")), F.concat_ws(" vs ", text(c("recorded")), text(c("indexed")))),
        ("no_positive", "ERROR", ~c("all_un") & ~c("any_pos"), F.lit("no positive section")),
        ("no_box_yet_condition", "ERROR", c("no_box") & ~c("all_un"), F.lit("condition without a box")),
    ])

    section = c("row_kind") == "section"
    flag = F.when(section, c("has_negative_control"))
    kept = F.coalesce("use_for_measurement", F.lit(False))
    std_bad = section & (c("exposure_is_standard") == F.lit(False))
    per_tube = df.groupBy("tube_id").agg(
        F.count_if(section & unresolved & in_index).alias("n_un"),
        F.min(F.when(section & unresolved & in_index & (F.coalesce("notes", F.lit("")) != ""), c("notes"))).alias("why"),
        F.count_if(section & in_index & ~in_record).alias("n_orphan"), F.count_if(c("row_kind") == "record_only").alias("n_only"),
        F.min(flag).alias("f0"), F.max(flag).alias("f1"), F.count_if(section & (c("condition") == "negative")).alias("n_neg"),
        F.count_if(std_bad & (c("scan") == "original")).alias("n_std_o"), F.count_if(std_bad & (c("scan") != "original")).alias("n_std_r"),
        F.count_if(section & (c("scan") == "rescan")).alias("n_rescan"),
        F.min(F.when(section & (F.coalesce("group", F.lit("")) != "") & (F.coalesce("arm", F.lit("")) == ""), c("group"))).alias("lost_group"),
        F.count_if(kept).alias("n_kept"), F.count_if(kept & (c("condition") == "positive")).alias("n_kept_pos"))
    tubes = rules_to_rows(per_tube, F.coalesce(tube, F.lit("")), [
        ("unresolved", "ERROR", c("n_un") > 0, F.concat_ws(": ", text(c("n_un")), F.coalesce("why", F.lit("no reason recorded")))),
        ("record_without_data", "ERROR", c("n_only") > 0, F.lit("in the record, no index file")),
        ("data_without_record", "ERROR", c("tube_id").isNotNull() & (c("n_orphan") > 0), F.lit("index file without a record")),
        ("flag_not_constant", "ERROR", c("f0") != c("f1"), F.lit("entity flag varies")),
        ("flag_vs_counts", "ERROR", (c("f0") == c("f1")) & (c("f0") != (c("n_neg") > 0)), text(c("n_neg"))),
        ("non_standard", "ERROR", c("tube_id").isNotNull() & (c("n_std_o") + c("n_std_r") > 0) & ~((c("n_rescan") > 0) & (c("n_std_r") == 0)), F.lit("non-standard and not rescanned")),
        ("forbidden_entity", "ERROR", c("tube_id").isin(*forbidden) if forbidden else F.lit(False), F.lit("must not appear")),
        ("unknown_group", "ERROR", c("tube_id").isNotNull() & c("lost_group").isNotNull(), c("lost_group")),
        ("entity_vanishes", "ERROR", c("tube_id").isNotNull() & (c("n_kept") == 0), F.lit("no row survives the measurement filter")),
        ("no_positive_kept", "ERROR", c("tube_id").isNotNull() & (c("n_kept") > 0) & (c("n_kept_pos") == 0), F.lit("no positive row survives")),
    ])

    per_kept = df.where(kept & c("tube_id").isNotNull()).groupBy("tube_id", "physical_section_label").agg(F.count(F.lit(1)).alias("n"))
    double = rules_to_rows(per_kept, F.concat_ws("/", tube, c("physical_section_label")), [("double_counted", "ERROR", c("n") > 1, text(c("n")))])

    per_file = sec.groupBy("path").agg(
        F.min("tube_id").alias("tube_id"), F.min("tube_id_in_file").alias("in_file"), F.bool_or(~in_index).alias("unread"),
        F.min(F.when(c("notes").contains("not binding"), c("notes"))).alias("refused"))
    in_file = F.trim(F.coalesce("in_file", F.lit("")))
    files = rules_to_rows(per_file, c("path"), [
        ("id_mismatch", "ERROR", (in_file != "") & c("tube_id").isNotNull() & ~F.coalesce(in_file.try_cast("bigint") == c("tube_id"), F.lit(False)), in_file),
        ("unreadable", "ERROR", c("unread"), F.lit("index could not be read")),
        ("refused_binding", "ERROR", c("refused").isNotNull(), c("refused")),
    ])

    per_key = sec.groupBy("tube_id", "scan", "section_label").agg(F.count(F.lit(1)).alias("n"))
    keys = rules_to_rows(per_key, F.concat_ws("/", tube, c("scan"), c("section_label")), [("duplicate_key", "ERROR", c("n") > 1, text(c("n")))])

    out = labels
    for part in (rows, slides, tubes, double, files, keys):
        out = out.unionByName(part)
    return out


def validate_record(df: DataFrame, key: str, *, header: Sequence[str] | None = None, key_range: tuple[int, int],
                    domains: Mapping[str, Sequence], implies: Sequence[tuple[str, Column, Column]] = (),
                    needs: str | None = None, forbidden: Sequence[int] = (), expected_rows: int | None = None) -> DataFrame:
    """Range, domain, cross-field, duplicate and size rules of a record table.

    ``implies`` holds ``(name, a, b)``: conditions that must be true together. A wrong
    header is the only problem reported, since nothing after it means anything.
    """
    if header is not None and list(header) != list(df.columns):
        return df.sparkSession.createDataFrame(
            [("header", "ERROR", "", ",".join(df.columns))], "rule string, severity string, key string, message string")
    k = F.col(key)
    text = F.coalesce(k.cast("string"), F.lit(""))
    rules: list[Rule] = [("key_range", "ERROR", k.isNull() | ~k.between(*key_range), text)]
    rules += [(f"domain_{c}", "ERROR", F.col(c).isNull() | ~F.col(c).isin(*v), F.col(c).cast("string")) for c, v in domains.items()]
    rules += [(n, "ERROR", F.coalesce(a, F.lit(False)) != F.coalesce(b, F.lit(False)), F.lit("fields contradict")) for n, a, b in implies]
    if forbidden:
        rules.append(("forbidden", "ERROR", k.isin(*forbidden), text))
    if needs:
        rules.append(("needs_confirmation", "WARN", F.trim(F.coalesce(needs, F.lit(""))) != "", F.trim(needs)))
    out = rules_to_rows(df, text, rules)
    per_key = df.where(k.isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    out = out.unionByName(rules_to_rows(per_key, text, [("duplicate", "ERROR", F.col("n") > 1, F.col("n"))]))
    if expected_rows is not None:
        size = df.agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(rules_to_rows(size, F.lit(""), [("row_count", "WARN", F.col("n") != expected_rows, F.col("n"))]))
    return out


def examples(problems: DataFrame, k: int = 8) -> DataFrame:
    """First ``k`` problems of every rule."""
    return top_k(problems, ["rule"], [F.col("key"), F.col("message")], k, "place")


def fingerprint(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Count and order-free digest of the rows of every named input."""
    out = None
    for name, df in sources.items():
        row = F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
        d = set_digest(df.select(F.lit(name).alias("source"), row.alias("_row")), ["source"], F.col("_row"), distinct=False)
        out = d if out is None else out.unionByName(d)
    return out


def is_stale(now: DataFrame, then: DataFrame) -> DataFrame:
    """Sources whose digest differs, or that appear on one side only."""
    old = then.select("source", F.col("digest").alias("old"))
    return now.join(old, "source", "full_outer").select("source", (~F.col("digest").eqNullSafe(F.col("old"))).alias("stale"))
