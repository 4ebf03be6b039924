"""Conditions, bench patches, preference and rules on small hand-made tables."""

from pyspark.sql import functions as F

from cohortspark.operators import conditions as C
from cohortspark.operators.rules import validate_record
from cohortspark.operators.summarise import entity_flag, separation


def test_three_states(spark):
    rows = [
        (1, True, "", "far_label", "far_label", True), (2, True, "", "far_label", "near_label", True), (3, True, "", "both", None, False),
        (4, True, "ask", "both", "far_label", True), (5, False, None, None, "far_label", True), (6, True, "", "left", "far_label", True),
        (7, True, "", "near_label", None, False), (8, True, "nan", "near_label", "near_label", True), (9, True, "", "near_label", None, True),
        (10, True, "no", "far_label", "far_label", True), (11, True, "0", "both", None, True)]
    d = spark.createDataFrame(rows, "id int, in_record boolean, needs_confirmation string, positive_box string, box string, slide_has_box boolean")
    got = {r.id: (r.condition, bool(r.reason)) for r in C.derive_condition(d).collect()}
    assert got == {1: ("positive", False), 2: ("negative", False), 3: ("positive", False), 4: ("unresolved", True), 5: ("unresolved", True),
                   6: ("unresolved", True), 7: ("unresolved", True), 8: ("positive", False), 9: ("unresolved", False),
                   10: ("unresolved", True), 11: ("unresolved", True)}


def sections(spark):
    rows = [(49, s, lab, lab, "positive", True, s == "rescan") for s in ("original", "rescan") for lab in ("01", "02")]
    rows += [(51, "original", "03", "03", "positive", True, False), (51, "rescan", "01", "03", "positive", True, True),
             (33, "original", "01", "01", "positive", True, False), (33, "rescan", "01", "new01", "unresolved", False, True)]
    return spark.createDataFrame(rows, "tube_id int, scan string, section_label string, physical_section_label string, condition string, analysis_include boolean, scan_is_preferred boolean")


def test_patches_and_preference(spark):
    notes = spark.createDataFrame([
        (1, 49, "rescan", "01", "exclude_section", "blurred"), (2, 49, "original", "01", "flag_artefact", "dirt"),
        (3, 49, "original", "", "prefer_scan", "use original"), (4, 51, "rescan", "01", "flag_quality", "dim"), (5, 51, "", "", "prefer_section", "later")],
        "ord int, tube_id int, scan string, section_label string, action string, note string")
    d = C.apply_patches(sections(spark), notes)
    r = {(x.tube_id, x.scan, x.section_label): x for x in d.collect()}
    assert not r[49, "rescan", "01"].analysis_include and r[49, "rescan", "02"].analysis_include
    assert r[49, "original", "01"].has_flagged_artefact and r[49, "original", "01"].bench_note == "use original"
    assert r[49, "original", "02"].bench_action == "prefer_scan" and r[49, "rescan", "02"].bench_action == ""
    assert r[51, "rescan", "01"].flagged_lower_quality and r[51, "rescan", "01"].bench_note == "later"
    use = {(x.tube_id, x.scan, x.section_label) for x in C.prefer(d).where("use_for_measurement").collect()}
    assert use == {(49, "original", "01"), (49, "original", "02"), (51, "rescan", "01"), (33, "original", "01")}
    one = C.prefer(d).groupBy("tube_id", "physical_section_label").agg(F.count_if("scan_is_preferred").alias("n"))
    assert {x.n for x in one.collect()} == {1}


def test_without_pin_the_usable_rescan_wins(spark):
    d = sections(spark).withColumn("bench_action", F.lit(""))
    use = {(x.tube_id, x.scan) for x in C.prefer(d).where("use_for_measurement").collect()}
    assert use == {(49, "rescan"), (51, "rescan"), (33, "original")}


def test_entity_flag_and_separation(spark):
    d = spark.createDataFrame([(1, "negative", 2.0), (1, "positive", 6.0), (2, "positive", 1.0), (3, "unresolved", 1.0), (None, "negative", 1.0)], "e int, condition string, v double")
    flags = {(r.e, r.has_negative_control) for r in entity_flag(d, "e").collect()}
    assert flags == {(1, True), (2, False), (3, None), (None, None)}
    assert {(r.e, r.separation) for r in separation(d.where("e is not null"), ["e"], "v").collect()} == {(1, 3.0), (2, None), (3, None)}


def test_collisions_all_go(spark):
    d = spark.createDataFrame([("a", "positive"), ("a", "negative"), ("b", "positive")], "k string, c string")
    kept, out = C.exclude_collisions(d, ["k"], "c")
    assert [r.k for r in kept.collect()] == ["b"] and out.first().conditions_seen == "negative,positive"


def test_record_header_stops_everything(spark):
    d = spark.createDataFrame([(1, "x")], "k int, box string")
    got = validate_record(d, "k", header=("k", "group", "box"), key_range=(29, 60), domains={})
    assert [r.rule for r in got.collect()] == ["header"]
