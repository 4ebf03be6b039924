"""Gap split, matching and pairing on slides with known answers."""

import itertools

import pytest

from cohortspark.operators import matching as M

SLIDES = {
    29: {"01": 26996.49, "02": 34637.33, "03": 53462.17, "04": 61301.52},
    49: {"01": 46994.60, "02": 25600.00, "03": 32349.60, "04": 54409.60},
    60: {"01": 25731.46, "02": 33455.81, "03": 47027.49, "04": 55125.60},
}
NEAR = {29: ["01", "02"], 49: ["02", "03"], 60: ["01", "02"]}


def frame(spark, slides):
    return spark.createDataFrame([(k, lab, x) for k, s in slides.items() for lab, x in s.items()], "slide int, section_label string, x double")


@pytest.mark.parametrize("limit", [2, 10**6])
def test_known_slides(spark, limit):
    d = frame(spark, SLIDES)
    g = M.gap_split(d, ["slide"], "x", limit=limit)
    near = {}
    for r in M.assign_sides(d, g, ["slide"], "x").where("box = 'near_label'").collect():
        near.setdefault(r.slide, []).append(r.section_label)
    assert {k: sorted(v) for k, v in near.items()} == NEAR
    r = g.where("slide = 49").first()
    assert r.split_gap_mm == pytest.approx(14.645) and r.within_gap_mm == pytest.approx(7.415) and not r.marginal


@pytest.mark.parametrize("mm,status", [
    ((26, 33, 45, 52), "ok"), ((26, 29, 32, 50), "bad_shape"), ((26, 44, 47, 50), "bad_shape"), ((26, 26.5, 27, 27.5), "bad_shape"),
    ((26, 33, 40.2, 47), "ambiguous"), ((26, 33), "too_few"), ((26,), "too_few"), ((5, 5, 5), "ambiguous"), ((1, 1, 5, 5), "ok")])
def test_refusals(spark, mm, status):
    d = spark.createDataFrame([(1, v * 1000.0) for v in mm], "slide int, x double")
    got = M.gap_split(d, ["slide"], "x").first().status
    assert got == status or (status == "bad_shape" and got == "ambiguous")


def test_input_order_does_not_matter(spark):
    rows = [(i, lab, SLIDES[49][lab]) for i, p in enumerate(itertools.permutations(SLIDES[49])) for lab in p]
    d = spark.createDataFrame(rows, "slide int, section_label string, x double")
    g = M.gap_split(d, ["slide"], "x")
    assert g.drop("slide").distinct().count() == 1 and g.count() == 24


@pytest.mark.parametrize("limit", [2, 10**6])
def test_nearest_match(spark, limit):
    left = frame(spark, {1: SLIDES[29], 2: SLIDES[29], 3: {k: v for k, v in SLIDES[29].items() if k != "04"}, 4: SLIDES[29], 5: {"01": 1.0}})
    right = frame(spark, {
        1: {"01": 53462.17 + 300, "02": 61301.52 - 300}, 2: {"01": 53462.17 + 300, "02": 53462.17 - 300},
        3: {"01": 61301.52, "02": 53400.0}, 4: {"01": 44000.0}, 5: {"01": 1.0}})
    got = {(r.slide, r.section_label): r for r in M.nearest_match(left, right, ["slide"], "x", "section_label", limit=limit).collect()}
    assert (got[1, "01"].matched_label, got[1, "02"].matched_label) == ("03", "04") and got[1, "01"].match_offset == pytest.approx(300)
    assert got[2, "01"].match_status == "void" and "claim" in got[2, "02"].match_reason
    assert got[3, "01"].match_status == "new" and got[3, "01"].side == "far_label" and got[3, "01"].matched_label == "new01"
    assert got[3, "02"].matched_label == "03"
    assert got[4, "01"].match_status == "void" and got[5, "01"].match_status == "void"


def test_pairs_and_lookup(spark):
    d = spark.createDataFrame([(1, "original", "p"), (1, "rescan", "p"), (2, "original", "p"), (3, "original", "p"), (3, "rescan", "n"), (4, "rescan", "p"), (4, "other", "p"), (4, "original", "p")], "k int, scan string, c string")
    got = {(r.k, r.pair_ok) for r in M.select_pairs(d, ["k"], "scan", condition="c").collect()}
    assert got == {(1, True), (3, False)}
    ref = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    res = {r.k: (r.v, r.lookup_status) for r in M.lookup_one(d.select("k").distinct(), ref, ["k"], "v").collect()}
    assert res == {1: ("a", "ok"), 2: (None, "ambiguous"), 3: (None, "missing"), 4: (None, "missing")}


def test_ordinal_join_refuses_uneven_groups(spark):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "s int, n int")
    b = spark.createDataFrame([(1, 10005), (1, 10002), (2, 10002), (2, 10005)], "s int, stack int")
    got = {(r.s, r.n): (r.stack, r.bind_status) for r in M.ordinal_join(a, b, ["s"], "n", "stack").collect()}
    assert got == {(1, 1): (10002, "bound"), (1, 2): (10005, "bound"), (2, 1): (None, "count_mismatch"), (3, 1): (None, "no_payload")}
