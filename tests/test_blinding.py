"""Pseudonym properties, and detectors that must fire on planted leaks and stay quiet otherwise."""

import pytest
from pyspark.sql import functions as F

from cohortspark.operators import audit as A
from cohortspark.operators import blinding as B

SEED = "orchid-7-basalt-19"
TUBES = [t for t in range(29, 61) if t != 59]


def group_of(t):
    return "Rapamycin Diet" if t <= 40 else "Extra Control Diet" if t <= 48 else "Control IP (vehicle)" if t <= 54 else "Rapamycin IP"


@pytest.fixture(scope="module")
def roster(spark):
    return spark.createDataFrame([(t, group_of(t)) for t in TUBES], "tube_id int, group string")


@pytest.fixture(scope="module")
def codes(roster):
    return B.assign_codes(roster, "tube_id", SEED).join(roster, "tube_id").cache()


def rows(codes, **extra):
    d = codes.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(4)))).select(
        "code", F.format_string("%02d", "n").alias("section_label"), F.when(F.col("n") < 3, "positive").otherwise("negative").alias("condition"),
        F.col("tube_id").alias("_t"), F.col("group").alias("_g"), "n")
    return d.select("code", "section_label", "condition", *[v.alias(k) for k, v in extra.items()])


def test_codes(roster, codes, spark):
    got = {r.tube_id: r.code for r in codes.collect()}
    assert len(set(got.values())) == len(TUBES) and all(len(c) >= 3 and c[0].isalpha() and c[1] == "0" for c in got.values())
    again = {r.tube_id: r.code for r in B.assign_codes(roster.orderBy(F.desc("tube_id")), "tube_id", SEED).collect()}
    other = {r.tube_id: r.code for r in B.assign_codes(roster, "tube_id", SEED + "x").collect()}
    assert again == got and other != got
    weak = lambda s: {r.tube_id: r.code for r in B.assign_codes(roster, "tube_id", s, allow_weak_seed=True).collect()}
    assert weak(42) == weak("42")


@pytest.mark.parametrize("seed", [None, "", "PENDING_PI_DECISION", 20260807, 19991231, 42, 12345, "password", "abc123", "aaaaaaaaaaaa", "password1234", "passwordpassword", "abcabcabcabc", 12345678901])
def test_weak_seeds_are_refused(roster, seed):
    with pytest.raises(ValueError):
        B.assign_codes(roster, "tube_id", seed)


def test_extension_keeps_issued_codes(roster, spark):
    old = B.assign_codes(roster.where("tube_id < 50"), "tube_id", SEED, width=2)
    new = {r.tube_id: r.code for r in B.extend_codes(old, roster, "tube_id", SEED, width=2).collect()}
    assert set(new) == set(TUBES) and len(set(new.values())) == len(TUBES)
    assert all(new[r.tube_id] == r.code for r in old.collect())


def checks(df, column=None):
    return {(r.severity, r.check) for r in df.collect() if column is None or r.column == column}


def test_clean_table_has_no_leak(codes):
    stats = A.column_statistics(rows(codes), codes, "tube_id", "group")
    assert checks(A.audit_columns(stats)) == set()
    assert A.audit_ids(rows(codes), codes, "tube_id").count() == 0
    assert A.audit_terms(rows(codes, marker=F.lit("has_negative_control")), A.group_vocabulary(codes, ["group"])).count() == 0


PLANTED = {
    "a": ("cast(_t as string)", "one_to_one"), "b": ("_g", "recovers_groups"), "c": ("concat(_g, _t % 2)", "group_pure"),
    "d": ("floor(_t / 5)", "monotone_in_id"), "e": ("if(_t = 51, 1, 0)", "rare_values"), "f": ("concat('2026-07-', _t - 28)", "one_to_one")}


def test_planted_columns(codes):
    d = rows(codes, **{k: F.expr(v) for k, (v, _) in PLANTED.items()})
    found = A.audit_columns(A.column_statistics(d, codes, "tube_id", "group")).collect()
    assert {r.column: r.check for r in found} == {k: c for k, (_, c) in PLANTED.items()}


def test_planted_values(codes):
    d = rows(codes, a=F.concat(F.lit("60_20x section of "), F.col("_t").cast("string")), b=F.lit("/RawData/Image_3.tif"), c=F.lower("_g"), d=F.lit(15360).cast("string"), e=F.lit("23:30:42"))
    ids = {r.column for r in A.audit_ids(d, codes, "tube_id").collect()}
    assert "a" in ids and not ids & {"d", "e", "code", "section_label"}
    terms = checks(A.audit_terms(d, A.group_vocabulary(codes, ["group"])))
    assert ("LEAK", "term") in terms and ("LEAK", "path") in terms
    assert {r.column for r in A.audit_structure(d.withColumn("scan_path", F.lit(1)), codes).collect()} == {"scan_path"}


def test_order_audit_fires_on_ordered_codes(codes, spark):
    planted = codes.withColumn("code", F.concat(F.lit("Q"), F.col("tube_id").cast("string")))
    s = A.order_statistics(planted, "tube_id", "code", "group", n_perm=150)
    r = s.first()
    assert r.rho == pytest.approx(1) and r.n_adjacent == 27 and 5.5 < r.adjacent_null_mean < 9.5
    assert checks(A.audit_order(s)) == {("LEAK", "code_order"), ("LEAK", "adjacency")}
    plain = A.order_statistics(codes, "tube_id", "code", "group", n_perm=150)
    assert ("LEAK", "code_order") not in checks(A.audit_order(plain))


def test_key_audit(spark, roster):
    k = spark.createDataFrame([(str(t), f"K{t + 100}") for t in TUBES] + [("K07", "29"), ("99", "a b")], "tube_id string, code string")
    got = checks(A.audit_codes(k, "tube_id", "code", roster))
    assert {("LEAK", "key_not_an_id"), ("LEAK", "code_format"), ("RISK", "outside_roster")} <= got
    mono = A.audit_codes(k.where("code like 'K%' and tube_id <> 'K07'"), "tube_id", "code", roster)
    assert ("LEAK", "tails_monotone") in checks(mono)


def test_split(codes, spark):
    d = codes.select("tube_id", F.lit("section").alias("row_kind"), F.lit("01").alias("section_label"), F.lit("positive").alias("condition"), F.lit("/x").alias("image_path"),
                     F.when(F.col("tube_id") == 51, 60.0).otherwise(128.547).alias("exposure_DAPI_ms"), F.lit(0.3250012).alias("pixel_size_um"))
    private, blinded, report = B.split_private_blinded(d, codes.select("tube_id", "code"), "tube_id", exposure=["exposure_DAPI_ms"])
    assert set(blinded.columns) == {"code", "row_kind", "section_label", "condition", "pixel_size_um", "exposure_is_standard", "replicate"}
    assert blinded.where("not exposure_is_standard").count() == 1 and blinded.first().pixel_size_um == 0.325
    assert "image_path" in private.columns and {c for c, keep, _ in report if not keep} >= {"tube_id", "image_path", "exposure_DAPI_ms"}
    assert B.unresolved_rows(d.withColumn("condition", F.lit("TBD"))).count() == len(TUBES)
    with pytest.raises(ValueError):
        B.split_columns(d, extra=["scan_day"])
    for bad in (d.withColumn("condition", F.lit("PENDING_PI_DECISION")), d.withColumn("needs_confirmation", F.lit("maybe")), d.withColumn("tube_id", F.col("tube_id") + 1000)):
        with pytest.raises(ValueError):
            B.split_private_blinded(bad, codes.select("tube_id", "code"), "tube_id")


def test_gaps_in_the_audit_are_closed(codes, spark):
    nameless = rows(codes).withColumn("code", F.when(F.col("section_label") != "01", F.col("code")))
    assert ("LEAK", "missing_code") in checks(A.audit_structure(nameless, codes))
    raw = rows(codes, a=F.lit("slide_29.vsi"), b=F.lit("frame_t.ets"))
    assert {r.column for r in A.audit_terms(raw, []).collect() if r.check == "path"} == {"a", "b"}
    with pytest.raises(ValueError):
        A.order_statistics(codes, "tube_id", "code", "group", n_perm=50)


def test_sets_are_ordered_as_if_spelled_out(spark):
    """Sets that agree in their first sixteen values and more, sets within sets, and single numbers."""
    import random

    rng = random.Random(3)
    base = [f"v{i:02d}" for i in range(20)]
    sets = {"e1": base, "e2": base[:19], "e3": base[:19] + ["v20"], "e4": [*base, "v99"], "e5": base[1:], "e6": base, "e7": ["v0"], "e8": ["v00"], "e9": [""]}
    sets |= {f"r{i}": rng.sample(base, rng.randrange(1, 9)) for i in range(25)}
    rows = [(e, v, 7.5) for e, vs in sets.items() for v in [*vs, vs[0]]]
    d = spark.createDataFrame(rows, "code string, a string, n double").repartition(5)
    for limit in (4, 10**6):
        found = {(r.column, r.entity): r for r in A.column_signatures(d, "code", limit).collect()}
        spelled = {e: "|".join(sorted(set(vs))) for e, vs in sets.items()}
        order = {s: i for i, s in enumerate(sorted(set(spelled.values())))}
        assert {e: found["a", e].signature - 1 for e in sets} == {e: order[s] for e, s in spelled.items()}
        assert {found["n", e].number for e in sets} == {7.5} and found["a", "e1"].number is None
