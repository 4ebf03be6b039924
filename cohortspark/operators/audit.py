"""Attacks on a blinded table. Every attack returns ``severity, check, column, detail``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import mask_numeric_noise, vocabulary_hits
from ..session import checkpoint
from .blinding import DENIED, denied_token
from .skew import GROUP_LIMIT, hash_key, mid_ranks, ordered, set_digest, text_number
from .stats import adjacent_equal, spearman
from .summarise import attach

# Fixed values.
PATH_LIKE = (
    r"(?i)(?:^|[\s,;=])(?:/|~/|\.\./|\./)|[A-Za-z]:[\\/]|\\\\[A-Za-z0-9._-]+\\"
    r"|\.(?:vsi|ets|tif|tiff|ome|czi|ndpi|svs|png|jpe?g|json|csv|xlsx?|qpproj|qpdata)\b|\bImage_\d+\b|\b_Image_\d+_\b"
)
TREATMENT_WORDS = ("rapamycin", "sirolimus", "vehicle", "saline", "placebo", "untreated", "diet", "chow", "intraperitoneal")
CODE_PATTERN = r"^[A-Za-z][A-Za-z0-9]{1,15}$"
MAX_RHO, COLUMN_RHO = 0.5, 0.9
LEAK_P, RISK_P = 0.01, 0.05
N_PERM = 20_000
RARE = 2

FINDING = "severity string, check string, column string, detail string"


def _finding(severity, check, column, detail):
    lit = lambda v: v if not isinstance(v, str) else F.lit(v)
    return [lit(severity).alias("severity"), lit(check).alias("check"), lit(column).alias("column"), lit(detail).cast("string").alias("detail")]


def _fixed(spark: SparkSession, rows: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rows), FINDING)


def audit_structure(blinded: DataFrame, codes: DataFrame, code: str = "code", deny: Sequence[str] = DENIED) -> DataFrame:
    """Rows without a code, codes without a key entry, a key that is not one-to-one, denied column names."""
    missing = blinded.where(F.col(code).isNull()).agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(*_finding("LEAK", "missing_code", code, F.col("n")))
    unknown = blinded.select(code).where(F.col(code).isNotNull()).distinct().join(codes.select(code), code, "left_anti")
    unknown = unknown.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(*_finding("LEAK", "unknown_code", code, F.col("n")))
    shared = codes.groupBy(code).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    names = [("LEAK", "denied_name", c, denied_token(c, deny)) for c in blinded.columns if denied_token(c, deny)]
    return missing.unionByName(unknown).unionByName(shared.select(*_finding("LEAK", "shared_code", code, F.col("n")))).unionByName(_fixed(blinded.sparkSession, names))


def audit_ids(blinded: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Raw ids as values or as digit-bounded parts of text, in any column or its name.

    Texts are cut into digit runs and joined to the ids, never matched id by id.
    """
    parts = []
    for f in blinded.schema.fields:
        c, name = F.col(f.name), F.lit(f.name).alias("column")
        if isinstance(f.dataType, T.StringType):
            toks, floating = F.regexp_extract_all(mask_numeric_noise(c), F.lit(r"(\d+)"), 1), F.lit(False)
        elif isinstance(f.dataType, T.IntegralType):
            toks, floating = F.array(c.cast("string")), F.lit(False)
        elif isinstance(f.dataType, (T.FractionalType, T.DecimalType)):
            toks, floating = F.when(c == F.floor(c), F.array(F.floor(c).cast("string"))), F.lit(True)
        else:
            continue
        parts.append(F.struct(name, F.coalesce(toks, F.array().cast("array<string>")).alias("tokens"), floating.alias("floating")))
    known = ids.select(F.col(key).cast("string").alias("token")).distinct()
    seen = blinded.select(F.inline(F.array(*parts))).select("column", "floating", F.explode("tokens").alias("token")).distinct()
    hits = seen.join(known, "token").groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.bool_or("floating").alias("floating"))
    values = hits.select(*_finding(F.when(F.col("floating") & (F.col("n") == 1), "RISK").otherwise("LEAK"), "id_value", F.col("column"), F.col("n")))
    runs = [(c, d) for c in blinded.columns for d in re.findall(r"\d+", c)]
    names = blinded.sparkSession.createDataFrame(runs, "column string, token string").join(known, "token").select(*_finding("LEAK", "id_in_name", F.col("column"), F.col("token")))
    return values.unionByName(names)


def group_vocabulary(df: DataFrame, columns: Sequence[str], max_labels: int = 1000) -> list[str]:
    """Group and arm labels with their words, and general treatment words. Groups are a
    design choice and few; more than ``max_labels`` is an error, not a bigger list."""
    out = set(TREATMENT_WORDS)
    for c in columns:
        rows = df.select(F.lower(F.trim(F.col(c))).alias("g")).distinct().limit(max_labels + 1).collect()
        if len(rows) > max_labels:
            raise ValueError(f"column {c!r} has too many labels to be a treatment group")
        for r in rows:
            if r["g"]:
                out |= {r["g"], *re.findall(r"[a-z]{3,}", r["g"])}
    return sorted(out)


def audit_terms(blinded: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Group or treatment words, and path-like values, in columns and their names."""
    text = [f.name for f in blinded.schema.fields if isinstance(f.dataType, T.StringType)]
    spark = blinded.sparkSession
    names = spark.createDataFrame([(c,) for c in blinded.columns], "column string")
    in_names = names.select("column", F.explode(vocabulary_hits(F.col("column"), vocabulary)).alias("term")).select(*_finding("LEAK", "term_in_name", F.col("column"), F.col("term")))
    path_names = names.where(F.col("column").rlike(PATH_LIKE)).select(*_finding("LEAK", "path_in_name", F.col("column"), F.col("column")))
    out = in_names.unionByName(path_names)
    if not text:
        return out
    each = blinded.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in text])))
    # A value is searched once, however many rows have it.
    values = each.where(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    said = lambda check, term: F.struct(F.lit(check).alias("check"), term.cast("string").alias("term"))
    path = F.when(F.col("v").rlike(PATH_LIKE), said("path", F.lit(None)))
    found = F.concat(F.transform(vocabulary_hits(F.col("v"), vocabulary), lambda t: said("term", t)), F.filter(F.array(path), lambda p: p.isNotNull()))
    hits = values.select("column", "n", F.inline(found)).groupBy("column", "check", "term").agg(F.sum("n").alias("n"))
    return out.unionByName(hits.select(*_finding("LEAK", F.col("check"), F.col("column"), F.coalesce("term", F.col("n").cast("string")))))


def _shuffled_orders(placed: DataFrame, n_perm: int, seed: str, limit: int) -> DataFrame:
    """``rep, n, dot, n_adjacent`` of ``n_perm`` random orders of ``_id, _rid, _g``.

    A replicate is cut into even ranges of its hashes, which are uniform, so rows are shuffled once and nothing has to be
    sampled or written: places within a range come from one window, and what the ranges before add from one row a range.
    Rows are ordered by 96 bits of their hash.
    """
    n = placed.count()
    ranges, tasks = min(1 << 16, n * 8 // limit + 1), min(100_000, n * n_perm * 2 // limit + 1)
    reps = placed.select("_id", "_rid", "_g").repartition(tasks, "_id").withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(n_perm))))
    h = hash_key(F.concat_ws("-", F.col("rep").cast("string"), F.col("_id").cast("string")), seed=seed)
    part = F.lit(0) if ranges == 1 else F.shiftright(F.conv(F.substring("_h", 1, 6), 16, 10).cast("bigint") * ranges, 24).cast("int")
    dealt = reps.withColumn("_h", h).select("rep", part.alias("_part"), F.unhex(F.substring("_h", 1, 24)).alias("_u"), "_rid", "_g").repartition(tasks, "rep", "_part")
    w = W.partitionBy("rep", "_part").orderBy("_u")
    inside = dealt.select("rep", "_part", "_rid", "_g", (F.row_number().over(w) - 1).alias("_at"), F.lag("_g").over(w).alias("_prev"))
    # Sums of products in two halves, which do not overflow.
    term = F.col("_rid") * F.col("_at")
    per = inside.groupBy("rep", "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_rid").alias("_rids"), F.sum(F.shiftright(term, 32)).alias("_high"), F.sum(term % 2**32).alias("_low"),
        F.count_if(F.col("_prev") == F.col("_g")).alias("_same"), F.max(F.when(F.col("_at") == 0, F.col("_g"))).alias("_first"), F.max(F.struct("_at", "_g"))["_g"].alias("_last"))
    along = W.partitionBy("rep").orderBy("_part")
    per = checkpoint(per).select("*", F.coalesce(F.sum("_n").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lag("_last").over(along).alias("_end"))
    dec = lambda c: F.col(c).cast("decimal(38,0)")
    dot = dec("_rids") * dec("_before") + dec("_high") * F.lit(2**32).cast("decimal(38,0)") + dec("_low")
    return per.groupBy("rep").agg(F.sum("_n").alias("n"), F.sum(dot).alias("dot"), (F.sum("_same") + F.count_if(F.col("_end") == F.col("_first"))).alias("n_adjacent"))


def order_statistics(codes: DataFrame, key: str, code: str, group: str, *, n_perm: int = N_PERM, seed: str = "audit", limit: int = GROUP_LIMIT) -> DataFrame:
    """Is the code order the id order, and does it keep groups together?

    One row with Spearman's rho and the adjacent-same-group count, each with its
    permutation p-values. Replicate ``r`` orders the ids by a hash keyed with ``r``; both
    statistics come from the same replicates. The work is ids times ``n_perm``; too few to
    reach ``LEAK_P`` are refused.
    """
    if 1 / (n_perm + 1) > LEAK_P:
        raise ValueError(f"{n_perm} permutations cannot give a p-value of {LEAK_P}")
    d = codes.select(F.col(key).alias("_id"), F.col(code).alias("_code"), F.col(group).alias("_g"), F.col(key).cast("double").alias("_x"), text_number(F.col(code)).alias("_c"))
    placed = ordered(d, [], "_x", {"_rid": ("sum", F.lit(1), "before")}, limit=limit)
    placed = ordered(placed, [], "_c", {"_rcode": ("sum", F.lit(1), "before")}, ties=["_code"], limit=limit)
    placed = checkpoint(placed)
    n = F.col("n").cast("double")
    norm = n * (n * n - 1) / 12.0
    dec = lambda c: c.cast("decimal(38,0)")
    centred = F.try_divide(F.col("dot").cast("double") - n * ((n - 1) / 2.0) * ((n - 1) / 2.0), norm)
    seen = placed.agg(F.count(F.lit(1)).alias("n"), F.sum(dec(F.col("_rid")) * dec(F.col("_rcode"))).alias("dot")).withColumn("rho", centred).withColumn("k", F.lit(1))
    adj = adjacent_equal(placed, "_rcode", "_g", limit=limit).select("n_adjacent").withColumn("k", F.lit(1))
    null = _shuffled_orders(placed, n_perm, seed, limit)
    null = null.select("rep", centred.alias("rho_r"), F.col("n_adjacent").alias("adj_r")).withColumn("k", F.lit(1)).join(seen, "k").join(adj.select("n_adjacent", "k"), "k")
    p = lambda cond: (1 + F.count_if(cond)) / (n_perm + 1.0)
    return null.groupBy("n", "rho", "n_adjacent").agg(
        p(F.abs("rho_r") >= F.abs("rho") - 1e-12).alias("p_rho"), F.avg("adj_r").alias("adjacent_null_mean"),
        p(F.col("adj_r") >= F.col("n_adjacent")).alias("p_upper"), p(F.col("adj_r") <= F.col("n_adjacent")).alias("p_lower"))


def audit_order(stats: DataFrame) -> DataFrame:
    """Verdicts on the code order from ``order_statistics``."""
    rho = stats.where("n >= 5").select(
        F.when((F.abs("rho") >= MAX_RHO) | (F.col("p_rho") <= LEAK_P), "LEAK").when(F.col("p_rho") <= RISK_P, "RISK").alias("severity"),
        F.lit("code_order").alias("check"), F.lit("code").alias("column"), F.round("rho", 4).cast("string").alias("detail"))
    adj = stats.where("n >= 5").select(
        F.when(F.col("p_upper") <= LEAK_P, "LEAK").when(F.col("p_lower") <= LEAK_P, "RISK").alias("severity"),
        F.lit("adjacency").alias("check"), F.lit("code").alias("column"), F.col("n_adjacent").cast("string").alias("detail"))
    return rho.unionByName(adj).where(F.col("severity").isNotNull())


def audit_row_order(rows: DataFrame, order: str, key: str) -> DataFrame:
    """Written row order against the id: a table needs an explicit order column."""
    s = spearman(rows, order, key)
    return s.where(F.abs("rho") >= MAX_RHO).select(*_finding("LEAK", "row_order", order, F.round("rho", 4)))


def column_signatures(blinded: DataFrame, entity: str, limit: int = GROUP_LIMIT) -> DataFrame:
    """``column, entity, signature, number``: the set of values an entity has in each column, as its place in the order of all sets.

    Sets are ordered as if each were spelled out, its values sorted and joined by a bar; equal sets have equal
    places. No set is ever gathered: its values get numbers in order, then neighbours pair up and the pairs
    get numbers in order, until one number a set is left, after as many rounds as the longest set has binary
    digits. ``number`` is the value of a set that is one number.
    """
    cols = [c for c in blinded.columns if c != entity]
    cell = lambda c: F.struct(F.lit(c).alias("column"), F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias("v"))
    each = checkpoint(blinded.select(F.col(entity).alias("entity"), F.inline(F.array(*[cell(c) for c in cols]))).distinct())
    one = ("sum", F.lit(1), "before")
    each = checkpoint(ordered(each, ["column", "entity"], "v", {"at": one, "size": ("sum", F.lit(1), "all")}, limit=limit))
    numbers = each.where("at = 0").select("column", "entity", F.when(F.col("size") == 1, F.col("v").try_cast("double")).alias("number"))
    level = each.select("column", "entity", "at", F.when(F.col("at") + 1 < F.col("size"), F.concat("v", F.lit("|"))).otherwise(F.col("v")).alias("a"), F.lit(0).cast("bigint").alias("b"))
    longest = each.agg(F.max("size")).first()[0] or 0
    while True:
        places = ordered(level.select("column", "a", "b").distinct(), ["column"], "a", {"place": one}, ties=["b"], limit=limit)
        level = checkpoint(level.join(places, ["column", "a", "b"]).select("column", "entity", "at", (F.col("place") + 1).alias("place")))
        if longest <= 1:
            return attach(level.select("column", "entity", F.col("place").alias("signature")), numbers, ["column", "entity"])
        half = lambda k: F.max(F.when(F.col("at") % 2 == k, F.col("place")))
        level = level.groupBy("column", "entity", F.floor(F.col("at") / 2).alias("at")).agg(half(0).alias("a"), F.coalesce(half(1), F.lit(0).cast("bigint")).alias("b"))
        longest = (longest + 1) // 2


def column_statistics(blinded: DataFrame, codes: DataFrame, key: str, group: str, *, code: str = "code", limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per column: cells, purity against the true groups, rank correlation with
    the id, and entities whose value almost nobody shares."""
    # Everything below reads the signatures several times, so they are computed once.
    sig = checkpoint(column_signatures(blinded, code, limit).join(
        codes.select(F.col(code).alias("entity"), F.col(key).cast("double").alias("_id"), F.col(group).alias("_g")), "entity"))
    cells = sig.groupBy("column", "signature", "_g").agg(F.count(F.lit(1)).alias("c")).groupBy("column", "signature").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("groups"))
    per = cells.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_cells"), F.sum("n").alias("n_entities"), (F.max("groups") == 1).alias("pure"),
        F.count_if(F.col("n") <= RARE).alias("n_rare"))
    ngroups = sig.select("column", "_g").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_groups"))
    kind = sig.select("column", "number").distinct().groupBy("column").agg(F.bool_and(F.col("number").isNotNull()).alias("numeric"), F.count("number").alias("n_numbers"))
    d = attach(sig, kind, ["column"]).withColumn("_v", F.when(F.col("numeric"), F.col("number")).otherwise(F.col("signature").cast("double")))
    ranks = mid_ranks(d, ["column"], "_v", limit=limit).select("column", "_v", F.col("mid_rank").alias("_rank"))
    ranked = checkpoint(attach(d, ranks, ["column", "_v"]).select("column", "_id", "_rank"))
    rho = spearman(ranked, "_id", "_rank", ["column"], limit=limit).select("column", "rho")
    out = attach(attach(attach(per, ngroups, ["column"]), kind, ["column"]), rho, ["column"])
    distinct = F.when(F.col("numeric"), F.col("n_numbers")).otherwise(F.col("n_cells"))
    return out.select("column", "n_cells", "n_entities", "n_groups", "pure", "n_rare", F.when(distinct >= 3, F.col("rho")).alias("rho"))


def audit_columns(stats: DataFrame) -> DataFrame:
    """Verdict on every column that is not constant; the first matching test counts."""
    c = F.col
    check = (
        F.when((c("n_cells") == c("n_entities")) & (c("n_entities") >= 3), "one_to_one")
        .when(c("pure") & (c("n_cells") == c("n_groups")), "recovers_groups")
        .when(c("pure") & (c("n_cells") < c("n_entities")), "group_pure")
        .when(F.abs("rho") >= COLUMN_RHO, "monotone_in_id")
        .when((c("n_rare") > 0) & (c("n_entities") >= 8), "rare_values"))
    return stats.where("n_cells > 1").select(
        F.when(check == "rare_values", "RISK").otherwise("LEAK").alias("severity"), check.alias("check"), "column",
        F.when(check == "rare_values", c("n_rare")).otherwise(c("n_cells")).cast("string").alias("detail")).where(c("check").isNotNull())


def audit_duplicates(blinded: DataFrame, code: str = "code", label: str = "section_label") -> DataFrame:
    """Entities with several rows for one section: the sign of a repeat scan."""
    n = blinded.groupBy(code, label).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(code).distinct().agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    how = "duplicates" if "replicate" in blinded.columns else "duplicates_unaddressable"
    return n.select(*_finding("RISK", F.when(F.col("n") <= RARE, f"{how}_few").otherwise(how), label, F.col("n")))


def joint_statistics(blinded: DataFrame, code: str = "code") -> DataFrame:
    """Cells and singled-out entities of all blinded columns taken together."""
    cols = [c for c in blinded.columns if c != code]
    text = F.concat_ws("|", *[F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in cols])
    cells = set_digest(blinded, [code], text).groupBy("n_items", "digest").agg(F.count(F.lit(1)).alias("n"))
    return cells.agg(F.sum("n").alias("n_entities"), F.count(F.lit(1)).alias("n_cells"), F.coalesce(F.sum(F.when(F.col("n") <= RARE, F.col("n"))), F.lit(0)).alias("n_singled"))


def audit_joint(stats: DataFrame) -> DataFrame:
    unique = (F.col("n_cells") == F.col("n_entities")) & (F.col("n_entities") >= 3)
    return stats.where(unique | (F.col("n_singled") > 0)).select(
        *_finding(F.when(unique, "LEAK").otherwise("RISK"), F.when(unique, "joint_fingerprint").otherwise("joint_narrowing"), "*", F.col("n_singled")))


def audit_codes(codes: DataFrame, key: str, code: str, roster: DataFrame, *, limit: int = GROUP_LIMIT) -> DataFrame:
    """Key-file audit: format, duplicates, wrong direction, roster, and code tails."""
    k, c = F.col(key).cast("string"), F.trim(F.col(code))
    number = F.trim(k).try_cast("bigint")
    d = codes.select(k.alias("k"), c.alias("c"), number.alias("id"), F.regexp_replace(c, r"\D", "").try_cast("decimal(38,0)").alias("tail"))
    row = lambda sev, check, v: F.struct(F.lit(sev).alias("severity"), F.lit(check).alias("check"), v.alias("value"))
    per_row = d.select(F.inline(F.filter(F.array(
        F.when(F.col("id").isNull(), row("LEAK", "key_not_an_id", F.col("k"))),
        F.when(~F.col("c").rlike(CODE_PATTERN), row("LEAK", "code_format", F.col("c"))),
        F.when(F.col("c").contains(F.col("id").cast("string")), row("RISK", "code_contains_id", F.col("c"))),
    ), lambda x: x.isNotNull())))
    twice = d.groupBy("c").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("LEAK").alias("severity"), F.lit("duplicate_code").alias("check"), F.col("c").alias("value"))
    known = roster.select(F.col(key).cast("bigint").alias("id")).distinct()
    outside = d.where(F.col("id").isNotNull()).join(known, "id", "left_anti").select(F.lit("RISK").alias("severity"), F.lit("outside_roster").alias("check"), F.col("k").alias("value"))
    counts = per_row.unionByName(twice).unionByName(outside).groupBy("severity", "check").agg(F.count(F.lit(1)).alias("n"))
    step = ordered(d.where(F.col("id").isNotNull()), [], "id", {"_p": ("max", F.struct("id", "tail"), "before")}, limit=limit)
    diff = F.col("tail") - F.col("_p")["tail"]
    tails = step.agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("tail").isNotNull()).alias("all"),
        F.coalesce(F.bool_and(F.when(F.col("_p").isNotNull(), F.coalesce(diff > 0, F.lit(False)))), F.lit(True)).alias("up"),
        F.coalesce(F.bool_and(F.when(F.col("_p").isNotNull(), F.coalesce(diff < 0, F.lit(False)))), F.lit(True)).alias("down"),
        F.count_if(F.col("tail") == F.col("id")).alias("same"))
    order = tails.select(F.inline(F.filter(F.array(
        F.when(F.col("all") & (F.col("n") >= 6) & (F.col("up") | F.col("down")), row("LEAK", "tails_monotone", F.col("n"))),
        F.when(F.col("all") & (F.col("same") > 1), row("RISK", "tails_equal_ids", F.col("same"))),
    ), lambda x: x.isNotNull()))).withColumnRenamed("value", "n")
    return counts.unionByName(order).select(*_finding(F.col("severity"), F.col("check"), code, F.col("n")))


def audit_blinded(blinded: DataFrame, codes: DataFrame, key: str, group: str, *, arm: str | None = None, n_perm: int = N_PERM) -> DataFrame:
    """All attacks; leaks first. ``codes``: ``key, code, group`` of every entity."""
    vocabulary = group_vocabulary(codes, [group, *([arm] if arm else [])])
    parts = [
        audit_structure(blinded, codes), audit_ids(blinded, codes, key), audit_terms(blinded, vocabulary),
        audit_order(order_statistics(codes, key, "code", group, n_perm=n_perm)),
        audit_columns(column_statistics(blinded, codes, key, group)), audit_joint(joint_statistics(blinded)),
    ]
    if "section_label" in blinded.columns:
        parts.append(audit_duplicates(blinded))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("severity", "check", "column", "detail")
