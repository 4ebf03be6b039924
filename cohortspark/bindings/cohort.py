"""Cohort statistics, splits and the trained classifier on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify as C
from ..operators import planes as P
from ..operators import stats as S
from ..session import checkpoint
from .planes import pixels
from .registry import query, rnd


@query("k01_log_log_correlation", "SELECT o_orderpriority, count(*) AS n, round(corr(ln(o_totalprice), ln(o_custkey)), 6) AS r FROM orders WHERE o_orderstatus = 'F' AND o_custkey > 0 AND o_totalprice > 0 GROUP BY 1")
def _loglog(t):
    return S.log_log_correlation(t.orders, "o_totalprice", "o_custkey", ["o_orderpriority"], F.col("o_orderstatus") == "F").withColumn("r", rnd(F.col("r")))


@query("k02_class_separation", """WITH v AS (SELECT lang, n_chars AS v, quality = 1 AS p FROM labels JOIN documents USING (doc_id)),
r AS (SELECT *, rank() OVER (PARTITION BY lang ORDER BY v) + (count(*) OVER (PARTITION BY lang, v) - 1) / 2.0::DOUBLE AS mr, min(v) FILTER (p) OVER (PARTITION BY lang) AS lo, max(v) FILTER (NOT p) OVER (PARTITION BY lang) AS hi FROM v)
SELECT lang, count(*) FILTER (p) AS n_positive, count(*) FILTER (NOT p) AS n_negative, any_value(lo) AS positive_min, any_value(hi) AS negative_max, any_value(lo > hi) AS separated,
  round((sum(mr) FILTER (p) - count(*) FILTER (p) * (count(*) FILTER (p) + 1) / 2.0::DOUBLE) / nullif(count(*) FILTER (p) * count(*) FILTER (NOT p), 0), 6) AS auc,
  CAST(count(*) FILTER (p AND v < hi) + count(*) FILTER (NOT p AND v > lo) AS BIGINT) AS n_overlapping FROM r GROUP BY 1""")
def _auc(t):
    d = t.labels.join(t.documents, "doc_id")
    return S.class_separation(d, "n_chars", F.col("quality") == 1, ["lang"]).withColumn("auc", rnd(F.col("auc")))


@query("k03_variance_components", """WITH g AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS m, coalesce(var_samp(o_totalprice), 0) AS s2 FROM orders GROUP BY 1),
t AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * n)::DOUBLE AS nn, sum(n * m) AS s, sum((n - 1) * s2) AS ssw FROM g),
a AS (SELECT t.*, (SELECT sum(g.n * (g.m - t.s / t.n) ** 2) FROM g) / (k - 1) AS msb, ssw / (n - k) AS msw, (n - nn / n) / (k - 1) AS n0 FROM t)
SELECT k AS n_entities, n AS n_rows, round(greatest((msb - msw) / n0, 0) / 1e6, 2) + 0.0::DOUBLE AS between_m, round(msw / 1e6, 2) AS within_m, round(greatest((msb - msw) / n0, 0) / (greatest((msb - msw) / n0, 0) + msw), 6) AS icc FROM a""")
def _icc(t):
    d = S.variance_components(t.orders, "o_custkey", "o_totalprice")
    return d.select("n_entities", "n_rows", rnd(F.col("between_var") / 1e6, 2).alias("between_m"), rnd(F.col("within_var") / 1e6, 2).alias("within_m"), rnd(F.col("icc")).alias("icc"))


PAIRS = """pr AS (SELECT l_orderkey, l_linenumber, max(l_extendedprice) FILTER (l_linestatus = 'F') AS a, max(l_extendedprice) FILTER (l_linestatus = 'O') AS b,
  max(l_quantity) FILTER (l_linestatus = 'F') AS ba, max(l_quantity) FILTER (l_linestatus = 'O') AS bb, bool_or(l_discount > 0.08::DOUBLE) AS bad FROM lineitem GROUP BY 1, 2),
pa AS (SELECT l_orderkey, l_linenumber, b / a AS ratio, abs(b - a) / ((a + b) / 2) AS diff, CASE WHEN greatest(ba, bb) / least(ba, bb) > 5 THEN 'unmatched' ELSE 'matched' END AS stratum, NOT bad AS clean FROM pr WHERE a IS NOT NULL AND b IS NOT NULL)"""


def _pairs(t):
    return S.repeat_agreement(t.lineitem.withColumn("kind", F.when(F.col("l_linestatus") == "F", "original").otherwise("rescan")), ["l_orderkey", "l_linenumber"],
                              "kind", "l_extendedprice", "l_quantity", bad=F.col("l_discount") > 0.08)


@query("k04_repeat_agreement", f"WITH {PAIRS} SELECT l_orderkey, l_linenumber, round(ratio, 6) AS ratio, round(diff, 6) AS relative_difference, stratum, clean FROM pa")
def _repeat(t):
    return _pairs(t).withColumns({"ratio": rnd(F.col("ratio")), "relative_difference": rnd(F.col("relative_difference"))})


@query("k04_agreement_summary", f"""WITH {PAIRS}, s AS (SELECT 'all' AS pair_set, * FROM pa UNION ALL SELECT 'clean', * FROM pa WHERE clean)
SELECT pair_set, stratum, round(median(ratio), 6) AS median_ratio, round(median(diff), 6) AS median_difference, count(*) AS n_pairs FROM s GROUP BY 1, 2""")
def _summary(t):
    return S.agreement_summary(_pairs(t)).withColumns({c: rnd(F.col(c)) for c in ("median_ratio", "median_difference")})


@query("k06_dim_bright", """WITH m AS (SELECT o_orderpriority, median(o_custkey) AS mid, max(o_totalprice) / min(o_totalprice) AS spread FROM orders GROUP BY 1),
h AS (SELECT o_orderpriority, median(o_totalprice) FILTER (o_custkey <= mid) AS d, median(o_totalprice) FILTER (o_custkey > mid) AS b, any_value(spread) AS spread FROM orders JOIN m USING (o_orderpriority) GROUP BY 1)
SELECT o_orderpriority, round(d, 4) AS dim_median, round(b, 4) AS bright_median, round(spread, 4) AS spread, round(d / b, 6) AS dim_bright_ratio FROM h""")
def _dim(t):
    d = S.dim_bright(t.orders, "o_custkey", "o_totalprice", ["o_orderpriority"])
    return d.withColumns({"dim_median": rnd(F.col("dim_median"), 4), "bright_median": rnd(F.col("bright_median"), 4), "spread": rnd(F.col("spread"), 4), "dim_bright_ratio": rnd(F.col("dim_bright_ratio"))})


@query("l03_stratified_split", """WITH p AS (SELECT c_custkey, c_mktsegment, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('split:' || c_custkey)) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY c_mktsegment) AS place FROM customer)
SELECT c_custkey, c_mktsegment, CASE WHEN place < 0.5::DOUBLE THEN 'development' WHEN place < 0.8::DOUBLE THEN 'validation' ELSE 'reserve' END AS split FROM p""")
def _split(t):
    return C.stratified_split(t.customer, "c_custkey", "c_mktsegment", {"development": 0.5, "validation": 0.3, "reserve": 0.2}, "split")


@query("l04_agreement_metrics", """WITH d AS (SELECT l_returnflag, l_discount - l_tax AS d FROM lineitem) SELECT l_returnflag, count(*) AS n, round(avg(d), 6) AS bias, round(avg(abs(d)), 6) AS mae,
  round(avg(d) - 1.96 * stddev_samp(d), 6) AS limit_low, round(avg(d) + 1.96 * stddev_samp(d), 6) AS limit_high FROM d GROUP BY 1""")
def _agreement(t):
    d = S.agreement_metrics(t.lineitem, "l_discount", "l_tax", ["l_returnflag"])
    return d.withColumns({c: rnd(F.col(c)) for c in ("bias", "mae", "limit_low", "limit_high")})


FEATURES = [f"{kind}_s{s}" for s in (1, 2, 4) for kind in ("gauss", "std", "laplace", "gradient")]


def _samples(t):
    f = P.features(pixels(t), ["vec_id"], "value")
    return f.withColumn("class", F.when(F.col("value") > 0.1, 1).when(F.col("value").isNotNull(), 0))


@query("g04_pooled_samples", "SELECT CAST(vec_id % 2 AS INTEGER) AS sample, count(*) AS n FROM embeddings, range(64) r(i) GROUP BY 1")
def _pooled(t):
    s = pixels(t)
    return C.pool_samples(s.where("vec_id % 2 = 0"), s.where("vec_id % 2 = 1").drop("label")).groupBy("sample").agg(F.count(F.lit(1)).alias("n"))


def _classified(t):
    s = checkpoint(_samples(t))  # training and prediction read the features several times
    train = C.pool_samples(s.where("vec_id % 2 = 0 AND class IS NOT NULL"), s.where("vec_id % 2 <> 0 AND class IS NOT NULL"))
    model = C.train_forest(train, FEATURES, "class", trees=50, depth=5)
    return C.apply_forest(model, s)


@query("i15_trained_classifier")
def _forest(t):
    return _classified(t).groupBy("class", "prediction").agg(F.count(F.lit(1)).alias("n"))

