"""Region operators: polygons drawn from suppliers and parts, masks from embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import morphology as M
from ..operators import regions as R
from .planes import BY, PX, mask, pixels
from .registry import query, rnd


def _rect(x0, y0, x1, y1):
    pt = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    return F.array(pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0))


def _features(t):
    """Part i: a region named after its type; every second one has a hole of side 2."""
    s, z = F.col("p_size"), F.lit(0)
    name = (F.when(F.col("p_partkey") % 5 == 0, " Hippocampus").when(F.col("p_partkey") % 5 == 1, "isocortes ")
            .when(F.col("p_partkey") % 5 == 2, "").when(F.col("p_partkey") % 5 == 3, "cortex").otherwise("lobe"))
    outer = _rect(z, z, s + 5, s + 3)
    hole = _rect(z + 1, z + 1, z + 3, z + 3)
    return t.part.select(F.floor(F.col("p_partkey") / 5).alias("image"), (F.col("p_partkey") % 5).cast("int").alias("feature_no"), name.alias("raw_name"),
                         F.when(s % 2 == 0, F.array(outer, hole)).otherwise(F.array(outer)).alias("rings"))


FEATURES = """ft AS (SELECT p_partkey // 5 AS image, CAST(p_partkey % 5 AS INTEGER) AS feature_no, ((p_size + 5) * (p_size + 3) - CASE WHEN p_size % 2 = 0 THEN 4 ELSE 0 END) * 160.0::DOUBLE * 160.0::DOUBLE / 1e6 AS area,
  CASE p_partkey % 5 WHEN 0 THEN 'Hippocampus' WHEN 1 THEN 'Isocortex' WHEN 3 THEN 'Isocortex' END AS named, p_partkey % 5 IN (2, 4) AS unnamed FROM part),
rs AS (SELECT ft.image, ft.feature_no, ft.area, CASE WHEN named IS NOT NULL THEN named WHEN ft.feature_no = b.no AND b.a > 10 AND f.ok THEN 'Tissue' END AS region FROM ft
  LEFT JOIN (SELECT image, arg_min(feature_no, (-area, feature_no)) AS no, max(area) AS a FROM ft WHERE unnamed GROUP BY 1) b USING (image)
  LEFT JOIN (SELECT image, bool_or(coalesce(named = 'Hippocampus', false)) AND bool_or(coalesce(named = 'Isocortex', false)) AS ok FROM ft GROUP BY 1) f USING (image))"""


@query("j01_resolve_regions", f"WITH {FEATURES} SELECT image, feature_no, region, round(area, 6) AS area_mm2 FROM rs")
def _resolve(t):
    return R.resolve_regions(_features(t), "image", F.lit(160.0)).select("image", "feature_no", "region", rnd(F.col("area_mm2")).alias("area_mm2"))


#: Parts of a region share a corner, so the largest holds the others; a hole stays if every part has it.
@query("j02_region_areas", f"""WITH {FEATURES}, un AS (SELECT image, region, ((max(p_size) + 5) * (max(p_size) + 3) - CASE WHEN bool_and(p_size % 2 = 0) THEN 4 ELSE 0 END) * 160.0::DOUBLE * 160.0::DOUBLE / 1e6 AS a, count(*) AS n_parts
  FROM rs JOIN part ON p_partkey = image * 5 + feature_no WHERE region IS NOT NULL GROUP BY 1, 2)
SELECT image, region, round(a, 6) AS area_mm2, n_parts, CASE WHEN a < 4 THEN 'degenerate' ELSE '' END AS reason FROM un""")
def _areas(t):
    return R.region_areas(R.resolve_regions(_features(t), "image", F.lit(160.0)), ["image"], 4.0).withColumn("area_mm2", rnd(F.col("area_mm2")))


def _overlapping(t):
    """Two squares of side 10 a supplier, the second moved to the right and down, with a hole of its own."""
    k = F.col("s_suppkey")
    dx, dy = (k % 13).cast("double"), (k % 9).cast("double")
    one = F.array(_rect(F.lit(0), F.lit(0), F.lit(10), F.lit(10)))
    two = F.array(_rect(dx, dy, dx + 10, dy + 10), _rect(dx + 7, dy + 7, dx + 9, dy + 9))
    return t.supplier.select("s_suppkey", F.explode(F.array(one, two)).alias("rings"))


#: A cell is of one kind throughout, so cells count as area and as pixels.
OVERLAP = """px AS (SELECT s_suppkey, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, x < 10 AND y < 10 AS one,
  x - s_suppkey % 13 BETWEEN 0 AND 9 AND y - s_suppkey % 9 BETWEEN 0 AND 9 AND NOT (x - s_suppkey % 13 BETWEEN 7 AND 8 AND y - s_suppkey % 9 BETWEEN 7 AND 8) AS two
  FROM supplier, range(23) a(x), range(19) b(y))"""


@query("j02_union_area", f"WITH {OVERLAP} SELECT s_suppkey, round(count(*), 6)::DOUBLE AS area FROM px WHERE one OR two GROUP BY 1")
def _union_area(t):
    return R.union_area(_overlapping(t), ["s_suppkey"]).select("s_suppkey", rnd(F.col("area")).alias("area"))


@query("j03_union_pixels", f"WITH {OVERLAP} SELECT s_suppkey, x, y FROM px WHERE one OR two")
def _union_pixels(t):
    return M.run_pixels(R.rasterise(_overlapping(t), ["s_suppkey"])).select("s_suppkey", "x", "y")


def _triangles(t):
    """Supplier polygons: a triangle with a triangular hole, corners off the pixel grid."""
    k = F.col("s_suppkey")
    pt = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    a, b = 10 + k % 11, 9 + k % 7
    outer = F.array(pt(F.lit(0.3), F.lit(0.2)), pt(a + 0.4, F.lit(1.1)), pt(F.lit(3.7), b + 0.6))
    hole = F.array(pt(F.lit(3.1), F.lit(2.2)), pt(F.lit(6.3), F.lit(2.9)), pt(F.lit(4.2), F.lit(5.4)))
    return t.supplier.select("s_suppkey", F.array(outer, hole).alias("rings"))


EDGES = """pts AS (SELECT s_suppkey, r, i, CASE r * 10 + i WHEN 0 THEN 0.3 WHEN 1 THEN 10 + s_suppkey % 11 + 0.4 WHEN 2 THEN 3.7 WHEN 10 THEN 3.1 WHEN 11 THEN 6.3 ELSE 4.2 END::DOUBLE AS x,
  CASE r * 10 + i WHEN 0 THEN 0.2 WHEN 1 THEN 1.1 WHEN 2 THEN 9 + s_suppkey % 7 + 0.6 WHEN 10 THEN 2.2 WHEN 11 THEN 2.9 ELSE 5.4 END::DOUBLE AS y FROM supplier, (VALUES (0), (1)) a(r), (VALUES (0), (1), (2)) b(i)),
ed AS (SELECT p.s_suppkey, p.x AS ax, p.y AS ay, q.x AS bx, q.y AS by_ FROM pts p JOIN pts q ON p.s_suppkey = q.s_suppkey AND p.r = q.r AND q.i = (p.i + 1) % 3)"""


@query("j03_rasterise", f"""WITH {EDGES} SELECT s_suppkey, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y FROM ed, range(24) a(x), range(24) b(y)
WHERE (ay > y + 0.5::DOUBLE) <> (by_ > y + 0.5::DOUBLE) AND x + 0.5::DOUBLE < ax + (y + 0.5::DOUBLE - ay) * (bx - ax) / (by_ - ay) GROUP BY ALL HAVING count(*) % 2 = 1""")
def _raster(t):
    return M.run_pixels(R.rasterise(_triangles(t), ["s_suppkey"])).select("s_suppkey", "x", "y")


@query("j04_intersect_mask", f"""WITH {PX}, rg AS (SELECT vec_id, x // 4 AS region, x, y FROM px WHERE value > 0.05::DOUBLE), ts AS (SELECT vec_id, x, y FROM px WHERE value > 0.15::DOUBLE AND y > 3)
SELECT vec_id, region, count(*) AS drawn_px, count(ts.vec_id) AS kept_px, round(count(ts.vec_id) / count(*)::DOUBLE, 6) AS kept_frac, CASE WHEN count(ts.vec_id) = 0 THEN 'does not meet the tissue mask' ELSE '' END AS reason FROM rg LEFT JOIN ts USING (vec_id, x, y) GROUP BY 1, 2""")
def _intersect(t):
    px = pixels(t)
    region = px.where("value > 0.05").withColumn("region", F.floor(F.col("x") / 4).cast("int"))
    return R.intersect_mask(region, px.where("value > 0.15 AND y > 3"), ["vec_id", "region"]).withColumn("kept_frac", rnd(F.col("kept_frac")))


def _pair(t):
    """Two masks per pair: plane 2k is fixed, plane 2k + 1 moves."""
    m = mask(t).select(F.floor(F.col("vec_id") / 2).alias("pair"), (F.col("vec_id") % 2).alias("side"), "x", "y")
    return m.where("side = 0").drop("side"), m.where("side = 1").drop("side")


PAIR = f"{PX}, fx AS (SELECT vec_id // 2 AS pair, x, y FROM px WHERE value > 0 AND vec_id % 2 = 0), mv AS (SELECT vec_id // 2 AS pair, x, y FROM px WHERE value > 0 AND vec_id % 2 = 1)"


@query("j05_dice", f"""WITH {PAIR}, a AS (SELECT pair, count(*) AS n_a FROM fx GROUP BY 1), b AS (SELECT pair, count(*) AS n_b FROM mv GROUP BY 1), c AS (SELECT pair, count(*) AS n FROM fx JOIN mv USING (pair, x, y) GROUP BY 1)
SELECT pair, n_a, n_b, coalesce(n, 0) AS n_both, round(2 * coalesce(n, 0) / (n_a + n_b)::DOUBLE, 6) AS dice FROM a JOIN b USING (pair) LEFT JOIN c USING (pair)""")
def _dice(t):
    return R.dice(*_pair(t), ["pair"]).withColumn("dice", rnd(F.col("dice")))


@query("j05_dice_empty", f"""WITH {PX}, a AS (SELECT vec_id, count(*) FILTER (value > 0.3::DOUBLE) AS n_a, count(*) FILTER (value > 0.35::DOUBLE) AS n_b FROM px GROUP BY 1)
SELECT vec_id, n_a, n_b, n_b AS n_both, round(coalesce(2 * n_b / nullif(n_a + n_b, 0)::DOUBLE, 0), 6) AS dice FROM a""")
def _dice_empty(t):
    px = pixels(t)
    return R.dice(px.where("value > 0.3"), px.where("value > 0.35"), BY, t.embeddings.select("vec_id")).withColumn("dice", rnd(F.col("dice")))


#: The search of the registration: -4 to 4 degrees, any shift.
ANGLES = tuple(k / 4 for k in range(-16, 17))
_BACK = "cos(radians(angle)) * (x - 3.5::DOUBLE) + sin(radians(angle)) * (y - 3.5::DOUBLE)", "cos(radians(angle)) * (y - 3.5::DOUBLE) - sin(radians(angle)) * (x - 3.5::DOUBLE)"
FIT = f"""{PAIR}, gr AS (SELECT angle, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, CAST(floor({_BACK[0]} + 3.5::DOUBLE + 0.5::DOUBLE) AS INTEGER) AS sx, CAST(floor({_BACK[1]} + 3.5::DOUBLE + 0.5::DOUBLE) AS INTEGER) AS sy
  FROM range(-3, 11) a(x), range(-3, 11) b(y), (SELECT k / 4::DOUBLE AS angle FROM range(-16, 17) r(k))),
ro AS (SELECT pair, angle, gr.x, gr.y FROM gr JOIN mv ON mv.x = sx AND mv.y = sy),
nm AS (SELECT pair, angle, count(*) AS nm FROM ro GROUP BY 1, 2), nf AS (SELECT pair, count(*) AS nf FROM fx GROUP BY 1),
ht AS (SELECT ro.pair, angle, fx.y - ro.y AS dy, fx.x - ro.x AS dx, count(*) AS k FROM ro JOIN fx ON fx.pair = ro.pair GROUP BY ALL),
sc AS (SELECT *, round(2 * k / (nm + nf)::DOUBLE, 9) AS d FROM ht JOIN nm USING (pair, angle) JOIN nf USING (pair)),
bs AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY d DESC, abs(angle) + abs(dy) + abs(dx), angle, dy, dx) AS rn FROM sc),
b4 AS (SELECT pair, round(2 * count(*) FILTER (a AND b) / (count(*) FILTER (a) + count(*) FILTER (b))::DOUBLE, 9) AS d0 FROM (SELECT coalesce(fx.pair, mv.pair) AS pair, fx.pair IS NOT NULL AS a, mv.pair IS NOT NULL AS b FROM fx FULL JOIN mv ON fx.pair = mv.pair AND fx.x = mv.x AND fx.y = mv.y) GROUP BY 1),
ft AS (SELECT pair, angle AS angle_deg, CAST(dy AS INTEGER) AS dy, CAST(dx AS INTEGER) AS dx, d AS dice_after, d0 AS dice_before, d > d0 AS accepted FROM bs JOIN b4 USING (pair) WHERE rn = 1)"""


def _fit(t):
    return R.rigid_fit(*_pair(t), ["pair"], ANGLES, None, 3.5, 3.5)


@query("j06_rigid_fit", f"WITH {FIT} SELECT pair, angle_deg + 0.0::DOUBLE AS angle_deg, dy, dx, round(dice_after, 6) AS dice_after, round(dice_before, 6) AS dice_before, accepted FROM ft")
def _rigid(t):
    return _fit(t).withColumns({"dice_after": rnd(F.col("dice_after")), "dice_before": rnd(F.col("dice_before"))})


@query("j07_inverse_transform", f"""WITH {FIT} SELECT fx.pair, x AS px, y AS py, round(cos(radians(-angle_deg)) * (x - dx - 3.5::DOUBLE) - sin(radians(-angle_deg)) * (y - dy - 3.5::DOUBLE) + 3.5::DOUBLE, 6) + 0.0::DOUBLE AS x,
  round(sin(radians(-angle_deg)) * (x - dx - 3.5::DOUBLE) + cos(radians(-angle_deg)) * (y - dy - 3.5::DOUBLE) + 3.5::DOUBLE, 6) + 0.0::DOUBLE AS y FROM fx JOIN ft USING (pair)""")
def _inverse(t):
    points = _pair(t)[0].withColumns({"px": F.col("x"), "py": F.col("y")})
    d = R.inverse_transform(points, _fit(t), ["pair"], 3.5, 3.5)
    return d.select("pair", "px", "py", rnd(F.col("x")).alias("x"), rnd(F.col("y")).alias("y"))
