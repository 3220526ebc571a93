"""Queries on camera models: projections, splines, generic cameras, sampling, and how two models differ."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sightline.functions import cameras as C
from sightline.functions import kernels as K
from sightline.functions import scalars as S
from sightline.operators.quantiles import grouped_quantiles, table_quantile
from sightline.plans.catalog import E4, PIN, n_rows, query, r6, t, vec4
from sightline.plans.more import RASTER, raster

PRISM = {"fx": 400.0, "fy": 410.0, "cx": 320.0, "cy": 240.0, "k1": 0.05, "k2": -0.01, "k3": 0.002, "k4": 0.0005, "p1": 0.001, "p2": -0.002, "sx1": 0.003, "sy1": -0.001}
SPLINE = [0.05 * math.sin(0.7 * k) for k in range(12)]
#: Directions of an 8 x 6 grid, and the origins of its lines.
GRID = [[[(i - 3.5) / 4, (j - 2.5) / 4, 1 + 0.01 * i * j] for i in range(8)] for j in range(6)]
ORIGINS = [[[0.01 * i, 0.02 * j, 0.001 * i * j] for i in range(8)] for j in range(6)]
SIZE = (640, 480)


def _points(spark, sf):
    return vec4(spark, sf).select("vec_id", F.col("a").alias("x"), F.col("b").alias("y"), (0.4 + F.abs("c")).alias("z"))


_P = f"{E4}, q AS (SELECT vec_id, a AS x, b AS y, 0.4 + abs(c) AS z FROM e)"
_SHIFT_X = "(2 * {p1} * {u} * {v} + {p2} * ({u} * {u} + {v} * {v} + 2 * {u} * {u}) + {sx1} * ({u} * {u} + {v} * {v}))"
_SHIFT_Y = "(2 * {p2} * {u} * {v} + {p1} * ({u} * {u} + {v} * {v} + 2 * {v} * {v}) + {sy1} * ({u} * {u} + {v} * {v}))"


def _shifts(u: str, v: str) -> tuple[str, str]:
    return _SHIFT_X.format(u=u, v=v, **PRISM), _SHIFT_Y.format(u=u, v=v, **PRISM)


@query(f"""WITH {_P}, u AS (SELECT vec_id, x / z AS u, y / z AS v, sqrt(x * x + y * y) / z AS r FROM q), f AS (SELECT vec_id, u * atan(r) / r AS u, v * atan(r) / r AS v, atan(r) AS th FROM u),
d AS (SELECT *, 0.05 * pow(th, 2) - 0.01 * pow(th, 4) + 0.002 * pow(th, 6) + 0.0005 * pow(th, 8) AS k FROM f) SELECT vec_id, round(400 * (u * (1 + k) + {_shifts('u', 'v')[0]}) + 320, 5) AS px, round(410 * (v * (1 + k) + {_shifts('u', 'v')[1]}) + 240, 5) AS py FROM d""")
def thin_prism_project(spark, sf):
    p = _points(spark, sf)
    px, py = C.project_thin_prism(F.col("x"), F.col("y"), F.col("z"), PRISM)
    return p.select("vec_id", F.round(px, 5).alias("px"), F.round(py, 5).alias("py"))


@query(f"WITH {_P} SELECT vec_id, round(x / sqrt(x * x + y * y + z * z), 6) AS dx, round(y / sqrt(x * x + y * y + z * z), 6) AS dy, round(z / sqrt(x * x + y * y + z * z), 6) AS dz FROM q")
def fisheye_unproject(spark, sf):
    """Pixels of projected points look along the points."""
    model = {**PIN, "k1": 0.02, "k2": -0.003, "k3": 0.0004, "k4": 0.00001}
    px, py = S.project_equidistant(F.col("x"), F.col("y"), F.col("z"), model)
    p = _points(spark, sf).select("vec_id", px.alias("px"), py.alias("py"))
    d = C.unproject_equidistant(F.col("px"), F.col("py"), model)
    return p.select("vec_id", *(r6(c, f"d{k}") for c, k in zip(d, "xyz", strict=True)))


_TS = ("pow(1 - t, 3) / 6", "(3 * pow(t, 3) - 6 * t * t + 4) / 6", "(-3 * pow(t, 3) + 3 * t * t + 3 * t + 1) / 6", "pow(t, 3) / 6")
_VALUES = "[" + ", ".join(f"{v!r}::DOUBLE" for v in SPLINE) + "]"


@query(f"""WITH {_P}, g AS (SELECT *, 1 + 9 / (pi() / 2) * acos(z / sqrt(x * x + y * y + z * z)) AS pos FROM q), c AS (SELECT *, CAST(greatest(1, least(9, floor(pos))) AS INT) AS k, pos - greatest(1, least(9, floor(pos))) AS t, {_VALUES} AS s, x / z AS u, y / z AS v FROM g),
f AS (SELECT *, {' + '.join(f'{w} * s[k + {n}]' for n, w in enumerate(_TS))} AS fac FROM c) SELECT vec_id, round(fac, 6) AS factor, round(400 * (u * (1 + fac) + {_shifts('u', 'v')[0]}) + 320, 5) AS px, round(410 * (v * (1 + fac) + {_shifts('u', 'v')[1]}) + 240, 5) AS py FROM f""")
def radial_spline_project(spark, sf):
    p = _points(spark, sf)
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    px, py = C.project_radial_spline(x, y, z, PRISM, SPLINE)
    angle = F.acos(z / F.sqrt(x * x + y * y + z * z))
    return p.select("vec_id", r6(C.spline(SPLINE, 1 + (len(SPLINE) - 3) / (F.pi() / 2) * angle), "factor"), F.round(px, 5).alias("px"), F.round(py, 5).alias("py"))


def _cells(grid: list) -> str:
    return ", ".join(f"({i}, {j}, {', '.join(f'{float(v)!r}::DOUBLE' for v in cell)})" for j, row in enumerate(grid) for i, cell in enumerate(row))



@query(f"""WITH px AS (SELECT p_partkey, CAST(p_partkey % 640 AS DOUBLE) AS x, CAST(p_size * 9 % 480 AS DOUBLE) AS y FROM part), g(i, j, a, b, c) AS (VALUES {_cells(GRID)}), o(i, j, a, b, c) AS (VALUES {_cells(ORIGINS)}),
k AS (SELECT p_partkey, 1 + x / 640 * 5 AS gx, 1 + y / 480 * 3 AS gy FROM px), b AS (SELECT p_partkey, CAST(least(5, floor(gx)) AS INT) AS ix, CAST(least(3, floor(gy)) AS INT) AS iy, gx - least(5, floor(gx)) AS tx, gy - least(3, floor(gy)) AS ty FROM k),
w AS (SELECT p_partkey, ix - 1 + m.n AS i, iy - 1 + q.n AS j, CASE m.n WHEN 0 THEN pow(1 - tx, 3) / 6 WHEN 1 THEN (3 * pow(tx, 3) - 6 * tx * tx + 4) / 6 WHEN 2 THEN (-3 * pow(tx, 3) + 3 * tx * tx + 3 * tx + 1) / 6 ELSE pow(tx, 3) / 6 END * CASE q.n WHEN 0 THEN pow(1 - ty, 3) / 6 WHEN 1 THEN (3 * pow(ty, 3) - 6 * ty * ty + 4) / 6 WHEN 2 THEN (-3 * pow(ty, 3) + 3 * ty * ty + 3 * ty + 1) / 6 ELSE pow(ty, 3) / 6 END AS w FROM b, range(4) m(n), range(4) q(n)),
s AS (SELECT p_partkey, sum(w * g.a) AS a, sum(w * g.b) AS b, sum(w * g.c) AS c, sum(w * o.a) AS oa, sum(w * o.b) AS ob, sum(w * o.c) AS oc FROM w JOIN g USING (i, j) JOIN o USING (i, j) GROUP BY p_partkey)
SELECT p_partkey, round(a / sqrt(a * a + b * b + c * c), 6) AS dx, round(b / sqrt(a * a + b * b + c * c), 6) AS dy, round(c / sqrt(a * a + b * b + c * c), 6) AS dz, round(oa, 12) AS ox, round(ob, 12) AS oy, round(oc, 12) AS oz FROM s""")
def generic_unproject(spark, sf):
    """Directions of a central and lines of a non-central generic camera, from grids of control values."""
    p = t(spark, sf, "part")
    x, y = (F.col("p_partkey") % 640).cast("double"), (F.col("p_size") * 9 % 480).cast("double")
    at = p.select("p_partkey", *(c.alias(n) for n, c in zip(("gx", "gy"), C.grid_place(x, y, GRID, SIZE), strict=True)))
    raw = at.select("p_partkey", *(c.alias(f"{n}{k}") for n, g in (("d", GRID), ("o", ORIGINS)) for k, c in zip("xyz", C.surface(g, F.col("gx"), F.col("gy")), strict=True)))
    d = C.P.unit(tuple(F.col(f"d{k}") for k in "xyz"))
    return raw.select("p_partkey", *(r6(c, f"d{k}") for c, k in zip(d, "xyz", strict=True)), *(F.round(f"o{k}", 12).alias(f"o{k}") for k in "xyz"))


@query("SELECT s_suppkey, round(degrees(2 * atan(320.0 / (200 + s_suppkey))), 5) AS horizontal, round(degrees(2 * atan(240.0 / (200 + s_suppkey))), 5) AS vertical FROM supplier")
def fields_of_view(spark, sf):
    """Of pinhole cameras of growing focal length: the angle between the directions of opposite borders."""
    f = (200 + F.col("s_suppkey")).cast("double")
    unit = lambda u, v: C.P.unit((u / f, v / f, F.lit(1.0)))
    o, w, h = F.lit(0.0), F.lit(320.0), F.lit(240.0)
    return t(spark, sf, "supplier").select("s_suppkey", F.round(C.field_of_view(unit(-w, o), unit(w, o)), 5).alias("horizontal"), F.round(C.field_of_view(unit(o, -h), unit(o, h)), 5).alias("vertical"))


@query(f"WITH {E4} SELECT vec_id, round(abs((b - a) * (d - a) - (c - a) * (d * 2 - a)) / 2, 6) AS area, round(CASE WHEN a + b <> 0 THEN a * (b + c) / (a + b) END, 6) AS cross_x, round(CASE WHEN a + b <> 0 THEN (b + c) - a * 0 + b * 0 - (b + c) * a / (a + b) END, 6) AS cross_y FROM e")
def plane_geometry(spark, sf):
    """Triangle areas, and where two lines of each row meet."""
    a, b, c, d = (F.col(k) for k in "abcd")
    area = C.triangle_area((a, a), (b, c), (d * 2, d))
    # the line through (0, 0) and (a, b), and that through (0, b + c) and (1, b + c - 1)
    x, y = C.line_crossing((F.lit(0.0), F.lit(0.0)), (a, b), (F.lit(0.0), b + c), (F.lit(1.0), b + c - 1))
    return vec4(spark, sf).select("vec_id", r6(area, "area"), r6(x, "cross_x"), r6(y, "cross_y"))


@query(f"""WITH {RASTER}, k AS (SELECT p_partkey, 1 + p_partkey % 97 * 0.5 AS x, p_size % 19 * 0.5 AS y FROM part), f AS (SELECT p_partkey, CAST(floor(x) AS BIGINT) AS x0, CAST(floor(y) AS BIGINT) AS y0, x - floor(x) AS fx, y - floor(y) AS fy FROM k)
SELECT p_partkey, round(CAST((a.v * (1 - fx) + coalesce(b.v, 0) * fx) * (1 - fy) + (coalesce(c.v, 0) * (1 - fx) + coalesce(d.v, 0) * fx) * fy AS DOUBLE), 6) AS sampled FROM f JOIN g a ON a.x = x0 AND a.y = y0 LEFT JOIN g b ON b.x = x0 + 1 AND b.y = y0 LEFT JOIN g c ON c.x = x0 AND c.y = y0 + 1 LEFT JOIN g d ON d.x = x0 + 1 AND d.y = y0 + 1""")
def bilinear_samples(spark, sf):
    """A raster sampled between its pixels: each sample's four pixels come by one join and one aggregation."""
    p = t(spark, sf, "part").select("p_partkey", (1 + F.col("p_partkey") % 97 * 0.5).alias("sx"), (F.col("p_size") % 19 * 0.5).alias("sy"))
    corners = F.inline(F.array(*(F.struct((F.floor("sx") + i).alias("x"), (F.floor("sy") + j).alias("y"), F.lit(2 * j + i).alias("k")) for i in (0, 1) for j in (0, 1))))
    v = p.select("*", corners).join(raster(spark, sf), ["x", "y"]).groupBy("p_partkey", "sx", "sy").agg(*(F.sum(F.when(F.col("k") == k, F.col("v"))).alias(f"v{k}") for k in range(4))).where("v0 IS NOT NULL")
    at = [F.coalesce(F.col(f"v{k}"), F.lit(0)) for k in range(4)]
    return v.select("p_partkey", r6(C.bilinear(*at, F.col("sx") - F.floor("sx"), F.col("sy") - F.floor("sy")), "sampled"))


@query("""WITH g AS (SELECT l_partkey % 21 / 20.0 - 0.5 AS u, l_orderkey % 21 / 20.0 - 0.5 AS v FROM lineitem), r AS (SELECT u * u + v * v AS r2, u, v FROM g), e AS (SELECT sqrt(pow(400 * u * (1 + 0.05 * r2) - 400 * u, 2) + pow(400 * v * (1 + 0.05 * r2) - 400 * v, 2)) AS e FROM r)
SELECT count(*) AS pixels, round(avg(e), 6) AS mean, round(max(e), 6) AS worst, round(median(e), 6) AS middle FROM e""")
def model_difference(spark, sf):
    """How far two models' pixels lie apart over the directions, on a grid, in which lines look."""
    g = t(spark, sf, "lineitem").select((F.col("l_partkey") % 21 / 20.0 - 0.5).alias("u"), (F.col("l_orderkey") % 21 / 20.0 - 0.5).alias("v"), F.lit(1.0).alias("z"))
    a, b = ({"fx": 400.0, "fy": 400.0, "cx": 0.0, "cy": 0.0, "k1": k} for k in (0.05, 0.0))
    (ax, ay), (bx, by) = (S.project(F.col("u"), F.col("v"), F.col("z"), m) for m in (a, b))
    e = g.select(F.hypot(ax - bx, ay - by).alias("e"), F.lit(0).alias("one"))
    q = grouped_quantiles(e, ["one"], {"worst": ("e", 1.0), "middle": ("e", 0.5)})
    mean = e.agg(r6(F.avg("e"), "mean"))
    return q.crossJoin(F.broadcast(mean)).select(F.col("n").alias("pixels"), "mean", r6(F.col("worst"), "worst"), r6(F.col("middle"), "middle"))


@query("""WITH s AS (SELECT k * 0.6180339887498949::DOUBLE - floor(k * 0.6180339887498949::DOUBLE) AS u, k * 0.7548776662466927::DOUBLE - floor(k * 0.7548776662466927::DOUBLE) AS v FROM (SELECT CAST(o_orderkey AS DOUBLE) AS k FROM orders)), e AS (SELECT sqrt(pow(u - 0.5, 2) + pow(v - 0.5, 2)) AS e FROM s), i AS (SELECT e, row_number() OVER (ORDER BY e) AS i FROM e) SELECT count(*) AS trials, round(avg(e), 7) AS mean, round(max(e) FILTER (WHERE i = (SELECT count(*) // 2 + 1 FROM e)), 7) AS upper_median FROM i""")
def accuracy_trials(spark, sf):
    """Mean and upper median error of quasi-random trials, one for each order."""
    k = F.col("o_orderkey").cast("double")
    share = lambda x: k * x - F.floor(k * x)
    e = t(spark, sf, "orders").select(F.hypot(share(0.6180339887498949) - 0.5, share(0.7548776662466927) - 0.5).alias("e"))
    return e.agg(n_rows("trials"), F.round(F.avg("e"), 7).alias("mean")).withColumn("upper_median", F.round(F.lit(table_quantile(e, "e", 0.5, "upper")).cast("double"), 7))


@query("SELECT view AS view_id, 1.2::DOUBLE AS h00, round(CAST(0.1 + 0.01 * view AS DOUBLE), 5) AS h01, 3.0::DOUBLE AS h02, 0.05::DOUBLE AS h20 FROM (SELECT DISTINCT o_custkey % 10 AS view FROM orders)")
def homographies(spark, sf):
    """The homography of each group of point pairs, recovered from points that one maps."""
    n = F.col("view")
    c = t(spark, sf, "orders").select((F.col("o_custkey") % 10).alias("view"), "o_orderkey").select(n, (F.col("o_orderkey") % 7).cast("double").alias("x"), (F.floor(F.col("o_orderkey") / 7) % 5).cast("double").alias("y"))
    w = 0.05 * F.col("x") + 0.02 * F.col("y") + 1
    c = c.withColumns({"u": (1.2 * F.col("x") + (0.1 + 0.01 * n) * F.col("y") + 3) / w, "v": (-0.2 * F.col("x") + 0.9 * F.col("y") - 1) / w})
    h = K.homography(c, "view", ["x", "y"], ["u", "v"])
    return h.select(n.alias("view_id"), *(F.round(F.get("h", F.lit(k)), 5).alias(f"h{k // 3}{k % 3}") for k in (0, 1, 2, 6)))


@query("SELECT view AS view_id, 0.1::DOUBLE AS tx, -0.2::DOUBLE AS ty, round(CAST(4 + view * 0.1 AS DOUBLE), 4) AS tz, true AS small_error FROM (SELECT DISTINCT o_custkey % 10 AS view FROM orders)")
def view_poses(spark, sf):
    """Poses of views from point and pixel pairs, one pair in ten of which is wrong."""
    n, k = F.col("view"), F.col("o_orderkey")
    x, y, z = (k % 7).cast("double") / 4 - 0.7, (F.floor(k / 7) % 5).cast("double") / 4 - 0.5, (F.floor(k / 35) % 3).cast("double") / 3
    c = t(spark, sf, "orders").select((F.col("o_custkey") % 10).alias("view"), "o_orderkey").select(n, k, x.alias("x"), y.alias("y"), z.alias("z"))
    zc = F.col("z") + 4 + n * 0.1
    wrong = F.when(F.floor(k / 25) % 10 == 0, 0.3).otherwise(0.0)
    c = c.withColumns({"u": (F.col("x") + 0.1) / zc + wrong, "v": (F.col("y") - 0.2) / zc})
    out = K.view_pose(c, "view", ["x", "y", "z"], ["u", "v"], least=30)
    return out.select(n.alias("view_id"), *(F.round(F.get("translation", F.lit(i)) + 0.0, 4).alias(f"t{a}") for i, a in enumerate("xyz")), (F.col("median_error") < 1e-6).alias("small_error"))


@query(f"WITH {RASTER} SELECT count(*) AS n, round(min((x - 25) * v / 100.0), 6) AS lx, round(max((y - 5) * v / 100.0), 6) AS hy, round(avg(v + 2.0), 6) AS mz FROM g WHERE v > 0")
def depth_cloud(spark, sf):
    """Points of a depth raster, moved by a pose."""
    g = raster(spark, sf).where("v > 0")
    z = F.col("v").cast("double")
    p = C.P.transform(((F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), (F.lit(0.0), F.lit(0.0), F.lit(2.0))), ((F.col("x") - 25) * z / 100, (F.col("y") - 5) * z / 100, z))
    return g.select(*(c.alias(k) for c, k in zip(p, "abc", strict=True))).agg(n_rows("n"), r6(F.min("a"), "lx"), r6(F.max("b"), "hy"), r6(F.avg("c"), "mz"))


@query("SELECT round(quantile_cont(l_extendedprice, 0.37), 6) AS q FROM lineitem")
def exact_table_quantile(spark, sf):
    """A quantile of a whole table by narrowing ranges."""
    return spark.createDataFrame([(round(table_quantile(t(spark, sf, "lineitem"), "l_extendedprice", 0.37), 6),)], "q double")


@query("SELECT p_partkey, kind, CASE WHEN p_partkey % 11 <> 0 THEN round(CAST(p_partkey % 641 AS DOUBLE), 5) END AS px, CASE WHEN p_partkey % 11 <> 0 THEN round(CAST(p_size * 9 % 481 AS DOUBLE), 5) END AS py, p_partkey % 11 <> 0 AS converged FROM part, (SELECT unnest(['central', 'noncentral']) AS kind)")
def generic_project(spark, sf):
    """Points on the rays of pixels, borders included, find their pixels again; points behind the camera find none."""
    from functools import reduce

    from sightline.operators.generic_cameras import Camera, project_generic

    p = t(spark, sf, "part")
    x, y = (F.col("p_partkey") % 641).cast("double"), (F.col("p_size") * 9 % 481).cast("double")
    at = p.select("p_partkey", *(c.alias(n) for n, c in zip(("gx", "gy"), C.grid_place(x, y, GRID, SIZE), strict=True)))
    raw = at.select("p_partkey", *(c.alias(f"{n}{k}") for n, g in (("d", GRID), ("o", ORIGINS)) for k, c in zip("xyz", C.surface(g, F.col("gx"), F.col("gy")), strict=True)))
    side = F.when(F.col("p_partkey") % 11 == 0, -3.0).otherwise(3.0)
    out = []
    for kind, origins in (("central", None), ("noncentral", ORIGINS)):
        rows = raw.select("p_partkey", F.lit(kind).alias("kind"), *((side * F.col(f"d{k}") + (F.col(f"o{k}") if origins else 0.0)).alias(k) for k in "xyz"))
        out.append(project_generic(rows, ["x", "y", "z"], Camera(GRID, SIZE, origins)))
    both = reduce(lambda a, b: a.unionByName(b), out)
    return both.select("p_partkey", "kind", F.round("px", 5).alias("px"), F.round("py", 5).alias("py"), "converged")


_SIDES = {"ax": 1, "ay": 2, "bx": 3, "by": 4, "aw": 5, "ah": 6, "bw": 7, "bh": 8}
_RECTANGLES = ", ".join(f"abs(CAST(embedding[{k}] AS DOUBLE)) + 0.05 AS {n}" if n[1] in "wh" else f"CAST(embedding[{k}] AS DOUBLE) AS \"{n}\"" for n, k in _SIDES.items())


@query(f"""WITH r AS (SELECT vec_id, {_RECTANGLES} FROM embeddings)
SELECT vec_id, round(greatest(0, least(ax + aw, bx + bw) - greatest(ax, bx)) * greatest(0, least(ay + ah, "by" + bh) - greatest(ay, "by")), 9) AS area FROM r""")
def clipped_polygons(spark, sf):
    """How much of one rectangle lies within another, both turned by an angle of their own and clipped as polygons."""
    from sightline.functions import polygons as G

    e = t(spark, sf, "embeddings")
    v = {n: F.element_at("embedding", k).cast("double") for n, k in _SIDES.items()}
    rows = e.select("vec_id", F.cos(F.col("vec_id")).alias("c"), F.sin(F.col("vec_id")).alias("s"), *((F.abs(x) + 0.05 if n[1] in "wh" else x).alias(n) for n, x in v.items()))
    turned = lambda x, y: F.struct((F.col("c") * x - F.col("s") * y).alias("x"), (F.col("s") * x + F.col("c") * y).alias("y"))
    corners = lambda k, flip: F.array(*[turned(F.col(f"{k}x") + i * F.col(f"{k}w"), F.col(f"{k}y") + j * F.col(f"{k}h")) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1))][:: -1 if flip else 1])
    rows = rows.select("vec_id", corners("a", False).alias("a"), corners("b", True).alias("b"))
    return rows.select("vec_id", F.round(G.polygon_area(G.clip_convex(F.col("a"), F.col("b"))), 9).alias("area"))
