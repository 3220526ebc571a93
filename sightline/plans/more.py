"""Further named queries: sampling, rasters, graphs, geometry kernels, sequences, parsing."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions import kernels as K
from sightline.functions import poses as P
from sightline.functions import scalars as S
from sightline.operators import relational as R
from sightline.plans.catalog import E4, PIN, QUERIES, SQL, n_rows, query, r6, t, vec4

SQL["near_duplicate_fold"] = """
WITH f AS (SELECT user_id, list_reduce(list([value, 0.0, 0.0, 0.0] ORDER BY ts, event_id), lambda a, x: CASE WHEN a[2] >= 40 THEN [a[1], a[2], a[3], a[4] + 1] WHEN abs(x[1] - a[1]) < 20 THEN [a[1], a[2], a[3] + 1, a[4]] ELSE [x[1], a[2] + 1, a[3], a[4]] END, [1e18, 0.0, 0.0, 0.0]) AS s FROM events GROUP BY user_id)
SELECT user_id, CAST(s[2] AS BIGINT) AS selected, CAST(s[3] AS BIGINT) AS near_duplicate, CAST(s[4] AS BIGINT) AS max_selected FROM f"""


@query("SELECT user_id, round(sum(abs(d)), 4) AS length, round(max_by(value, (ts, event_id)) - min_by(value, (ts, event_id)), 4) AS drift FROM (SELECT *, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM events) GROUP BY user_id")
def trajectory_length(spark, sf):
    e = t(spark, sf, "events").withColumn("d", F.col("value") - F.lag("value").over(W.partitionBy("user_id").orderBy("ts", "event_id")))
    at = F.struct("ts", "event_id")
    return e.groupBy("user_id").agg(F.round(F.sum(F.abs("d")), 4).alias("length"), F.round(F.max_by("value", at) - F.min_by("value", at), 4).alias("drift"))


@query("WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, event_id FROM n WHERE i % CAST(ceil(n / 10.0) AS BIGINT) = 0")
def decimate(spark, sf):
    """At most ten rows per user, ceil-stride in order."""
    e = t(spark, sf, "events").select("user_id", "event_id", (F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1).alias("i"), F.count(F.lit(1)).over(W.partitionBy("user_id")).alias("n"))
    return e.where(F.pmod("i", F.ceil(F.col("n") / 10)) == 0).select("user_id", "event_id")


@query("WITH n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events), k AS (SELECT DISTINCT user_id, CAST(floor(k * (n - 1) / 4.0) AS BIGINT) AS i FROM n, range(5) r(k)) SELECT n.user_id, event_id FROM n JOIN k ON n.user_id = k.user_id AND n.i = k.i")
def even_sample(spark, sf):
    """Five evenly spaced rows per user (linspace, truncated)."""
    e = t(spark, sf, "events").select("user_id", "event_id", (F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("bigint").alias("i"), F.count(F.lit(1)).over(W.partitionBy("user_id")).alias("n"))
    marks = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.floor(k * (F.col("n") - 1) / 4))
    return e.where(F.array_contains(marks, F.col("i"))).select("user_id", "event_id")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders ORDER BY md5(concat(o_orderkey, ':7')), o_orderkey LIMIT 100")
def seeded_sample(spark, sf):
    """100 orders by hash order: the same rows in every run, without a sort of the table."""
    return t(spark, sf, "orders").orderBy(F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit(":7")).cast("binary")), "o_orderkey").limit(100)


RASTER = "g AS (SELECT CAST(floor(l_quantity) AS BIGINT) AS x, CAST(round(l_discount * 100) AS BIGINT) AS y, count(*) AS v FROM lineitem GROUP BY ALL)"


def raster(spark, sf):
    return t(spark, sf, "lineitem").groupBy(F.floor("l_quantity").alias("x"), F.round(F.col("l_discount") * 100).cast("bigint").alias("y")).agg(n_rows("v"))


@query(f"WITH {RASTER}, a AS (SELECT x, y, sum(v) OVER (PARTITION BY y ORDER BY x) AS s FROM g) SELECT x, y, CAST(sum(s) OVER (PARTITION BY x ORDER BY y) AS BIGINT) AS integral FROM a")
def integral_image(spark, sf):
    a = raster(spark, sf).withColumn("s", F.sum("v").over(W.partitionBy("y").orderBy("x")))
    return a.select("x", "y", F.sum("s").over(W.partitionBy("x").orderBy("y")).alias("integral"))


@query(f"WITH {RASTER} SELECT x // 2 AS x, y // 2 AS y, round(avg(v), 6) AS mean, round(median(v), 6) AS median FROM g GROUP BY x // 2, y // 2")
def half_scale(spark, sf):
    return raster(spark, sf).groupBy(F.floor(F.col("x") / 2).alias("x"), F.floor(F.col("y") / 2).alias("y")).agg(r6(F.avg("v"), "mean"), r6(F.median("v"), "median"))


@query(f"WITH {RASTER} SELECT count(*) AS n, min(v) AS least, max(v) AS most, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(avg(v) FILTER (WHERE v <> 20), 6) AS mean_excluding FROM g")
def raster_stats(spark, sf):
    return raster(spark, sf).agg(n_rows("n"), F.min("v").alias("least"), F.max("v").alias("most"), r6(F.avg("v"), "mean"), r6(F.median("v"), "median"), r6(F.avg(F.when(F.col("v") != 20, F.col("v"))), "mean_excluding"))


@query(f"WITH {RASTER}, l AS (SELECT g.x, g.y, 4 * g.v - coalesce(a.v, 0) - coalesce(b.v, 0) - coalesce(c.v, 0) - coalesce(d.v, 0) AS l FROM g LEFT JOIN g a ON a.x = g.x - 1 AND a.y = g.y LEFT JOIN g b ON b.x = g.x + 1 AND b.y = g.y LEFT JOIN g c ON c.x = g.x AND c.y = g.y - 1 LEFT JOIN g d ON d.x = g.x AND d.y = g.y + 1) SELECT round(var_pop(l), 6) AS sharpness FROM l")
def laplacian_variance(spark, sf):
    """Each cell sends itself and its value to its four neighbours: one aggregation instead of four joins."""
    cells = F.array(*(F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"), (F.col("v") * w).alias("w"), F.lit(w == 4).alias("own")) for dx, dy, w in ((0, 0, 4), (1, 0, -1), (-1, 0, -1), (0, 1, -1), (0, -1, -1))))
    lap = raster(spark, sf).select(F.inline(cells)).groupBy("x", "y").agg(F.sum("w").alias("l"), F.bool_or("own").alias("own")).where("own")
    return lap.agg(r6(F.var_pop("l"), "sharpness"))


@query(f"WITH {RASTER} SELECT a.x, a.y, count(b.v) AS neighbours, CAST(coalesce(sum(abs(a.v - b.v)), 0) AS BIGINT) AS difference FROM g a LEFT JOIN g b ON (b.x = a.x + 1 AND b.y = a.y) OR (b.x = a.x AND b.y = a.y + 1) GROUP BY ALL")
def grid_neighbours(spark, sf):
    g = raster(spark, sf)
    shifted = g.select(F.inline(F.array(F.struct((F.col("x") - 1).alias("x"), F.col("y").alias("y"), F.col("v").alias("w")), F.struct(F.col("x").alias("x"), (F.col("y") - 1).alias("y"), F.col("v").alias("w")))))
    return g.join(shifted, ["x", "y"], "left").groupBy("x", "y").agg(F.count("w").alias("neighbours"), F.coalesce(F.sum(F.abs(F.col("v") - F.col("w"))), F.lit(0)).alias("difference"))


@query(f"WITH {E4} SELECT x.vec_id AS view_id, y.vec_id AS target_id, CASE WHEN y.c - x.c <= 0 THEN 'behind' WHEN abs((y.a - x.a) / (y.c - x.c)) <= 1 AND abs((y.b - x.b) / (y.c - x.c)) <= 1 THEN 'inside' ELSE 'outside' END AS status FROM e x JOIN e y ON x.label = y.label AND x.vec_id // 50 = y.vec_id // 50 AND x.vec_id <> y.vec_id")
def cross_pair_status(spark, sf):
    """Cameras of a rig seeing each other, all ordered pairs; 50 ids are a rig, so a rig is bounded."""
    e = vec4(spark, sf).withColumn("rig", F.floor(F.col("vec_id") / 50))
    x, y = e.alias("x"), e.alias("y")
    dx, dy, dz = (F.col(f"y.{k}") - F.col(f"x.{k}") for k in "abc")
    status = F.when(dz <= 0, "behind").when((F.abs(dx / dz) <= 1) & (F.abs(dy / dz) <= 1), "inside").otherwise("outside")
    return x.join(y, (F.col("x.label") == F.col("y.label")) & (F.col("x.rig") == F.col("y.rig")) & (F.col("x.vec_id") != F.col("y.vec_id"))).select(F.col("x.vec_id").alias("view_id"), F.col("y.vec_id").alias("target_id"), status.alias("status"))


@query(f"WITH {E4} SELECT label, round(sqrt(avg((a - ma) * (a - ma) + (b - mb) * (b - mb) + (c - mc) * (c - mc))), 6) AS rms FROM e JOIN (SELECT label AS l2, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc FROM e GROUP BY label) ON l2 = label GROUP BY label")
def alignment_rms(spark, sf):
    """Centre RMS in one pass: the mean square minus the squared mean."""
    var = sum((F.var_pop(k) for k in "abc"), F.lit(0.0))
    return vec4(spark, sf).groupBy("label").agg(r6(F.sqrt(var), "rms"))


@query(f"WITH {E4}, w AS (SELECT label, a, b, c, 1.0 / pow(greatest(abs(d), 0.05), 2) AS w FROM e) SELECT label, round(sum(w * a) / sum(w), 6) AS x, round(sum(w * b) / sum(w), 6) AS y, round(sum(w * c) / sum(w), 6) AS z FROM w GROUP BY label")
def weighted_centre(spark, sf):
    w = 1.0 / F.pow(F.greatest(F.abs("d"), F.lit(0.05)), 2)
    return vec4(spark, sf).groupBy("label").agg(*(r6(F.sum(w * F.col(k)) / F.sum(w), n) for k, n in zip("abc", "xyz", strict=True)))


@query(f"WITH {E4}, p AS (SELECT x.label, x.vec_id AS hyp, count(*) AS votes, sum(sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b))) AS cost FROM e x JOIN e y ON x.label = y.label AND sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b)) <= 0.1 GROUP BY ALL) SELECT label, hyp, votes FROM p QUALIFY row_number() OVER (PARTITION BY label ORDER BY votes DESC, round(cost, 9), hyp) = 1")
def vector_consensus(spark, sf):
    """Each vote is a hypothesis; the one with most inliers, then least cost, then the earliest, wins. Grid cells bound the pairs."""
    e = vec4(spark, sf).withColumns({f"g{k}": F.floor(F.col(k) / 0.1) for k in "ab"})
    near = e.withColumn("ha", F.explode(F.array(*(F.col("ga") + d for d in (-1, 0, 1))))).withColumn("hb", F.explode(F.array(*(F.col("gb") + d for d in (-1, 0, 1)))))
    x, y = near.alias("x"), e.alias("y")
    d = F.sqrt((F.col("x.a") - F.col("y.a")) * (F.col("x.a") - F.col("y.a")) + (F.col("x.b") - F.col("y.b")) * (F.col("x.b") - F.col("y.b")))
    pairs = x.join(y, (F.col("x.label") == F.col("y.label")) & (F.col("x.ha") == F.col("y.ga")) & (F.col("x.hb") == F.col("y.gb")) & (d <= 0.1))
    score = pairs.groupBy(F.col("x.label").alias("label"), F.col("x.vec_id").alias("hyp")).agg(n_rows("votes"), F.round(F.sum(d), 9).alias("cost"))
    return score.withColumn("_n", F.row_number().over(W.partitionBy("label").orderBy(F.desc("votes"), "cost", "hyp"))).where("_n = 1").select("label", "hyp", "votes")


def turned(spark, sf):
    """Each vector turns a fixed rotation a little, once either way, so that the group's mean is the fixed one."""
    fixed = (F.lit(0.0), F.lit(0.0), F.lit(math.sin(0.3)), F.lit(math.cos(0.3)))
    small = P.unit((F.col("a") * F.col("way"), F.col("b") * F.col("way"), F.col("c") * F.col("way"), F.lit(1.0)))
    both = vec4(spark, sf).withColumn("way", F.explode(F.array(F.lit(0.4), F.lit(-0.4))))
    return both.select("label", *(c.alias(k) for k, c in zip("abcd", P.multiply(fixed, small), strict=True)))


@query("SELECT label, 0.0::DOUBLE AS qx, 0.0::DOUBLE AS qy, round(sin(0.3), 6) AS qz, round(cos(0.3), 6) AS qw FROM embeddings GROUP BY label")
def rotation_mean(spark, sf):
    m = K.mean_rotation(turned(spark, sf), "label", ["a", "b", "c", "d"])
    return m.select("label", *((F.round(k, 6) + 0.0).alias(k) for k in ("qx", "qy", "qz", "qw")))


@query("SELECT label, round(cos(0.6), 6) AS m00, round(-sin(0.6), 6) AS m01, round(sin(0.6), 6) AS m10, 1.0::DOUBLE AS m22 FROM embeddings GROUP BY label")
def rotation_mean_svd(spark, sf):
    """The mean rotation of each group, as the rotation nearest to the sum of its matrices."""
    m = K.mean_rotation_svd(turned(spark, sf), "label", ["a", "b", "c", "d"])
    return m.select("label", *(F.round(F.get("rotation", F.lit(k)), 6).alias(n) for k, n in ((0, "m00"), (1, "m01"), (3, "m10"), (8, "m22"))))


@query("SELECT label, round(-0.5 / sqrt(1.29), 6) AS nx, round(0.2 / sqrt(1.29), 6) AS ny, round(1 / sqrt(1.29), 6) AS nz FROM embeddings GROUP BY label")
def plane_normals(spark, sf):
    """Normals of points on a plane, with as much noise to one side as to the other."""
    e = vec4(spark, sf).withColumn("side", F.explode(F.array(F.lit(1.0), F.lit(-1.0))))
    off = F.col("side") * 0.01 * F.col("d")
    on = e.select("label", (F.col("a") - 0.5 * off).alias("a"), (F.col("b") + 0.2 * off).alias("b"), (0.5 * F.col("a") - 0.2 * F.col("b") + 1 + off).alias("c"))
    return K.plane_normal(on, "label", ["a", "b", "c"]).select("label", *(r6(F.col(k), k) for k in ("nx", "ny", "nz")))


@query("SELECT label, 2.0::DOUBLE AS scale, 0.0::DOUBLE AS m00, -1.0::DOUBLE AS m01, 1.0::DOUBLE AS m10, 1.0::DOUBLE AS m22, 1.0::DOUBLE AS tx, -3.0::DOUBLE AS ty, 5.0::DOUBLE AS tz FROM embeddings GROUP BY label")
def similarity_alignment(spark, sf):
    """Recovers, per group, the transform between the vectors and a scaled, turned, moved copy."""
    e = vec4(spark, sf)
    u = K.umeyama(e.withColumns({"x": -2 * F.col("b") + 1, "y": 2 * F.col("a") - 3, "z": 2 * F.col("c") + 5}), "label", ["a", "b", "c"], ["x", "y", "z"])
    rotation = (F.round(F.get("rotation", F.lit(k)), 6) + 0.0 for k in (0, 1, 3, 8))
    return u.select("label", r6(F.col("scale"), "scale"), *(c.alias(n) for n, c in zip(("m00", "m01", "m10", "m22"), rotation, strict=True)), *(r6(F.get("translation", F.lit(k)), f"t{n}") for k, n in enumerate("xyz")))


@query(f"WITH {E4}, u AS (SELECT vec_id, a, b, 1 + abs(c) AS z FROM e), q AS (SELECT vec_id, a, b, sqrt(a * a + b * b) AS r, atan2(sqrt(a * a + b * b), z) AS th FROM u) SELECT vec_id, round(500 * (th * (1 + 0.1 * th * th)) / r * a + 320, 6) AS px, round(500 * (th * (1 + 0.1 * th * th)) / r * b + 240, 6) AS py FROM q WHERE r > 0")
def fisheye_project(spark, sf):
    px, py = S.project_equidistant(F.col("a"), F.col("b"), 1 + F.abs("c"), {**PIN, "k1": 0.1, "k2": 0.0})
    return vec4(spark, sf).where("a * a + b * b > 0").select("vec_id", r6(px, "px"), r6(py, "py"))


@query(f"WITH {E4}, s AS (SELECT label, sum(a * a) AS saa, sum(a * b) AS sab, sum(b * b) AS sbb, sum(a * c) AS sac, sum(b * c) AS sbc FROM e GROUP BY label) SELECT label, round((sbb * sac - sab * sbc) / (saa * sbb - sab * sab), 6) AS wa, round((saa * sbc - sab * sac) / (saa * sbb - sab * sab), 6) AS wb FROM s")
def normal_equations(spark, sf):
    """Least squares c ~ wa a + wb b per group: products are summed where the rows are, the 2x2 solve is an expression."""
    m = lambda x, y: F.sum(F.col(x) * F.col(y))
    s = vec4(spark, sf).groupBy("label").agg(m("a", "a").alias("aa"), m("a", "b").alias("ab"), m("b", "b").alias("bb"), m("a", "c").alias("ac"), m("b", "c").alias("bc"))
    det = F.col("aa") * F.col("bb") - F.col("ab") * F.col("ab")
    return s.select("label", r6((F.col("bb") * F.col("ac") - F.col("ab") * F.col("bc")) / det, "wa"), r6((F.col("aa") * F.col("bc") - F.col("ab") * F.col("ac")) / det, "wb"))


@query("WITH g AS (SELECT l_suppkey AS k, regr_slope(l_extendedprice, l_quantity) AS s, quantile_cont(l_extendedprice / l_quantity, 0.5) AS m FROM lineitem GROUP BY ALL), h AS (SELECT k, unnest([1, 2]) AS hyp, unnest([s, m]) AS slope FROM g), r AS (SELECT h.k, hyp, median(abs(l_extendedprice - slope * l_quantity)) AS med FROM h JOIN lineitem ON l_suppkey = h.k GROUP BY ALL) SELECT k AS camera, min_by(hyp, (round(med, 4), hyp)) AS winner FROM r GROUP BY k")
def hypothesis_argmin(spark, sf):
    li = t(spark, sf, "lineitem")
    g = li.groupBy("l_suppkey").agg(F.regr_slope("l_extendedprice", "l_quantity").alias("s"), F.percentile(F.col("l_extendedprice") / F.col("l_quantity"), 0.5).alias("m"))
    h = g.select("l_suppkey", F.posexplode(F.array("s", "m")).alias("pos", "slope"))
    r = h.join(li, "l_suppkey").groupBy("l_suppkey", (F.col("pos") + 1).alias("hyp")).agg(F.median(F.abs(F.col("l_extendedprice") - F.col("slope") * F.col("l_quantity"))).alias("med"))
    return r.groupBy(F.col("l_suppkey").alias("camera")).agg(F.min_by("hyp", F.struct(F.round("med", 4), "hyp")).alias("winner"))


@query("WITH g AS (SELECT value AS v, (k - 20) * 5.0 AS c FROM events, range(41) r(k)) SELECT c AS best FROM g GROUP BY c ORDER BY round(sum(abs(v - c)), 3), c LIMIT 1")
def grid_search(spark, sf):
    """One pass: each row adds its loss to all 41 candidates, partial sums are merged."""
    v = t(spark, sf, "events")
    loss = v.agg(*(F.round(F.sum(F.abs(F.col("value") - (k - 20) * 5.0)), 3).alias(f"k{k}") for k in range(41)))
    best = F.array_min(F.array(*(F.struct(F.col(f"k{k}").alias("loss"), F.lit((k - 20) * 5.0).alias("c")) for k in range(41))))
    return loss.select(best["c"].alias("best"))


@query("SELECT p_partkey, list_sort(list_distinct(flatten([generate_series(p_size % 5, p_size % 5 + 2), [p_size % 7]])))[1] AS first_index, len(list_distinct(flatten([generate_series(p_size % 5, p_size % 5 + 2), [p_size % 7]]))) AS n_indices FROM part")
def range_lists(spark, sf):
    """Parses '0-2,7'-like lists built from part sizes."""
    text = F.concat_ws(",", F.concat_ws("-", (F.col("p_size") % 5).cast("string"), (F.col("p_size") % 5 + 2).cast("string")), (F.col("p_size") % 7).cast("string"))
    idx = S.range_list(text)
    return t(spark, sf, "part").select("p_partkey", F.array_min(idx).alias("first_index"), F.size(idx).cast("bigint").alias("n_indices"))


@query("SELECT s_suppkey, sha256(concat('{\"id\":', s_suppkey, ',\"name\":\"', s_name, '\"}')) AS fingerprint FROM supplier")
def stage_fingerprint(spark, sf):
    return t(spark, sf, "supplier").select("s_suppkey", F.sha2(F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))), 256).alias("fingerprint"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS mean, round(var_samp(value), 4) AS variance, min(value) AS least, max(value) AS most FROM events GROUP BY event_type")
def timers(spark, sf):
    return t(spark, sf, "events").groupBy("event_type").agg(n_rows("n"), F.round(F.sum("value"), 4).alias("total"), r6(F.avg("value"), "mean"), F.round(F.var_samp("value"), 4).alias("variance"), F.min("value").alias("least"), F.max("value").alias("most"))


@query("SELECT c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY try_cast(c_mktsegment AS BIGINT) IS NULL, try_cast(c_mktsegment AS BIGINT), c_mktsegment, c_custkey) AS pos FROM customer")
def numeric_first_rank(spark, sf):
    return t(spark, sf, "customer").select("c_name", F.row_number().over(W.partitionBy("c_nationkey").orderBy(*S.numeric_first("c_mktsegment"), F.col("c_custkey"))).cast("bigint").alias("pos"))


@query("SELECT doc_id, count(*) AS lines, count(*) FILTER (WHERE regexp_matches(l, '\\d')) AS with_digits, max(try_cast(nullif(regexp_extract(l, '(\\d+)', 1), '') AS BIGINT)) AS largest FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) GROUP BY doc_id")
def text_log_scan(spark, sf):
    """Line-wise scan of text logs with a captured number."""
    lines = t(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("l"))
    number = F.nullif(F.regexp_extract("l", r"(\d+)", 1), F.lit("")).try_cast("bigint")
    return lines.groupBy("doc_id").agg(n_rows("lines"), F.count_if(F.regexp_like("l", F.lit(r"\d"))).alias("with_digits"), F.max(number).alias("largest"))


@query("WITH d AS (SELECT vec_id, label, unnest(range(16)) AS tag, unnest(list_transform(range(16), lambda k: embedding[4 * k + 1 : 4 * k + 4])) AS corners FROM embeddings), c AS (SELECT *, tag % 3 <> 2 AS valid, len(list_filter(corners, lambda x: abs(x) < 0.25)) = 4 AS whole FROM d) SELECT vec_id, count(*) FILTER (WHERE valid AND whole) AS tags, count(*) FILTER (WHERE NOT valid) AS invalid_id, count(*) FILTER (WHERE valid AND NOT whole) AS malformed FROM c GROUP BY vec_id")
def explode_detections(spark, sf):
    """Vectors as sixteen detections of four corners; a detection counts whole or not at all, and every loss is accounted."""
    tags = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.struct(k.alias("tag"), F.slice("embedding", k * 4 + 1, 4).alias("corners")))
    d = t(spark, sf, "embeddings").select("vec_id", F.inline(tags))
    valid, whole = F.pmod("tag", F.lit(3)) != 2, F.forall("corners", lambda x: F.abs(x) < 0.25) & (F.size("corners") == 4)
    return d.groupBy("vec_id").agg(F.count_if(valid & whole).alias("tags"), F.count_if(~valid).alias("invalid_id"), F.count_if(valid & ~whole).alias("malformed"))


@query("WITH RECURSIVE e AS (SELECT n_nationkey AS a, (n_nationkey * 7 + 3) % 25 AS b FROM nation), w(n) AS (SELECT 1 UNION SELECT e.b FROM w JOIN e ON e.a = w.n) SELECT n AS node FROM w")
def reachability(spark, sf):
    n = t(spark, sf, "nation").select(F.col("n_nationkey").alias("a"), ((F.col("n_nationkey") * 7 + 3) % 25).alias("b"))
    return R.reachable(n, n.where("a = 1").select(F.col("a").alias("node")))
