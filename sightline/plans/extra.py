"""Further named queries: tiers and statuses, list gates, votes, polygons, undistortion, triangulation, bias."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions import scalars as S
from sightline.plans.catalog import E4, RES, n_rows, query, r6, residuals, t, vec4


@query("SELECT l_suppkey AS camera, CASE WHEN count(*) >= 620 THEN 'strong' WHEN count(*) >= 590 THEN 'usable' WHEN count(*) > 0 THEN 'weak' ELSE 'inactive' END AS tier FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey UNION ALL SELECT s_suppkey, 'inactive' FROM supplier WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey)")
def coverage_tier(spark, sf):
    n = t(spark, sf, "lineitem").groupBy("l_suppkey").agg(n_rows("n"))
    tier = F.when(F.col("n") >= 620, "strong").when(F.col("n") >= 590, "usable").when(F.col("n") > 0, "weak").otherwise("inactive")
    return t(spark, sf, "supplier").join(n, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(F.col("s_suppkey").alias("camera"), tier.alias("tier"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN p_partkey IS NULL THEN 'missing_point' WHEN l_quantity > 49 THEN 'out_of_range' WHEN o_orderkey IS NULL THEN 'missing_pose' WHEN o_orderstatus = 'P' THEN 'unused' WHEN s_suppkey IS NULL THEN 'missing_camera' WHEN s_acctbal < 0 THEN 'behind' ELSE 'ok' END AS status FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey")
def projection_status(spark, sf):
    li = t(spark, sf, "lineitem")
    j = li.join(t(spark, sf, "part"), F.col("p_partkey") == F.col("l_partkey"), "left").join(t(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey"), "left").join(t(spark, sf, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"), "left")
    status = F.when(F.col("p_partkey").isNull(), "missing_point").when(F.col("l_quantity") > 49, "out_of_range").when(F.col("o_orderkey").isNull(), "missing_pose").when(F.col("o_orderstatus") == "P", "unused").when(F.col("s_suppkey").isNull(), "missing_camera").when(F.col("s_acctbal") < 0, "behind").otherwise("ok")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", status.alias("status"))


@query("SELECT n_regionkey AS grp, list_sort(list(n_nationkey)) = list_sort(list(n_nationkey) FILTER (WHERE n_nationkey < 24)) AS equal, max(n_nationkey) - min(n_nationkey) AS spread, CASE WHEN max(n_nationkey) - min(n_nationkey) > 20 THEN 'uneven' ELSE 'aligned' END AS label FROM nation GROUP BY n_regionkey")
def layout_gate(spark, sf):
    """Observed ids against expected ids as sorted lists, and the spread of counts."""
    observed = F.sort_array(F.collect_list("n_nationkey"))
    expected = F.sort_array(F.collect_list(F.when(F.col("n_nationkey") < 24, F.col("n_nationkey"))))
    spread = F.max("n_nationkey") - F.min("n_nationkey")
    return t(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("grp")).agg((observed == expected).alias("equal"), spread.alias("spread"), F.when(spread > 20, "uneven").otherwise("aligned").alias("label"))


@query("WITH v AS (SELECT l_orderkey AS frame, count(*) FILTER (WHERE l_returnflag <> 'R') AS votes, median(l_extendedprice) FILTER (WHERE l_returnflag <> 'R') AS med FROM lineitem GROUP BY ALL) SELECT o_orderkey AS frame, coalesce(votes, 0) AS votes, round(med, 6) AS med, CASE WHEN coalesce(votes, 0) = 0 THEN 'none' WHEN votes = 1 THEN 'single' WHEN votes < 3 THEN 'insufficient' ELSE 'weighted' END AS averaging FROM orders LEFT JOIN v ON frame = o_orderkey")
def frame_votes(spark, sf):
    ok = F.col("l_returnflag") != "R"
    v = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("frame")).agg(F.count_if(ok).alias("votes"), F.median(F.when(ok, F.col("l_extendedprice"))).alias("med"))
    label = F.when(F.coalesce("votes", F.lit(0)) == 0, "none").when(F.col("votes") == 1, "single").when(F.col("votes") < 3, "insufficient").otherwise("weighted")
    return t(spark, sf, "orders").select(F.col("o_orderkey").alias("frame")).join(v, "frame", "left").select("frame", F.coalesce("votes", F.lit(0)).alias("votes"), r6(F.col("med"), "med"), label.alias("averaging"))


@query(f"WITH {RES} SELECT camera, frame, count(*) AS n FROM r GROUP BY ALL HAVING count(*) >= 8")
def regroup_least(spark, sf):
    """Groups below the least size are dropped whole."""
    return residuals(spark, sf).groupBy("camera", "frame").agg(n_rows("n")).where("n >= 8")


@query("WITH p AS (SELECT l_suppkey AS camera, l_returnflag = 'R' AS late, l_extendedprice AS v FROM lineitem) SELECT camera, round(median(v) FILTER (WHERE NOT late), 6) AS before_median, round(median(v) FILTER (WHERE late), 6) AS after_median, round(max(v) FILTER (WHERE late), 6) AS after_max, round(count(*) FILTER (WHERE late AND v < 30000) / count(*) FILTER (WHERE late), 6) AS after_under FROM p GROUP BY camera")
def before_after(spark, sf):
    late, v = F.col("l_returnflag") == "R", F.col("l_extendedprice")
    return t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("camera")).agg(r6(F.median(F.when(~late, v)), "before_median"), r6(F.median(F.when(late, v)), "after_median"), r6(F.max(F.when(late, v)), "after_max"), r6(F.count_if(late & (v < 30000)) / F.count_if(late), "after_under"))


@query("WITH n AS (SELECT l_suppkey AS camera, l_orderkey, l_linenumber, l_partkey, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem WHERE l_returnflag = 'A') SELECT camera, l_orderkey, l_linenumber, l_partkey FROM n WHERE i % CAST(ceil(n / 20.0) AS BIGINT) = 0")
def two_pass_sample(spark, sf):
    """At most 20 valid rows of each camera, every stride-th in order."""
    li = t(spark, sf, "lineitem").where("l_returnflag = 'A'")
    n = li.withColumns({"i": F.row_number().over(W.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")) - 1, "n": F.count(F.lit(1)).over(W.partitionBy("l_suppkey"))})
    return n.where(F.pmod("i", F.ceil(F.col("n") / 20)) == 0).select(F.col("l_suppkey").alias("camera"), "l_orderkey", "l_linenumber", "l_partkey")


@query("WITH p AS (SELECT vec_id, unnest(range(8)) AS k, embedding AS e FROM embeddings), q AS (SELECT vec_id, k, CAST(e[2 * k + 1] AS DOUBLE) AS x, CAST(e[2 * k + 2] AS DOUBLE) AS y, CAST(e[2 * ((k + 1) % 8) + 1] AS DOUBLE) AS x2, CAST(e[2 * ((k + 1) % 8) + 2] AS DOUBLE) AS y2 FROM p) SELECT vec_id, round(abs(sum(x * y2 - x2 * y)) / 2, 6) AS area, sum(x * y2 - x2 * y) > 0 AS counter_clockwise, count(*) FILTER (WHERE (y > 0) <> (y2 > 0) AND 0 < (x2 - x) * (0 - y) / (y2 - y) + x) % 2 = 1 AS holds_origin FROM q GROUP BY vec_id")
def polygons(spark, sf):
    """Vectors as polygons of eight corners: area, orientation, even-odd test of the origin, without exploding them."""
    at = lambda k, off: F.get("embedding", (2 * (k % 8) + off).cast("int")).cast("double")
    sides = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.struct(at(k, 0).alias("x"), at(k, 1).alias("y"), at(k + 1, 0).alias("x2"), at(k + 1, 1).alias("y2")))
    e = t(spark, sf, "embeddings").select("vec_id", sides.alias("sides"))
    twice = F.aggregate("sides", F.lit(0.0), lambda acc, s: acc + s["x"] * s["y2"] - s["x2"] * s["y"])
    crossings = F.size(F.filter("sides", lambda s: ((s["y"] > 0) != (s["y2"] > 0)) & ((s["x2"] - s["x"]) * (-s["y"]) / F.when(s["y2"] != s["y"], s["y2"] - s["y"]) + s["x"] > 0)))
    return e.select("vec_id", r6(F.abs(twice) / 2, "area"), (twice > 0).alias("counter_clockwise"), (F.pmod(crossings, F.lit(2)) == 1).alias("holds_origin"))


@query(f"WITH {E4} SELECT vec_id, round(a, 6) AS x, round(b, 6) AS y FROM e WHERE abs(a) < 0.5 AND abs(b) < 0.5")
def undistort(spark, sf):
    """Distorts points and undoes it by twelve fixed-point steps: the points come back."""
    k1 = 0.05
    e = vec4(spark, sf).where("abs(a) < 0.5 and abs(b) < 0.5")
    r2 = F.col("a") * F.col("a") + F.col("b") * F.col("b")
    e = e.withColumns({"u": F.col("a") * (1 + k1 * r2), "v": F.col("b") * (1 + k1 * r2)})

    def step(acc, _):
        f = 1 + k1 * (acc["x"] * acc["x"] + acc["y"] * acc["y"])
        return F.struct((F.col("u") / f).alias("x"), (F.col("v") / f).alias("y"))

    p = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.struct(F.col("u").alias("x"), F.col("v").alias("y")), step)
    return e.withColumn("p", p).select("vec_id", r6(F.col("p.x"), "x"), r6(F.col("p.y"), "y"))


@query(f"WITH {E4}, r AS (SELECT label, a AS ox, b AS oy, c / sqrt(c * c + d * d) AS dx, d / sqrt(c * c + d * d) AS dy FROM e), s AS (SELECT label, sum(1 - dx * dx) AS m11, sum(-dx * dy) AS m12, sum(1 - dy * dy) AS m22, sum((1 - dx * dx) * ox - dx * dy * oy) AS v1, sum(-dx * dy * ox + (1 - dy * dy) * oy) AS v2 FROM r GROUP BY label) SELECT label, round((m22 * v1 - m12 * v2) / (m11 * m22 - m12 * m12), 6) AS x, round((m11 * v2 - m12 * v1) / (m11 * m22 - m12 * m12), 6) AS y FROM s")
def triangulation(spark, sf):
    """Point nearest to all rays of a group: sums of normal equations and a closed 2x2 solve."""
    n = F.sqrt(F.col("c") * F.col("c") + F.col("d") * F.col("d"))
    dx, dy, ox, oy = F.col("c") / n, F.col("d") / n, F.col("a"), F.col("b")
    s = vec4(spark, sf).groupBy("label").agg(F.sum(1 - dx * dx).alias("m11"), F.sum(-dx * dy).alias("m12"), F.sum(1 - dy * dy).alias("m22"), F.sum((1 - dx * dx) * ox - dx * dy * oy).alias("v1"), F.sum(-dx * dy * ox + (1 - dy * dy) * oy).alias("v2"))
    det = F.col("m11") * F.col("m22") - F.col("m12") * F.col("m12")
    return s.select("label", r6((F.col("m22") * F.col("v1") - F.col("m12") * F.col("v2")) / det, "x"), r6((F.col("m11") * F.col("v2") - F.col("m12") * F.col("v1")) / det, "y"))


@query("WITH c AS (SELECT l_suppkey AS camera, floor(l_quantity / 10) AS cell, count(*) AS n, avg(l_extendedprice / 1000 - 38) AS bias, avg(abs(l_extendedprice / 1000 - 38)) AS size FROM lineitem GROUP BY ALL HAVING count(*) >= 5), h AS (SELECT camera, least(7, greatest(0, CAST(floor((bias / size + 1) * 4) AS INT))) AS bin, count(*) AS n FROM c GROUP BY ALL), p AS (SELECT camera, n / sum(n) OVER (PARTITION BY camera) AS p FROM h) SELECT camera, round(sum(p * ln(p * 8)), 6) AS divergence FROM p GROUP BY camera")
def directional_bias(spark, sf):
    """Cells' normalised mean errors in eight clamped bins, and their divergence from an even spread: three chained groupings."""
    v = F.col("l_extendedprice") / 1000 - 38
    cells = t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("camera"), F.floor(F.col("l_quantity") / 10).alias("cell")).agg(n_rows("n"), F.avg(v).alias("bias"), F.avg(F.abs(v)).alias("size")).where("n >= 5")
    bins = cells.groupBy("camera", F.least(F.lit(7), F.greatest(F.lit(0), F.floor((F.col("bias") / F.col("size") + 1) * 4))).alias("bin")).agg(n_rows("n"))
    p = bins.withColumn("p", F.col("n") / F.sum("n").over(W.partitionBy("camera")))
    return p.groupBy("camera").agg(r6(F.sum(F.col("p") * F.ln(F.col("p") * 8)), "divergence"))


@query("WITH RECURSIVE e AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events), w AS (SELECT user_id, i, event_id, value AS last, true AS kept FROM e WHERE i = 1 UNION ALL SELECT e.user_id, e.i, e.event_id, CASE WHEN e.value > w.last THEN e.value ELSE w.last END, e.value > w.last FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1) SELECT user_id, event_id FROM w WHERE kept")
def monotonic_filter(spark, sf):
    """Rows above every earlier accepted one: the running maximum of the rows before."""
    e = t(spark, sf, "events")
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, -1)
    return e.withColumn("top", F.max("value").over(w)).where("top is null or value > top").select("user_id", "event_id")


@query("WITH x AS (SELECT s_suppkey AS id, s_acctbal AS v, 1 AS rank FROM supplier UNION ALL SELECT c_custkey, c_acctbal, 2 FROM customer UNION ALL SELECT p_partkey, p_retailprice, 3 FROM part) SELECT id, CASE max(rank) WHEN 1 THEN 'side_prior' WHEN 2 THEN 'direct' ELSE 'override' END AS source, max_by(v, rank) AS v FROM x GROUP BY id")
def override_precedence(spark, sf):
    part = lambda name, k, v, rank: t(spark, sf, name).select(F.col(k).alias("id"), F.col(v).alias("v"), F.lit(rank).alias("rank"))
    x = part("supplier", "s_suppkey", "s_acctbal", 1).unionByName(part("customer", "c_custkey", "c_acctbal", 2)).unionByName(part("part", "p_partkey", "p_retailprice", 3))
    source = F.element_at(F.array(*(F.lit(n) for n in ("side_prior", "direct", "override"))), F.max("rank"))
    return x.groupBy("id").agg(source.alias("source"), F.max_by("v", "rank").alias("v"))


@query("WITH k AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events WHERE event_type = 'view'), l AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events WHERE event_type = 'click') SELECT k.user_id, count(*) AS n FROM k JOIN l ON k.user_id = l.user_id AND l.us BETWEEN k.us - 21600000000 AND k.us + 21600000000 GROUP BY k.user_id")
def interval_join(spark, sf):
    """Time-range join on buckets one range wide: each row meets three buckets of its key."""
    width = 21_600_000_000
    side = lambda kind: t(spark, sf, "events").where(F.col("event_type") == kind).select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    k = side("view").withColumn("bucket", F.explode(F.array(*(F.floor(F.col("us") / width) + d for d in (-1, 0, 1))))).alias("k")
    b = side("click").withColumn("bucket", F.floor(F.col("us") / width)).alias("l")
    hit = k.join(b, (F.col("k.user_id") == F.col("l.user_id")) & (F.col("k.bucket") == F.col("l.bucket")) & (F.abs(F.col("k.us") - F.col("l.us")) <= width))
    return hit.groupBy(F.col("k.user_id").alias("user_id")).agg(n_rows("n"))


@query("SELECT c_custkey, coalesce(CAST(try_cast(substr(c_name, 10) AS BIGINT) AS VARCHAR), substr(c_name, 10)) AS frame_text, concat(c_mktsegment, '::', coalesce(CAST(try_cast(substr(c_name, 10) AS BIGINT) AS VARCHAR), substr(c_name, 10))) AS frame_key, lower(trim(c_mktsegment)) IN ('building', 'machinery') AS active FROM customer")
def frame_keys(spark, sf):
    text = S.canonical_number(F.substring("c_name", 10, 99))
    return t(spark, sf, "customer").select("c_custkey", text.alias("frame_text"), F.concat_ws("::", "c_mktsegment", text).alias("frame_key"), F.lower(F.trim("c_mktsegment")).isin("building", "machinery").alias("active"))
