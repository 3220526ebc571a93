"""Summaries of runs: residuals, gates, coverage, timing, overlaps and fits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.operators import summary as Y
from sightline.operators.quantiles import grouped_quantiles
from sightline.plans.catalog import BEST, E4, M, RES, best, metrics, n_rows, query, r6, residuals, t, vec4

_FACE = "f AS (SELECT l_orderkey % 500 AS frame, l_partkey % 8 AS face, l_extendedprice / 1000 AS before, l_extendedprice * (1 - l_discount) / 1000 AS after FROM lineitem)"


@query(f"WITH {_FACE} SELECT frame, face, count(*) AS n, round(median(before), 9) AS initial, round(median(after), 9) AS final, round(quantile_cont(after, 0.9), 9) AS final_p90, round(max(after), 9) AS final_max FROM f GROUP BY ALL")
def frame_face_quality(spark, sf):
    """Residuals of each frame and face before and after the refinement."""
    li = t(spark, sf, "lineitem").select((F.col("l_orderkey") % 500).alias("frame"), (F.col("l_partkey") % 8).cast("bigint").alias("face"), (F.col("l_extendedprice") / 1000).alias("before"), (F.col("l_extendedprice") * (1 - F.col("l_discount")) / 1000).alias("after"))
    q = grouped_quantiles(li, ["frame", "face"], {"initial": ("before", 0.5), "final": ("after", 0.5), "final_p90": ("after", 0.9), "final_max": ("after", 1.0)})
    return q.select("frame", "face", "n", *(F.round(c, 9).alias(c) for c in ("initial", "final", "final_p90", "final_max")))


@query("WITH p AS (SELECT l_suppkey AS camera, l_linenumber AS seq, l_orderkey AS k, l_partkey, l_extendedprice AS x FROM lineitem) SELECT camera, count(*) AS n, CAST(sum(CAST(round(x * 100) AS BIGINT)) AS BIGINT) AS total, round(max(x), 6) AS worst FROM p GROUP BY camera")
def error_statistics(spark, sf):
    """Count, sum (in hundredths, so that it is exact) and maximum of each camera's errors."""
    li = t(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("camera")).agg(n_rows("n"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("total"), r6(F.max("l_extendedprice"), "worst"))


_GRID = "g AS (SELECT vec_id // 20 AS gx, vec_id % 20 AS gy, CAST(vec_id // 20 AS DOUBLE) + e[1] * 0.1 AS x, vec_id % 20 + e[2] * 0.1 AS y FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings))"


@query(f"WITH {_GRID}, n AS (SELECT 0.08 / sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS ratio FROM g a JOIN g b ON (b.gx = a.gx + 1 AND b.gy = a.gy) OR (b.gx = a.gx AND b.gy = a.gy + 1)) SELECT count(*) AS pairs, round(coalesce(exp(avg(ln(ratio))), 1.0), 8) AS factor FROM n")
def metric_scale(spark, sf):
    """The factor that makes a grid's neighbours one cell apart: the geometric mean of ideal over measured; 1 without pairs."""
    e = t(spark, sf, "embeddings")
    v = lambda k: F.element_at("embedding", k).cast("double")
    gx, gy = F.floor(F.col("vec_id") / 20), F.col("vec_id") % 20
    return Y.metric_scale(e.select(gx.alias("gx"), gy.alias("gy"), (gx + v(1) * 0.1).alias("x"), (gy + v(2) * 0.1).alias("y")), "gx", "gy", ["x", "y"], 0.08).select("pairs", F.round("factor", 8).alias("factor"))


@query(f"""WITH {RES}, m AS (SELECT camera, median(residual) AS med FROM r GROUP BY camera), d AS (SELECT camera, any_value(med) AS med, median(abs(residual - med)) AS mad FROM r JOIN m USING (camera) GROUP BY camera), h AS (SELECT camera, least(90.0, greatest(2.0, med + 4 * 1.4826 * mad)) AS threshold FROM d)
SELECT camera, round(any_value(threshold), 6) AS threshold, count(*) FILTER (WHERE residual <= threshold) AS inliers, CASE WHEN count(*) FILTER (WHERE residual <= threshold) >= 560 THEN 'adaptive' WHEN count(*) FILTER (WHERE residual <= 90) >= 560 THEN 'fallback' ELSE 'rejected' END AS used FROM r JOIN h USING (camera) GROUP BY camera""")
def adaptive_inliers(spark, sf):
    """Inliers by an adaptive threshold; where too few are left by the largest allowed one, else the view is rejected."""
    return Y.adaptive_inliers(residuals(spark, sf), "camera", "residual", most=90.0, least=560).withColumn("threshold", F.round("threshold", 6))


@query(f"WITH {E4} SELECT label, count(*) AS votes, round(median(a), 6) AS cx, round(median(b), 6) AS cy, round(median(c), 6) AS cz, round(median(abs(d)), 6) AS residual_median, round(quantile_cont(abs(d), 0.9), 6) AS residual_p90 FROM e GROUP BY label")
def outer_votes(spark, sf):
    """Votes per group: how many, their median centre, median and p90 of their residuals."""
    e = vec4(spark, sf).withColumn("r", F.abs("d"))
    q = grouped_quantiles(e, ["label"], {"cx": ("a", 0.5), "cy": ("b", 0.5), "cz": ("c", 0.5), "residual_median": ("r", 0.5), "residual_p90": ("r", 0.9)})
    return q.select("label", F.col("n").alias("votes"), *(r6(F.col(c), c) for c in ("cx", "cy", "cz", "residual_median", "residual_p90")))


@query("""WITH f AS (SELECT l_suppkey AS k, regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i FROM lineitem GROUP BY ALL), r AS (SELECT k, l_quantity AS x, l_extendedprice AS y, abs(l_extendedprice - s * l_quantity - i) AS e FROM lineitem JOIN f ON k = l_suppkey), c AS (SELECT k, quantile_cont(e, 0.8) AS cut FROM r GROUP BY k)
SELECT k AS camera, count(*) AS kept, round(regr_slope(y, x), 4) AS slope, round(regr_intercept(y, x), 3) AS intercept FROM r JOIN c USING (k) WHERE e <= cut GROUP BY k""")
def trimmed_fit(spark, sf):
    """A line per camera, then once more without the fifth of rows that lies farthest from the first."""
    li = t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("camera"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return Y.trimmed_line(li, "camera", "x", "y", 0.8).select("camera", "kept", F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query(f"WITH {E4} SELECT label, round(min(a), 6) AS lx, round(min(b), 6) AS ly, round(min(c), 6) AS lz, round(max(a), 6) AS hx, round(max(b), 6) AS hy, round(max(c), 6) AS hz FROM e GROUP BY label")
def cloud_bounds(spark, sf):
    return vec4(spark, sf).groupBy("label").agg(*(r6(f(c), f"{p}{n}") for f, p in ((F.min, "l"), (F.max, "h")) for c, n in zip("abc", "xyz", strict=True)))


@query("""WITH j AS (SELECT user_id AS job, event_type AS stage, count(*) AS n, min(ts) AS first, max(ts) AS last, count(*) FILTER (WHERE event_type = 'error' AND value > 90) AS hard FROM events GROUP BY ALL)
SELECT job, count(*) AS stages, CAST(sum(epoch_us(last) - epoch_us(first)) // 1000 AS BIGINT) AS busy_ms, coalesce(string_agg(stage, ',' ORDER BY stage) FILTER (WHERE hard > 0), '') AS failed FROM j GROUP BY job""")
def job_timing(spark, sf):
    """Stages of each job, their durations added up, and those that failed hard."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    j = t(spark, sf, "events").groupBy(F.col("user_id").alias("job"), F.col("event_type").alias("stage")).agg((F.max(us) - F.min(us)).alias("took"), F.count_if((F.col("event_type") == "error") & (F.col("value") > 90)).alias("hard"))
    return j.groupBy("job").agg(n_rows("stages"), F.floor(F.sum("took") / 1000).cast("bigint").alias("busy_ms"), F.array_join(F.sort_array(F.collect_list(F.when(F.col("hard") > 0, F.col("stage")))), ",").alias("failed"))


@query("""WITH s AS (SELECT s_nationkey AS grp, s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'accepted' WHEN s_suppkey % 3 = 1 THEN 'prior' ELSE 'rejected' END AS decision, CASE WHEN s_suppkey % 10 = 0 THEN 'bad' ELSE CAST(s_acctbal AS VARCHAR) END AS delta FROM supplier)
SELECT grp, coalesce(string_agg(s_suppkey, ',' ORDER BY s_suppkey) FILTER (WHERE decision = 'accepted'), '') AS accepted, coalesce(string_agg(s_suppkey, ',' ORDER BY s_suppkey) FILTER (WHERE decision <> 'accepted'), '') AS kept, max(abs(coalesce(try_cast(delta AS DOUBLE), 0))) AS largest, count(DISTINCT decision) AS decisions FROM s GROUP BY grp""")
def acceptance_summary(spark, sf):
    """Ids by decision and the largest absolute delta; a delta that is no number counts as 0."""
    k = F.col("s_suppkey")
    s = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("grp"), k, F.when(k % 3 == 0, "accepted").when(k % 3 == 1, "prior").otherwise("rejected").alias("decision"), F.when(k % 10 == 0, "bad").otherwise(F.col("s_acctbal").cast("string")).alias("delta"))
    ids = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(c, k))), lambda x: x.cast("string")), ",")
    return s.groupBy("grp").agg(ids(F.col("decision") == "accepted").alias("accepted"), ids(F.col("decision") != "accepted").alias("kept"), F.max(F.abs(F.coalesce(F.col("delta").try_cast("double"), F.lit(0.0)))).alias("largest"), F.countDistinct("decision").alias("decisions"))


@query("""WITH v AS (SELECT o_custkey AS camera, count(*) FILTER (WHERE o_orderstatus = 'F') AS solved, median(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS med FROM orders GROUP BY o_custkey)
SELECT c_custkey AS camera, c_acctbal > 0 AND coalesce(solved, 0) >= 3 AND coalesce(med, 'Infinity'::DOUBLE) <= 250000 AS usable FROM customer LEFT JOIN v ON camera = c_custkey""")
def anchor_usability(spark, sf):
    """Cameras fit to anchor: connected, with enough solved views, and a median error that is not too large; a missing one is infinite."""
    done = F.col("o_orderstatus") == "F"
    o = t(spark, sf, "orders").select(F.col("o_custkey").alias("camera"), F.when(done, F.col("o_totalprice")).alias("error"))
    v = grouped_quantiles(o, ["camera"], {"med": ("error", 0.5)}).join(o.groupBy("camera").agg(F.count("error").alias("solved")), "camera")
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("camera"), (F.col("c_acctbal") > 0).alias("connected")).join(v, "camera", "left")
    return c.select("camera", (F.col("connected") & (F.coalesce("solved", F.lit(0)) >= 3) & (F.coalesce("med", F.lit(float("inf"))) <= 250000)).alias("usable"))


@query(f"""WITH {BEST}, s AS (SELECT frame FROM (SELECT frame, count(*) AS n FROM b WHERE decode_ok AND tag_count >= 4 GROUP BY frame) WHERE n >= 50)
SELECT camera, count(*) AS images, count(*) FILTER (WHERE s.frame IS NOT NULL) AS selected, count(*) FILTER (WHERE s.frame IS NOT NULL AND decode_ok AND tag_count >= 4) AS selected_passing, CAST(coalesce(sum(tag_count) FILTER (WHERE s.frame IS NOT NULL), 0) AS BIGINT) AS selected_tags FROM b LEFT JOIN s USING (frame) GROUP BY camera""")
def selected_camera_stats(spark, sf):
    """Camera statistics over the chosen metric rows, with those of selected frames."""
    b = best(spark, sf)
    ok = F.col("decode_ok") & (F.col("tag_count") >= 4)
    s = b.where(ok).groupBy("frame").agg(n_rows("n")).where("n >= 50").select("frame", F.lit(True).alias("chosen"))
    chosen = F.coalesce("chosen", F.lit(False))
    return b.join(s, "frame", "left").groupBy("camera").agg(n_rows("images"), F.count_if(chosen).alias("selected"), F.count_if(chosen & ok).alias("selected_passing"), F.coalesce(F.sum(F.when(chosen, F.col("tag_count"))), F.lit(0)).alias("selected_tags"))


@query(f"WITH {M} SELECT camera, frame, max_by(l_orderkey, (decode_ok, tag_count, -l_orderkey, -l_linenumber, -l_partkey)) AS chosen, count(*) AS rivals FROM m GROUP BY camera, frame")
def feature_choice(spark, sf):
    """Of rival detections of a camera and frame the one with most valid tags, then most corners, then the first."""
    rank = F.struct("decode_ok", "tag_count", -F.col("l_orderkey"), -F.col("l_linenumber"), -F.col("l_partkey"))
    return metrics(spark, sf).groupBy("camera", "frame").agg(F.max_by("l_orderkey", rank).alias("chosen"), n_rows("rivals"))


@query(f"WITH {M}, d AS (SELECT DISTINCT frame, camera, l_partkey % 200 AS tag FROM m), s AS (SELECT frame, tag, count(*) AS n FROM d GROUP BY ALL) SELECT frame, count(DISTINCT camera) AS cameras, count(DISTINCT tag) AS tags, (SELECT count(*) FROM s WHERE s.frame = d.frame AND n >= 2) AS shared FROM d GROUP BY frame ORDER BY cameras DESC, shared DESC, frame LIMIT 24")
def covisible_frames(spark, sf):
    """The 24 frames that most cameras share: cameras, tags, and tags seen by two cameras or more."""
    d = metrics(spark, sf).select("frame", "camera", (F.col("l_partkey") % 200).alias("tag")).distinct()
    shared = d.groupBy("frame", "tag").agg(n_rows("n")).groupBy("frame").agg(F.count_if(F.col("n") >= 2).alias("shared"))
    return d.groupBy("frame").agg(F.countDistinct("camera").alias("cameras"), F.countDistinct("tag").alias("tags")).join(shared, "frame").orderBy(F.desc("cameras"), F.desc("shared"), "frame").limit(24)


@query("""WITH f AS (SELECT l_suppkey % 40 AS cam, l_orderkey % 300 AS frame, count(*) FILTER (WHERE l_returnflag = 'N') AS n FROM lineitem GROUP BY ALL), c AS (SELECT DISTINCT cam FROM f)
SELECT x.cam AS camera_a, y.cam AS camera_b, count(p.frame) AS common, count(*) FILTER (WHERE p.n > 0 AND q.n > 0) AS both_seen, CAST(coalesce(sum(p.n + q.n), 0) AS BIGINT) AS features FROM c x JOIN c y ON x.cam < y.cam LEFT JOIN f p ON p.cam = x.cam LEFT JOIN f q ON q.cam = y.cam AND q.frame = p.frame WHERE q.frame IS NOT NULL GROUP BY ALL""")
def pair_overlap(spark, sf):
    """Camera pairs: common frames, frames where both see features, and their features."""
    f = t(spark, sf, "lineitem").groupBy((F.col("l_suppkey") % 40).alias("cam"), (F.col("l_orderkey") % 300).alias("frame")).agg(F.count_if(F.col("l_returnflag") == "N").alias("n"))
    return Y.pair_overlap(f, "cam", "frame", "n")


@query(f"""WITH {E4}, q AS (SELECT *, sqrt(a * a + b * b + c * c + d * d) AS n FROM e) SELECT x.vec_id AS id_a, y.vec_id AS id_b FROM q x JOIN q y ON x.label = y.label AND x.vec_id < y.vec_id AND sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c)) <= 0.08 AND degrees(2 * acos(least(1.0, abs(x.a * y.a + x.b * y.b + x.c * y.c + x.d * y.d) / (x.n * y.n)))) <= 60""")
def pose_similarity_join(spark, sf):
    """Pairs of a group that are close in position and in rotation, on a grid of cells one radius wide."""
    return Y.close_poses(vec4(spark, sf), "vec_id", "label", ["a", "b", "c"], ["a", "b", "c", "d"], 0.08, 60.0)


@query(f"WITH {E4} SELECT x.vec_id AS id_a, y.vec_id AS id_b FROM e x JOIN e y ON x.vec_id < y.vec_id AND sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c)) BETWEEN 1e-6 AND 0.05")
def radius_neighbours(spark, sf):
    """Points within a radius but not at the same place, over the whole table."""
    return Y.close_poses(vec4(spark, sf).withColumn("one", F.lit(1)), "vec_id", "one", ["a", "b", "c"], None, 0.05, None, apart=1e-6)


@query("""WITH a AS (SELECT CAST(floor(l_quantity) AS BIGINT) AS x, CAST(round(l_discount * 100) AS BIGINT) AS y, count(*) FILTER (WHERE l_returnflag = 'A') AS v FROM lineitem GROUP BY ALL), b AS (SELECT CAST(floor(l_quantity) AS BIGINT) AS x, CAST(round(l_discount * 100) AS BIGINT) AS y, count(*) FILTER (WHERE l_returnflag = 'R' AND l_tax > 0.02) AS v FROM lineitem GROUP BY ALL)
SELECT count(*) AS pixels, round(avg(a.v - b.v), 6) AS shift, round(sqrt(avg((a.v - b.v) * (a.v - b.v))), 6) AS rms FROM a JOIN b USING (x, y) WHERE a.v <> 0 AND b.v <> 0""")
def raster_pair(spark, sf):
    """Two rasters compared where both have a value."""
    cell = (F.floor("l_quantity").alias("x"), F.round(F.col("l_discount") * 100).cast("bigint").alias("y"))
    both = t(spark, sf, "lineitem").groupBy(*cell).agg(F.count_if(F.col("l_returnflag") == "A").alias("a"), F.count_if((F.col("l_returnflag") == "R") & (F.col("l_tax") > 0.02)).alias("b")).where("a <> 0 AND b <> 0")
    d = F.col("a") - F.col("b")
    return both.agg(n_rows("pixels"), r6(F.avg(d), "shift"), r6(F.sqrt(F.avg(d * d)), "rms"))


@query("""WITH s AS (SELECT user_id AS camera, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events), p AS (SELECT *, n - row_number() OVER (PARTITION BY camera ORDER BY n) AS run FROM s WHERE value > 30)
SELECT camera, count(DISTINCT run) AS runs, max(len) AS longest, min(n) AS first_positive, max(n) AS last_positive FROM (SELECT *, count(*) OVER (PARTITION BY camera, run) AS len FROM p) GROUP BY camera""")
def positive_span(spark, sf):
    """Runs of positive views of each camera, the longest, and the first and last positive view."""
    n = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    p = t(spark, sf, "events").select(F.col("user_id").alias("camera"), "value", n.cast("bigint").alias("n")).where("value > 30")
    p = p.withColumn("run", F.col("n") - F.row_number().over(W.partitionBy("camera").orderBy("n")))
    runs = p.groupBy("camera", "run").agg(n_rows("len"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    return runs.groupBy("camera").agg(n_rows("runs"), F.max("len").alias("longest"), F.min("lo").alias("first_positive"), F.max("hi").alias("last_positive"))


@query("""WITH e AS (SELECT p_brand AS grp, p_size AS v FROM part) SELECT grp, count(*) AS n, count(*) FILTER (WHERE v > 0) AS non_zero, round(avg(v), 6) AS average, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.9), 6) AS p90, round(quantile_cont(v, 0.95), 6) AS p95, max(v) AS worst FROM e GROUP BY grp""")
def capture_summary(spark, sf):
    """Counts, mean, percentiles and maximum of a capture's values."""
    p = t(spark, sf, "part").select(F.col("p_brand").alias("grp"), F.col("p_size").cast("double").alias("v"))
    q = grouped_quantiles(p, ["grp"], {"p10": ("v", 0.1), "p50": ("v", 0.5), "p90": ("v", 0.9), "p95": ("v", 0.95)})
    more = p.groupBy("grp").agg(F.count_if(F.col("v") > 0).alias("non_zero"), r6(F.avg("v"), "average"), F.max("v").cast("int").alias("worst"))
    return q.join(more, "grp").select("grp", "n", "non_zero", "average", *(r6(F.col(c), c) for c in ("p10", "p50", "p90", "p95")), "worst")


@query("""WITH s AS (SELECT s_nationkey AS grp, s_suppkey, CASE WHEN s_acctbal IS NULL THEN 'missing' WHEN s_acctbal < 0 THEN 'failed' WHEN s_acctbal < 1000 THEN 'warning' ELSE 'ok' END AS status FROM supplier)
SELECT status, count(*) AS n, string_agg(s_suppkey, ',' ORDER BY s_suppkey) AS labels, count(DISTINCT grp) AS groups FROM s GROUP BY status""")
def status_tally(spark, sf):
    """How many parameter sets have each status, and which. The labels are a manifest's cameras."""
    b = F.col("s_acctbal")
    s = t(spark, sf, "supplier").withColumn("status", F.when(b.isNull(), "missing").when(b < 0, "failed").when(b < 1000, "warning").otherwise("ok"))
    return s.groupBy("status").agg(n_rows("n"), F.array_join(F.transform(F.sort_array(F.collect_list("s_suppkey")), lambda x: x.cast("string")), ",").alias("labels"), F.countDistinct("s_nationkey").alias("groups"))


@query("""WITH g AS (SELECT l_suppkey AS grp, l_linenumber AS sub, count(*) AS n, max(l_extendedprice) AS worst FROM lineitem GROUP BY ALL)
SELECT grp, max(n) AS most, min(n) AS least, round(max(worst), 4) AS worst, round(CASE WHEN count(*) FILTER (WHERE n > 0) > 0 THEN max(n) / CAST(min(n) FILTER (WHERE n > 0) AS DOUBLE) END, 6) AS spread FROM g GROUP BY grp""")
def gate_metrics(spark, sf):
    """Metrics of quality gates over sub-groups: most, least, worst, and the ratio of the largest to the smallest positive count."""
    g = t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("grp"), "l_linenumber").agg(n_rows("n"), F.max("l_extendedprice").alias("worst"))
    return g.groupBy("grp").agg(F.max("n").alias("most"), F.min("n").alias("least"), F.round(F.max("worst"), 4).alias("worst"), r6(F.max("n") / F.min(F.when(F.col("n") > 0, F.col("n"))), "spread"))


@query("""WITH o AS (SELECT o_orderkey % 400 AS frame, o_custkey % 60 AS camera, count(*) AS n FROM orders GROUP BY ALL) SELECT frame, CAST(sum(n) AS BIGINT) AS observations, count(*) AS views FROM o GROUP BY frame ORDER BY observations DESC, frame LIMIT 64""")
def busiest_frames(spark, sf):
    """The 64 frames with most observations, and their distinct views."""
    o = t(spark, sf, "orders").groupBy((F.col("o_orderkey") % 400).alias("frame"), (F.col("o_custkey") % 60).alias("camera")).agg(n_rows("n"))
    return o.groupBy("frame").agg(F.sum("n").alias("observations"), n_rows("views")).orderBy(F.desc("observations"), "frame").limit(64)


@query("""WITH s AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'identity' ELSE 'posed' END AS pose FROM orders) SELECT CASE WHEN p_partkey IS NULL THEN 'missing_point' WHEN pose IS NULL THEN 'missing_pose' WHEN pose = 'identity' THEN 'unused_pose' WHEN l_discount > 0.08 THEN 'bad_projection' ELSE 'ok' END AS status, count(*) AS n, round(avg(CASE WHEN l_discount <= 0.08 AND pose = 'posed' AND p_partkey IS NOT NULL THEN l_quantity END), 6) AS mean FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size > 5 LEFT JOIN s ON o_orderkey = l_orderkey GROUP BY 1""")
def state_residuals(spark, sf):
    """Residuals against a state: points and poses looked up, identity poses unused, and what was skipped by reason."""
    points = t(spark, sf, "part").where("p_size > 5").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("point"))
    pose = t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "P", "identity").otherwise("posed").alias("pose"))
    li = t(spark, sf, "lineitem").join(points, "l_partkey", "left").join(pose, "l_orderkey", "left")
    status = F.when(F.col("point").isNull(), "missing_point").when(F.col("pose").isNull(), "missing_pose").when(F.col("pose") == "identity", "unused_pose").when(F.col("l_discount") > 0.08, "bad_projection").otherwise("ok")
    return li.select(status.alias("status"), "l_quantity").groupBy("status").agg(n_rows("n"), r6(F.avg(F.when(F.col("status") == "ok", F.col("l_quantity"))), "mean"))


@query("""WITH k AS (SELECT l_orderkey % 1000 AS frame, l_partkey AS tag, l_linenumber % 4 AS corner, l_suppkey % 16 AS camera, l_quantity AS q FROM lineitem WHERE l_quantity <= 25) SELECT frame, tag, corner, count(DISTINCT camera) AS cameras, count(*) AS observations FROM k GROUP BY ALL HAVING count(DISTINCT camera) >= 2""")
def shared_tracks(spark, sf):
    """Tracks that two cameras or more see in a frame."""
    k = t(spark, sf, "lineitem").where("l_quantity <= 25").select((F.col("l_orderkey") % 1000).alias("frame"), F.col("l_partkey").alias("tag"), (F.col("l_linenumber") % 4).cast("bigint").alias("corner"), (F.col("l_suppkey") % 16).alias("camera"))
    return k.groupBy("frame", "tag", "corner").agg(F.countDistinct("camera").alias("cameras"), n_rows("observations")).where("cameras >= 2")


@query("""WITH a AS (SELECT p_partkey AS k, p_size AS raw FROM part WHERE p_partkey % 3 <> 0), b AS (SELECT p_partkey AS k, p_size * 2 AS final FROM part WHERE p_partkey % 4 <> 1) SELECT coalesce(a.k, b.k) AS k, raw, final, coalesce(final, raw) AS residual, CASE WHEN final IS NOT NULL THEN 'final' ELSE 'raw' END AS source FROM a FULL JOIN b ON a.k = b.k""")
def residual_overlay(spark, sf):
    """Final residuals over raw ones; a key that has only one keeps it."""
    p = t(spark, sf, "part")
    a = p.where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("raw"))
    b = p.where("p_partkey % 4 <> 1").select(F.col("p_partkey").alias("k"), (F.col("p_size") * 2).alias("final"))
    return a.join(b, "k", "full").select("k", "raw", "final", F.coalesce("final", "raw").alias("residual"), F.when(F.col("final").isNotNull(), "final").otherwise("raw").alias("source"))


@query("""WITH f AS (SELECT l_orderkey % 200 AS frame, l_suppkey % 10 AS camera, count(*) AS n FROM lineitem WHERE l_quantity > 49 GROUP BY ALL) SELECT frame, count(*) AS cameras, CAST(sum(n) AS BIGINT) AS features, row_number() OVER (ORDER BY frame) - 1 AS new_index FROM f GROUP BY frame""")
def filled_imagesets(spark, sf):
    """Frames that kept a feature, numbered anew."""
    f = t(spark, sf, "lineitem").where("l_quantity > 49").groupBy((F.col("l_orderkey") % 200).alias("frame"), (F.col("l_suppkey") % 10).alias("camera")).agg(n_rows("n"))
    from sightline.operators.relational import dense_index

    return dense_index(f.groupBy("frame").agg(n_rows("cameras"), F.sum("n").alias("features")), "frame", "new_index")


@query(f"""WITH {E4}, g AS (SELECT label, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc FROM e GROUP BY label), r AS (SELECT e.label, sqrt((a - ma) * (a - ma) + (b - mb) * (b - mb) + (c - mc) * (c - mc)) AS r FROM e JOIN g USING (label)) SELECT label AS face, count(*) AS n, round(sqrt(avg(r * r)), 6) AS rms, round(max(r), 6) AS worst, count(*) < 3 AS identity FROM r GROUP BY label""")
def face_residuals(spark, sf):
    """Residuals of each face about its initial place; a face of fewer than three points stays at the identity."""
    e = vec4(spark, sf)
    mean = e.groupBy("label").agg(*(F.avg(k).alias(f"m{k}") for k in "abc"))
    r2 = sum(((F.col(k) - F.col(f"m{k}")) * (F.col(k) - F.col(f"m{k}")) for k in "abc"), F.lit(0.0))
    return e.join(mean, "label").groupBy(F.col("label").alias("face")).agg(n_rows("n"), r6(F.sqrt(F.avg(r2)), "rms"), r6(F.sqrt(F.max(r2)), "worst"), (F.count(F.lit(1)) < 3).alias("identity"))
