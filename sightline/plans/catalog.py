"""Named queries over the driver tables, each with the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions import scalars as S
from sightline.operators import relational as R
from sightline.operators.quantiles import grouped_quantiles, table_quantile

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as image metrics: camera, frame (month), tag_count, decode_ok."""
    li = t(spark, sf, "lineitem")
    return li.select(F.col("l_suppkey").alias("camera"), F.date_format("l_shipdate", "yyyy-MM").alias("frame"), F.floor("l_quantity").cast("int").alias("tag_count"), (F.col("l_returnflag") != "R").alias("decode_ok"), "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("price"))


M = "m AS (SELECT l_suppkey AS camera, strftime(l_shipdate, '%Y-%m') AS frame, CAST(floor(l_quantity) AS INT) AS tag_count, l_returnflag <> 'R' AS decode_ok, l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price FROM lineitem)"
BEST = M + ", b AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY camera, frame ORDER BY tag_count DESC, decode_ok DESC, l_orderkey, l_linenumber, l_partkey, price) = 1)"


def best(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc("tag_count"), F.desc("decode_ok"), *map(F.col, ("l_orderkey", "l_linenumber", "l_partkey", "price"))]
    return R.best_per_key(metrics(spark, sf), ["camera", "frame"], order)


def residuals(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as observation residuals."""
    li = t(spark, sf, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("camera"), F.date_format("l_shipdate", "yyyy-MM").alias("frame"), F.floor(F.col("l_partkey") / 4).cast("bigint").alias("tag"), (F.col("l_partkey") % 8).cast("bigint").alias("face"),
        (F.col("l_extendedprice") / 1000).alias("residual"), F.col("l_linestatus").alias("used"), F.col("l_returnflag").alias("status"), "l_orderkey", "l_linenumber", "l_partkey",
    )


RES = "r AS (SELECT l_suppkey AS camera, strftime(l_shipdate, '%Y-%m') AS frame, CAST(floor(l_partkey / 4.0) AS BIGINT) AS tag, CAST(l_partkey % 8 AS BIGINT) AS face, l_extendedprice / 1000 AS residual, l_linestatus AS used, l_returnflag AS status, l_orderkey, l_linenumber, l_partkey FROM lineitem)"


def r6(x, name: str):
    return F.round(x, 6).alias(name)


def n_rows(name: str):
    return F.count(F.lit(1)).alias(name)


# quality control ------------------------------------------------------------------------------


@query(f"WITH {BEST} SELECT camera, frame, tag_count, decode_ok FROM b")
def qc_dedupe_best(spark, sf):
    return best(spark, sf).select("camera", "frame", "tag_count", "decode_ok")


GATE = f"""{BEST}, g AS (SELECT frame, count(*) AS observed_cameras, count(*) FILTER (WHERE decode_ok AND tag_count >= 4) AS passing_cameras, (SELECT count(*) FROM supplier) AS active_cameras FROM b GROUP BY frame),
s AS (SELECT *, CASE WHEN observed_cameras <> active_cameras THEN 'missing_camera_metrics' WHEN passing_cameras < 50 THEN 'below_min_cameras_per_frame' ELSE 'selected' END AS status FROM g)"""


def gate(spark, sf):
    cameras = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("camera"))
    return R.frame_gate(best(spark, sf), cameras, "camera", "frame", F.col("decode_ok") & (F.col("tag_count") >= 4), 50)


@query(f"WITH {GATE} SELECT * FROM s")
def qc_frame_gate(spark, sf):
    return gate(spark, sf)


@query(f"WITH {GATE}, k AS (SELECT frame, row_number() OVER (ORDER BY frame) - 1 AS n FROM s WHERE status = 'selected') SELECT s.frame, s.status, k.n IS NOT NULL AND k.n % 2 = 0 AND k.n // 2 < 20 AS selected, CASE WHEN k.n % 2 = 0 AND k.n // 2 < 20 THEN k.n // 2 END AS out_frame FROM s LEFT JOIN k USING (frame)")
def frame_stride_limit(spark, sf):
    g = gate(spark, sf)
    kept = R.stride_limit(g.where("status = 'selected'").select("frame"), [F.col("frame")], 2, 20)
    return g.join(kept, "frame", "left").select("frame", "status", F.col("out_index").isNotNull().alias("selected"), F.col("out_index").alias("out_frame"))


@query(f"WITH {M} SELECT camera, count(*) AS images, count(*) FILTER (WHERE decode_ok) AS decoded, count(*) FILTER (WHERE NOT decode_ok) AS failed, count(*) FILTER (WHERE decode_ok AND tag_count >= 4) AS passing, CAST(sum(tag_count) AS BIGINT) AS tags, max(tag_count) AS max_tags, min(frame) FILTER (WHERE decode_ok AND tag_count >= 4) AS first_passing, max(frame) FILTER (WHERE decode_ok AND tag_count >= 4) AS last_passing FROM m GROUP BY camera")
def qc_camera_stats(spark, sf):
    ok = F.col("decode_ok") & (F.col("tag_count") >= 4)
    return metrics(spark, sf).groupBy("camera").agg(
        n_rows("images"), F.count_if("decode_ok").alias("decoded"), F.count_if(~F.col("decode_ok")).alias("failed"), F.count_if(ok).alias("passing"), F.sum("tag_count").alias("tags"),
        F.max("tag_count").alias("max_tags"), F.min(F.when(ok, F.col("frame"))).alias("first_passing"), F.max(F.when(ok, F.col("frame"))).alias("last_passing"),
    )


@query(f"WITH {M} SELECT frame, camera, count(*) AS images, count(*) FILTER (WHERE decode_ok) AS decoded, round(count(*) FILTER (WHERE decode_ok) / count(*), 6) AS ratio FROM m GROUP BY ROLLUP (frame, camera)")
def qc_time_rollup(spark, sf):
    return metrics(spark, sf).rollup("frame", "camera").agg(n_rows("images"), F.count_if("decode_ok").alias("decoded")).withColumn("ratio", F.round(F.col("decoded") / F.col("images"), 6))


@query("SELECT c_custkey AS missing FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def qc_missing_members(spark, sf):
    return t(spark, sf, "customer").join(t(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(F.col("c_custkey").alias("missing"))


@query(f"WITH {GATE} SELECT s.frame, c.s_suppkey AS camera, CASE WHEN b.camera IS NULL THEN 'missing_metric_row' ELSE 'staged' END AS reason, b.decode_ok AND b.tag_count >= 4 AS passes FROM s CROSS JOIN supplier c LEFT JOIN b ON b.frame = s.frame AND b.camera = c.s_suppkey WHERE s.status = 'selected'")
def staging_plan(spark, sf):
    """Selected frames x manifest cameras is the plan itself. Frames are months, so their list is bounded; each camera carries it."""
    months = gate(spark, sf).where("status = 'selected'").agg(F.collect_set("frame").alias("frames"))
    frames = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("camera")).join(F.broadcast(months)).select("camera", F.explode("frames").alias("frame"))
    b = best(spark, sf)
    return frames.join(b, ["frame", "camera"], "left").select("frame", "camera", F.when(F.col("tag_count").isNull(), "missing_metric_row").otherwise("staged").alias("reason"), (F.col("decode_ok") & (F.col("tag_count") >= 4)).alias("passes"))


# residuals ------------------------------------------------------------------------------------


@query(f"WITH {RES} SELECT scope, count(*) AS n, round(avg(residual), 6) AS mean FROM (SELECT unnest(['all', 'ok', 'used_after_gate']) AS scope, * FROM r) WHERE scope = 'all' OR (scope = 'ok' AND status <> 'R') OR (scope = 'used_after_gate' AND used = 'O') GROUP BY scope")
def residual_scope(spark, sf):
    scopes = S.reasons((F.lit(True), "all"), (F.col("status") != "R", "ok"), (F.col("used") == "O", "used_after_gate"))
    return residuals(spark, sf).select(F.explode(scopes).alias("scope"), "residual").groupBy("scope").agg(n_rows("n"), r6(F.avg("residual"), "mean"))


#: The mean is taken over whole units of 1e-5, so that the order of addition can't move a rounding.
SUMMARY = "count(*) AS n, round(sum(CAST(round(residual * 100000) AS BIGINT)) / count(*) / 100000, 6) AS mean, round(quantile_cont(residual, 0.5), 6) AS median, round(quantile_cont(residual, 0.9), 6) AS p90, round(max(residual), 6) AS worst, round(avg(CASE WHEN residual < 30 THEN 1.0 ELSE 0.0 END), 6) AS under_30"


@query(f"WITH {RES} SELECT camera, frame, tag, face, {SUMMARY} FROM r GROUP BY GROUPING SETS ((camera), (frame), (tag), (face))")
def residual_summary_4way(spark, sf):
    sets = ["camera", "frame", "tag", "face"]
    mean = F.sum(F.round(F.col("residual") * 100000).cast("bigint")) / F.count(F.lit(1)) / 100000
    others = [n_rows("n"), r6(mean, "mean"), r6(F.max("residual"), "worst"), r6(F.avg((F.col("residual") < 30).cast("double")), "under_30")]
    out = R.quantiles_by(residuals(spark, sf).select(*sets, "residual"), [[k] for k in sets], "residual", [0.5, 0.9], others)
    return out.select(*sets, "n", "mean", r6(F.col("q0"), "median"), r6(F.col("q1"), "p90"), "worst", "under_30")


@query(f"WITH {RES} SELECT camera, frame, l_orderkey, l_linenumber, l_partkey, residual FROM r ORDER BY residual DESC, l_orderkey, l_linenumber, l_partkey, camera LIMIT 100")
def residual_worst_topk(spark, sf):
    return residuals(spark, sf).orderBy(F.desc("residual"), "l_orderkey", "l_linenumber", "l_partkey", "camera").select("camera", "frame", "l_orderkey", "l_linenumber", "l_partkey", "residual").limit(100)


@query(f"WITH {RES} SELECT camera, round(max(residual), 6) AS worst, round(quantile_cont(residual, 0.9), 6) AS p90 FROM r GROUP BY camera ORDER BY worst DESC, p90 DESC, camera LIMIT 20")
def group_worst_topk(spark, sf):
    q = grouped_quantiles(residuals(spark, sf), ["camera"], {"worst": ("residual", 1.0), "p90": ("residual", 0.9)})
    return q.select("camera", r6(F.col("worst"), "worst"), r6(F.col("p90"), "p90")).orderBy(F.desc("worst"), F.desc("p90"), "camera").limit(20)


FRAMES = f"""{RES}, pc AS (SELECT frame, camera, count(*) AS n FROM r GROUP BY ALL), fc AS (SELECT frame, count(*) FILTER (WHERE n >= 2) AS cameras FROM pc GROUP BY frame),
f AS (SELECT frame, count(*) AS obs, quantile_cont(residual, 0.5) AS med, quantile_cont(residual, 0.9) AS p90 FROM r GROUP BY frame),
c AS (SELECT frame, cameras, obs, round(med, 6) AS med, round(p90, 6) AS p90, array_to_string(list_filter([CASE WHEN obs < 300 THEN 'few_observations' END, CASE WHEN cameras < 90 THEN 'few_cameras' END, CASE WHEN med > 35.5 THEN 'median' END, CASE WHEN p90 > 66 THEN 'p90' END], lambda x: x IS NOT NULL), ',') AS reasons FROM f JOIN fc USING (frame))"""


def frame_candidates(spark, sf):
    r = residuals(spark, sf)
    cams = r.groupBy("frame", "camera").agg(n_rows("n")).groupBy("frame").agg(F.count_if(F.col("n") >= 2).alias("cameras"))
    f = grouped_quantiles(r, ["frame"], {"med": ("residual", 0.5), "p90": ("residual", 0.9)}).withColumnRenamed("n", "obs")
    why = S.reasons((F.col("obs") < 300, "few_observations"), (F.col("cameras") < 90, "few_cameras"), (F.col("med") > 35.5, "median"), (F.col("p90") > 66, "p90"))
    return f.join(cams, "frame").select("frame", "cameras", "obs", r6(F.col("med"), "med"), r6(F.col("p90"), "p90"), F.array_join(why, ",").alias("reasons"))


@query(f"WITH {FRAMES} SELECT *, CASE WHEN reasons = '' THEN row_number() OVER (PARTITION BY reasons = '' ORDER BY frame) - 1 END AS new_index FROM c")
def subset_select_frames(spark, sf):
    ok = F.col("reasons") == ""
    return frame_candidates(spark, sf).withColumn("new_index", F.when(ok, (F.row_number().over(W.partitionBy(ok).orderBy("frame")) - 1).cast("bigint")))


@query(f"WITH {FRAMES} SELECT frame, med, p90, obs FROM (SELECT * FROM c ORDER BY med, p90, obs DESC, frame LIMIT 12) ORDER BY frame")
def best_frames(spark, sf):
    return frame_candidates(spark, sf).orderBy("med", "p90", F.desc("obs"), "frame").limit(12).select("frame", "med", "p90", "obs").orderBy("frame")


@query(f"WITH {FRAMES} SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM c WHERE reasons <> '') GROUP BY reason")
def rejection_histogram(spark, sf):
    return frame_candidates(spark, sf).where("reasons <> ''").select(F.explode(F.split("reasons", ",")).alias("reason")).groupBy("reason").agg(n_rows("n"))


@query(f"WITH {RES}, p AS (SELECT frame, camera, count(*) AS n FROM r GROUP BY ALL) SELECT frame, string_agg(concat(camera, ':', n), ',' ORDER BY camera) AS counts FROM p GROUP BY frame")
def per_frame_camera_map(spark, sf):
    per = residuals(spark, sf).groupBy("frame", "camera").agg(n_rows("n"))
    entries = F.sort_array(F.collect_list(F.struct("camera", "n")))
    return per.groupBy("frame").agg(F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["camera"].cast("string"), e["n"].cast("string"))), ",").alias("counts"))


@query("WITH f AS (SELECT doc_id, unnest(list_filter([CASE WHEN quality = 1 THEN 'accepted' END, CASE WHEN toxic = 1 THEN 'prior' END, CASE WHEN quality = 0 AND toxic = 0 THEN 'other' END], lambda x: x IS NOT NULL)) AS g FROM labels) SELECT g AS grp, count(*) AS n, min(doc_id) AS first_id FROM f GROUP BY g")
def overlapping_groups(spark, sf):
    flags = S.reasons((F.col("quality") == 1, "accepted"), (F.col("toxic") == 1, "prior"), ((F.col("quality") == 0) & (F.col("toxic") == 0), "other"))
    return t(spark, sf, "labels").select("doc_id", F.explode(flags).alias("grp")).groupBy("grp").agg(n_rows("n"), F.min("doc_id").alias("first_id"))


@query(f"WITH {RES} SELECT camera, list_sort(list(residual))[1 + count(*) // 2] AS hi_median, list_sort(list(residual))[1 + CAST(floor(0.9 * (count(*) - 1)) AS INT)] AS lo_p90, round(median(residual), 6) AS mid FROM r GROUP BY camera")
def quantile_flavours(spark, sf):
    q = grouped_quantiles(residuals(spark, sf), ["camera"], {"hi_median": ("residual", 0.5, "upper"), "lo_p90": ("residual", 0.9, "lower"), "mid": ("residual", 0.5)})
    return q.select("camera", "hi_median", "lo_p90", r6(F.col("mid"), "mid"))


# coverage -------------------------------------------------------------------------------------

COVER = f"c AS (SELECT l_suppkey AS camera, count(*) AS points, count(DISTINCT floor(l_partkey / 4.0)) AS tags, count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS frames, round((max(l_quantity) - min(l_quantity)) * (max(l_tax) - min(l_tax)) / 4.0, 6) AS box_ratio FROM lineitem GROUP BY l_suppkey)"


def coverage(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("camera")).agg(n_rows("points"), F.countDistinct(F.floor(F.col("l_partkey") / 4)).alias("tags"), F.countDistinct(F.date_format("l_shipdate", "yyyy-MM")).alias("frames"), r6(S.box_ratio("l_quantity", "l_tax", 4.0), "box_ratio"))


@query(f"WITH {COVER} SELECT * FROM c")
def coverage_summary(spark, sf):
    return coverage(spark, sf)


@query(f"WITH {COVER} SELECT camera, CASE WHEN points < 500 OR frames < 70 THEN 'red' WHEN points < 600 OR box_ratio < 0.9 THEN 'yellow' ELSE 'green' END AS status, array_to_string(list_filter([CASE WHEN points < 600 THEN 'points' END, CASE WHEN frames < 70 THEN 'frames' END, CASE WHEN box_ratio < 0.9 THEN 'area' END], lambda x: x IS NOT NULL), ',') AS reasons FROM c")
def coverage_status(spark, sf):
    status = F.when((F.col("points") < 500) | (F.col("frames") < 70), "red").when((F.col("points") < 600) | (F.col("box_ratio") < 0.9), "yellow").otherwise("green")
    why = S.reasons((F.col("points") < 600, "points"), (F.col("frames") < 70, "frames"), (F.col("box_ratio") < 0.9, "area"))
    return coverage(spark, sf).select("camera", status.alias("status"), F.array_join(why, ",").alias("reasons"))


@query("WITH v AS (SELECT o_orderkey AS frame, o_orderstatus FROM orders), p AS (SELECT l_orderkey AS frame, l_suppkey AS camera, count(*) AS n FROM lineitem GROUP BY ALL), h AS (SELECT th, v.frame, count(p.camera) FILTER (WHERE p.n >= th) AS cameras FROM v CROSS JOIN (SELECT unnest([1, 2]) AS th) LEFT JOIN p ON p.frame = v.frame GROUP BY ALL) SELECT CAST(th AS INT) AS threshold, cameras, count(*) AS frames FROM h GROUP BY ALL")
def coverage_histogram(spark, sf):
    per = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("frame"), "l_suppkey").agg(n_rows("n")).groupBy("frame").agg(F.count_if(F.col("n") >= 1).alias("c1"), F.count_if(F.col("n") >= 2).alias("c2"))
    frames = t(spark, sf, "orders").select(F.col("o_orderkey").alias("frame")).join(per, "frame", "left")
    both = frames.select(F.inline(F.array(*(F.struct(F.lit(k).alias("threshold"), F.coalesce(f"c{k}", F.lit(0)).alias("cameras")) for k in (1, 2)))))
    return both.groupBy("threshold", "cameras").agg(n_rows("frames"))


@query("WITH s AS (SELECT DISTINCT l_orderkey AS f, l_suppkey AS c FROM lineitem), p AS (SELECT x.c AS a, y.c AS b, count(*) AS n FROM s x JOIN s y ON x.f = y.f AND x.c < y.c GROUP BY ALL) SELECT x.s_suppkey AS camera_a, y.s_suppkey AS camera_b, coalesce(n, 0) AS shared FROM supplier x JOIN supplier y ON x.s_suppkey < y.s_suppkey LEFT JOIN p ON a = x.s_suppkey AND b = y.s_suppkey")
def covisibility_pairs(spark, sf):
    """Every pair is a result row, shared instants or none: the output is the camera domain squared, the join runs on instants."""
    views = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("f"), F.col("l_suppkey").alias("camera"))
    return R.covisible_pairs(views, "f", "camera", t(spark, sf, "supplier").select(F.col("s_suppkey").alias("camera")))


@query("WITH e AS (SELECT user_id, event_id, ts, value > 50 AS p FROM events), g AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, p ORDER BY ts, event_id) AS run FROM e), k AS (SELECT user_id, run, count(*) AS n FROM g WHERE p GROUP BY ALL) SELECT user_id, count(*) AS n_runs, max(n) AS longest_run FROM k GROUP BY user_id")
def positive_runs(spark, sf):
    return R.runs(t(spark, sf, "events"), ["user_id"], F.struct("ts", "event_id"), F.col("value") > 50)


@query("WITH d AS (SELECT l_suppkey AS camera, CAST(l_shipdate AS DATE) AS day FROM lineitem), s AS (SELECT camera, min(day) AS lo, max(day) AS hi FROM d GROUP BY camera), a AS (SELECT camera, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM s), n AS (SELECT camera, day, count(*) AS n FROM d GROUP BY ALL) SELECT a.camera, strftime(a.day, '%Y-%m-%d') AS day, coalesce(n.n, 0) AS n FROM a LEFT JOIN n ON a.camera = n.camera AND a.day = n.day")
def timeline_dense(spark, sf):
    d = t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("camera"), F.to_date("l_shipdate").alias("day"))
    every = d.groupBy("camera").agg(F.sequence(F.min("day"), F.max("day")).alias("days")).select("camera", F.explode("days").alias("day"))
    return every.join(d.groupBy("camera", "day").agg(n_rows("n")), ["camera", "day"], "left").select("camera", F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("n", F.lit(0)).alias("n"))


@query("WITH g AS (SELECT strftime(l_shipdate, '%Y-%m') AS frame, CAST(l_partkey // 4 AS BIGINT) AS tag, count(DISTINCT l_suppkey) AS cameras, count(*) AS items FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_suppkey) >= 2) SELECT frame, tag, cameras, items FROM g QUALIFY row_number() OVER (PARTITION BY frame ORDER BY cameras DESC, items DESC, tag) <= 3")
def shared_tags_topk_per_frame(spark, sf):
    g = t(spark, sf, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("frame"), S.floor_div("l_partkey", 4).alias("tag")).agg(F.countDistinct("l_suppkey").alias("cameras"), n_rows("items")).where("cameras >= 2")
    return g.withColumn("_n", F.row_number().over(W.partitionBy("frame").orderBy(F.desc("cameras"), F.desc("items"), "tag"))).where("_n <= 3").drop("_n")


@query("WITH g AS (SELECT l_suppkey AS camera, l_partkey // 4 AS tag, avg(l_quantity) AS x, avg(l_tax) AS y FROM lineitem GROUP BY ALL) SELECT camera, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy, count(*) AS tags FROM g GROUP BY camera")
def centroid_of_centroids(spark, sf):
    g = t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("camera"), S.floor_div("l_partkey", 4).alias("tag")).agg(F.avg("l_quantity").alias("x"), F.avg("l_tax").alias("y"))
    return g.groupBy("camera").agg(r6(F.avg("x"), "cx"), r6(F.avg("y"), "cy"), n_rows("tags"))


@query("WITH g AS (SELECT l_orderkey AS s, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY ALL) SELECT s AS session, lo = 1 AND hi = n AS contiguous, CAST(hi - n AS BIGINT) AS missing, CAST((SELECT max(n) FROM g) - n AS BIGINT) AS tail_short FROM g")
def contiguity(spark, sf):
    g = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("session")).agg(F.min("l_linenumber").alias("lo"), F.max("l_linenumber").alias("hi"), F.countDistinct("l_linenumber").alias("n"))
    top = g.agg(F.max("n").alias("top"))
    return g.join(F.broadcast(top)).select("session", ((F.col("lo") == 1) & (F.col("hi") == F.col("n"))).alias("contiguous"), (F.col("hi") - F.col("n")).alias("missing"), (F.col("top") - F.col("n")).alias("tail_short"))


# time -----------------------------------------------------------------------------------------


def stream(spark, sf, kind: str) -> DataFrame:
    return t(spark, sf, "events").where(F.col("event_type") == kind).select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value")


EV = "a AS (SELECT user_id, event_id, epoch_us(ts) AS us, value FROM events WHERE event_type = 'view'), b AS (SELECT user_id, event_id, epoch_us(ts) AS us, value FROM events WHERE event_type = 'click')"


@query(f"WITH {EV}, j AS (SELECT a.user_id, a.event_id, b.event_id AS match_id, abs(a.us - b.us) AS delta, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.us - b.us), b.us, b.event_id) AS n FROM a JOIN b USING (user_id)) SELECT user_id, event_id, match_id, delta FROM j WHERE n = 1 AND delta <= 86400000000")
def nearest_time_join(spark, sf):
    return R.nearest_in_time(stream(spark, sf, "view"), stream(spark, sf, "click"), ["user_id"], "us", "event_id", 86_400_000_000).select("user_id", "event_id", "match_id", "delta")


@query(f"""WITH {EV}, l AS (SELECT a.event_id AS va, b.event_id AS cb, abs(a.us - b.us) AS delta, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(a.us - b.us), b.us, b.event_id) AS n, 0 AS side FROM a JOIN b USING (user_id)),
k AS (SELECT a.event_id AS va, b.event_id AS cb, abs(a.us - b.us) AS delta, row_number() OVER (PARTITION BY b.event_id ORDER BY abs(a.us - b.us), a.us, a.event_id) AS n, 1 AS side FROM a JOIN b USING (user_id)),
u AS (SELECT * FROM l WHERE n = 1 UNION ALL SELECT * FROM k WHERE n = 1) SELECT va AS view_id, cb AS click_id, min(delta) AS delta, CASE WHEN min(side) = 0 THEN 'view' ELSE 'click' END AS anchor FROM u WHERE delta <= 86400000000 GROUP BY ALL""")
def symmetric_time_pairs(spark, sf):
    a, b, day = stream(spark, sf, "view"), stream(spark, sf, "click"), 86_400_000_000
    one = R.nearest_in_time(a, b, ["user_id"], "us", "event_id", day).select(F.col("event_id").alias("view_id"), F.col("match_id").alias("click_id"), "delta", F.lit(0).alias("side"))
    two = R.nearest_in_time(b, a, ["user_id"], "us", "event_id", day).select(F.col("match_id").alias("view_id"), F.col("event_id").alias("click_id"), "delta", F.lit(1).alias("side"))
    return one.unionByName(two).groupBy("view_id", "click_id").agg(F.min("delta").alias("delta"), F.when(F.min("side") == 0, "view").otherwise("click").alias("anchor"))


@query(f"WITH {EV}, j AS (SELECT a.user_id, a.event_id, a.us, max_by(b.value, b.us) FILTER (WHERE b.us <= a.us) AS v0, max(b.us) FILTER (WHERE b.us <= a.us) AS t0, min_by(b.value, b.us) FILTER (WHERE b.us >= a.us) AS v1, min(b.us) FILTER (WHERE b.us >= a.us) AS t1 FROM a LEFT JOIN b USING (user_id) GROUP BY ALL) SELECT user_id, event_id, round(v0 + (v1 - v0) * CASE WHEN t1 = t0 THEN 0 ELSE CAST(us - t0 AS DOUBLE) / (t1 - t0) END, 6) AS interpolated FROM j")
def interp_join(spark, sf):
    return R.interpolated(stream(spark, sf, "view"), stream(spark, sf, "click"), ["user_id"], "us", "value").select("user_id", "event_id", r6(F.col("interpolated"), "interpolated"))


@query("WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us, value FROM events), l AS (SELECT *, lead(us, 2) OVER w AS us2, lead(value, 2) OVER w AS v2 FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)) SELECT event_id, us2 - us AS dt, (us + us2) // 2 AS mid, round(v2 - value, 6) AS dv FROM l WHERE us2 - us > 0 AND us2 - us < 864000000000")
def lag_pairs(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value")
    w = W.partitionBy("user_id").orderBy("us", "event_id")
    l2 = e.withColumns({"us2": F.lead("us", 2).over(w), "v2": F.lead("value", 2).over(w)}).withColumn("dt", F.col("us2") - F.col("us")).where("dt > 0 and dt < 864000000000")
    return l2.select("event_id", "dt", F.expr("(us + us2) div 2").alias("mid"), r6(F.col("v2") - F.col("value"), "dv"))


@query("SELECT o_orderkey AS left_id, r.i AS right_id FROM orders JOIN (SELECT l_shipdate AS ts, max(l_orderkey) AS i FROM lineitem GROUP BY l_shipdate) r ON r.ts = o_orderdate ORDER BY o_orderkey LIMIT 500")
def exact_time_pairs(spark, sf):
    """Rows of equal stamps: the last right row of a stamp, in the left rows' order, up to a limit."""
    right = t(spark, sf, "lineitem").groupBy(F.col("l_shipdate").alias("o_orderdate")).agg(F.max("l_orderkey").alias("right_id"))
    return t(spark, sf, "orders").join(right, "o_orderdate").select(F.col("o_orderkey").alias("left_id"), "right_id").orderBy("left_id").limit(500)


@query("SELECT event_id, count(*) OVER w AS n, round(avg(value) OVER w, 6) AS mean, round(lead(value) OVER o - lag(value) OVER o, 6) AS diff FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id), w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def centred_frames(spark, sf):
    o = W.partitionBy("user_id").orderBy("ts", "event_id")
    w = o.rowsBetween(-2, 2)
    return t(spark, sf, "events").select("event_id", F.count(F.lit(1)).over(w).alias("n"), r6(F.avg("value").over(w), "mean"), r6(F.lead("value").over(o) - F.lag("value").over(o), "diff"))


@query("SELECT event_id, count(*) OVER w AS n, round(sum(value) OVER w, 4) AS total FROM (SELECT event_id, user_id, epoch_us(ts) AS us, value FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 43200000000 PRECEDING AND 43200000000 FOLLOWING)")
def timed_frames(spark, sf):
    w = W.partitionBy("user_id").orderBy("us").rangeBetween(-43_200_000_000, 43_200_000_000)
    e = t(spark, sf, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value")
    return e.select("event_id", F.count(F.lit(1)).over(w).alias("n"), F.round(F.sum("value").over(w), 4).alias("total"))


@query()
def near_duplicate_fold(spark, sf):
    return R.greedy_selection(t(spark, sf, "events").select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], "value", 20.0, 40)


# datasets -------------------------------------------------------------------------------------


@query("WITH a AS (SELECT p_partkey AS id, p_size FROM part WHERE p_size < 25), b AS (SELECT p_partkey AS id, p_size FROM part WHERE p_size >= 25), o AS (SELECT CAST(ceil((max(id) + 1) / 4.0) * 4 AS BIGINT) AS k FROM a) SELECT id, p_size, CAST(0 AS INT) AS source_index FROM a UNION ALL SELECT id + k, p_size, 1 FROM b, o")
def dataset_merge_rebase(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_size")
    return R.rebase_merge(p.where("p_size < 25"), p.where("p_size >= 25"), "id", 4)


@query("WITH k AS (SELECT DISTINCT user_id, event_type FROM events) SELECT user_id FROM k GROUP BY user_id HAVING count(*) = (SELECT count(DISTINCT event_type) FROM events)")
def dataset_intersect_keys(spark, sf):
    k = t(spark, sf, "events").select("user_id", "event_type").distinct()
    every = k.agg(F.countDistinct("event_type").alias("all"))
    return k.groupBy("user_id").agg(n_rows("n")).join(F.broadcast(every)).where("n = all").select("user_id")


@query("SELECT strftime(ts, '%Y-%m-%d %H') AS filename, max(event_id) FILTER (WHERE event_type = 'view') AS view, max(event_id) FILTER (WHERE event_type = 'click') AS click, dense_rank() OVER (ORDER BY strftime(ts, '%Y-%m-%d %H')) - 1 AS imageset_index FROM events WHERE event_type IN ('view', 'click') GROUP BY 1")
def shard_align(spark, sf):
    e = t(spark, sf, "events").where(F.col("event_type").isin("view", "click"))
    g = e.groupBy(F.date_format("ts", "yyyy-MM-dd HH").alias("filename")).agg(*(F.max(F.when(F.col("event_type") == k, F.col("event_id"))).alias(k) for k in ("view", "click")))
    return g.withColumn("imageset_index", (F.row_number().over(W.orderBy("filename")) - 1).cast("bigint"))


@query("WITH k AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN p_size IS NOT NULL AND p_size > 10 THEN p_size % 2 = 0 ELSE l_partkey % 3 = 0 END AS keep FROM lineitem LEFT JOIN part ON p_partkey = l_partkey), n AS (SELECT *, count(*) FILTER (WHERE keep) OVER (PARTITION BY l_orderkey) AS kept FROM k) SELECT l_orderkey, count(*) AS n, max(kept) AS kept FROM n WHERE keep OR kept < 2 GROUP BY l_orderkey")
def subsample_with_fallback(spark, sf):
    k = t(spark, sf, "lineitem").join(t(spark, sf, "part"), F.col("p_partkey") == F.col("l_partkey"), "left").withColumn("keep", F.when(F.col("p_size") > 10, F.pmod("p_size", F.lit(2)) == 0).otherwise(F.pmod("l_partkey", F.lit(3)) == 0))
    n = k.withColumn("kept", F.count_if("keep").over(W.partitionBy("l_orderkey")))
    return n.where("keep or kept < 2").groupBy("l_orderkey").agg(n_rows("n"), F.max("kept").alias("kept"))


CASC = """l AS (SELECT c_nationkey AS nation, c_mktsegment AS segment, c_custkey AS payload FROM customer WHERE c_acctbal > 8500),
k1 AS (SELECT nation, segment, min(payload) AS p FROM l GROUP BY ALL HAVING min(payload) = max(payload)), k2 AS (SELECT nation, min(payload) AS p FROM l GROUP BY ALL HAVING min(payload) = max(payload))"""


@query(f"WITH {CASC} SELECT c_custkey, coalesce(k1.p, k2.p) AS payload, CASE WHEN k1.p IS NOT NULL THEN 1 WHEN k2.p IS NOT NULL THEN 2 ELSE 0 END AS matched_level FROM customer LEFT JOIN k1 ON k1.nation = c_nationkey AND k1.segment = c_mktsegment LEFT JOIN k2 ON k2.nation = c_nationkey")
def cascading_key_join(spark, sf):
    cust = t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
    lookup = cust.where("c_acctbal > 8500").select("nation", "segment", F.col("c_custkey").alias("payload"))
    return R.cascading_lookup(cust, lookup, [["nation", "segment"], ["nation"]], "payload").select("c_custkey", "payload", "matched_level")


@query("WITH m AS (SELECT o_orderkey AS old, row_number() OVER (ORDER BY o_orderkey) - 1 AS new FROM orders WHERE o_orderstatus = 'F') SELECT new AS imageset_index, l_linenumber, CAST(floor(l_partkey / 4.0) * 4 + (l_partkey + 1) % 4 AS BIGINT) AS feature_id FROM lineitem JOIN m ON old = l_orderkey")
def id_remap_join(spark, sf):
    m = R.dense_index(t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "imageset_index")
    return t(spark, sf, "lineitem").join(m, "l_orderkey").select("imageset_index", "l_linenumber", S.remap_corner("l_partkey", 1).alias("feature_id"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') THEN 'rejected' ELSE o_orderstatus END AS status FROM orders")
def status_update_anti(spark, sf):
    keep = t(spark, sf, "lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("_k", F.lit(True))
    return t(spark, sf, "orders").join(keep, "o_orderkey", "left").select("o_orderkey", F.when((F.col("o_orderstatus") == "F") & F.col("_k").isNull(), "rejected").otherwise(F.col("o_orderstatus")).alias("status"))


@query("SELECT 'common' AS kind, count(*) AS n FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer) UNION ALL SELECT 'missing', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT 'either', count(*) FROM (SELECT o_custkey FROM orders UNION SELECT c_custkey FROM customer)")
def set_ops(spark, sf):
    o, k = t(spark, sf, "orders").select(F.col("o_custkey").alias("k")), t(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    n = lambda df, kind: df.agg(n_rows("n")).select(F.lit(kind).alias("kind"), "n")
    return n(o.intersect(k), "common").unionByName(n(k.subtract(o), "missing")).unionByName(n(o.union(k).distinct(), "either"))


@query("SELECT s_suppkey AS id, s_name AS name, NULL AS segment, s_acctbal AS balance FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def union_ragged(spark, sf):
    a = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    b = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT l_suppkey AS camera, coalesce(s_name, 'unknown') AS label, coalesce(n_name, 'unknown') AS machine, count(*) AS n FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL")
def manifest_lookup(spark, sf):
    per = t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("camera")).agg(n_rows("n"))  # before the join: one row per camera
    s = t(spark, sf, "supplier").join(t(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return per.join(s, F.col("s_suppkey") == F.col("camera"), "left").select("camera", F.coalesce("s_name", F.lit("unknown")).alias("label"), F.coalesce("n_name", F.lit("unknown")).alias("machine"), "n")


@query("SELECT coalesce(s.s_suppkey, c.c_custkey) AS id, coalesce(nullif(c.c_name, ''), s.s_name) AS name, coalesce(c.c_acctbal, s.s_acctbal) AS balance FROM supplier s FULL OUTER JOIN customer c ON s.s_suppkey = c.c_custkey")
def overlay_merge(spark, sf):
    s, k = t(spark, sf, "supplier"), t(spark, sf, "customer")
    return s.join(k, F.col("s_suppkey") == F.col("c_custkey"), "full_outer").select(F.coalesce("s_suppkey", "c_custkey").alias("id"), S.first_filled("c_name", "s_name").alias("name"), F.coalesce("c_acctbal", "s_acctbal").alias("balance"))


@query("SELECT p_partkey, CASE WHEN s_suppkey IS NOT NULL THEN 'id' WHEN n_nationkey IS NOT NULL THEN 'size' END AS hit, coalesce(s_name, n_name) AS target FROM part LEFT JOIN supplier ON s_suppkey = p_partkey LEFT JOIN nation ON n_nationkey = p_size WHERE s_suppkey IS NOT NULL OR n_nationkey IS NOT NULL")
def ordered_key_lookup(spark, sf):
    p, s, n = t(spark, sf, "part"), t(spark, sf, "supplier"), t(spark, sf, "nation")
    j = p.join(s, F.col("s_suppkey") == F.col("p_partkey"), "left").join(n, F.col("n_nationkey") == F.col("p_size"), "left").where("s_suppkey is not null or n_nationkey is not null")
    return j.select("p_partkey", F.when(F.col("s_suppkey").isNotNull(), "id").otherwise("size").alias("hit"), F.coalesce("s_name", "n_name").alias("target"))


# statistics and gates -------------------------------------------------------------------------


@query("WITH q AS (SELECT l_suppkey AS k, count(*) AS n, list_sort(list(l_extendedprice)) AS v FROM lineitem GROUP BY ALL), f AS (SELECT k, n, v[1 + CAST(floor(0.25 * n + 0.5) AS INT)] AS q1, v[1 + CAST(floor(0.75 * n + 0.5) AS INT)] AS q3 FROM q) SELECT k AS camera, count(*) AS kept, round(max(l_extendedprice), 6) AS worst FROM lineitem JOIN f ON k = l_suppkey WHERE n < 8 OR l_extendedprice BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1) GROUP BY k")
def iqr_outlier_filter(spark, sf):
    kept = R.fenced(t(spark, sf, "lineitem"), "l_suppkey", "l_extendedprice", 0.5)
    return kept.groupBy(F.col("l_suppkey").alias("camera")).agg(n_rows("kept"), r6(F.max("l_extendedprice"), "worst"))


@query("WITH m AS (SELECT user_id, median(value) AS med FROM events GROUP BY ALL), d AS (SELECT e.user_id, any_value(med) AS med, median(abs(value - med)) AS mad FROM events e JOIN m ON m.user_id = e.user_id GROUP BY ALL), g AS (SELECT *, greatest(5.0, med + 1.0 * 1.4826 * mad) AS gate FROM d) SELECT g.user_id, round(any_value(med), 6) AS med, round(any_value(mad), 6) AS mad, round(any_value(gate), 6) AS gate, count(*) FILTER (WHERE value <= gate) AS n_kept, round(median(value) FILTER (WHERE value <= gate), 6) AS kept_median FROM events e JOIN g ON g.user_id = e.user_id GROUP BY g.user_id")
def mad_gate(spark, sf):
    out = R.mad_gate(t(spark, sf, "events"), "user_id", "value", 1.0, 5.0)
    return out.select("user_id", "n_kept", *(r6(F.col(k), k) for k in ("med", "mad", "gate", "kept_median")))


@query("WITH e AS (SELECT l_quantity - 25 AS x, l_discount * 500 - 25 AS y FROM lineitem), b AS (SELECT CAST(floor(10 * (x / 25 + 1)) AS BIGINT) AS bx, CAST(floor(10 * (y / 25 + 1)) AS BIGINT) AS bye FROM e) SELECT bx AS bin_x, bye AS bin_y, count(*) AS n FROM b WHERE bx BETWEEN 0 AND 19 AND bye BETWEEN 0 AND 19 GROUP BY ALL")
def error_histogram_2d(spark, sf):
    b = t(spark, sf, "lineitem").select(F.floor(10 * ((F.col("l_quantity") - 25) / 25 + 1)).alias("bin_x"), F.floor(10 * ((F.col("l_discount") * 500 - 25) / 25 + 1)).alias("bin_y"))
    return b.where("bin_x between 0 and 19 and bin_y between 0 and 19").groupBy("bin_x", "bin_y").agg(n_rows("n"))


@query("SELECT l_suppkey AS camera, CAST(floor(l_quantity) AS BIGINT) AS x, least(255, count(*)) AS heat FROM lineitem GROUP BY ALL")
def running_saturating_count(spark, sf):
    return t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("camera"), F.floor("l_quantity").alias("x")).agg(F.least(F.lit(255), F.count(F.lit(1))).alias("heat"))


@query("SELECT event_type, round(exp(avg(ln(value))), 6) AS geometric_mean, round(avg(value), 6) AS mean, round(var_samp(value), 6) AS variance, count(*) AS n FROM events WHERE value > 0 GROUP BY event_type")
def moments(spark, sf):
    return t(spark, sf, "events").where("value > 0").groupBy("event_type").agg(r6(F.exp(F.avg(F.ln("value"))), "geometric_mean"), r6(F.avg("value"), "mean"), r6(F.var_samp("value"), "variance"), n_rows("n"))


@query("""WITH s AS (SELECT median(l_extendedprice) AS med, max(l_quantity) AS top, count(DISTINCT l_suppkey) AS cams, min(l_discount) AS low FROM lineitem), g AS (SELECT unnest([{'name': 'median', 'value': med, 'op': '<=', 'threshold': 40000.0}, {'name': 'top', 'value': top, 'op': '<', 'threshold': 50.0}, {'name': 'cameras', 'value': CAST(cams AS DOUBLE), 'op': '>=', 'threshold': 10.0}, {'name': 'absent', 'value': CAST(NULL AS DOUBLE), 'op': '>', 'threshold': 0.0}], recursive := true) FROM s)
SELECT name, round(value, 6) AS value, op, threshold, coalesce(CASE op WHEN '<=' THEN value <= threshold WHEN '<' THEN value < threshold WHEN '>=' THEN value >= threshold ELSE value > threshold END, false) AS passed FROM g""")
def gate_eval(spark, sf):
    li = t(spark, sf, "lineitem")
    med = table_quantile(li, "l_extendedprice", 0.5)
    s = li.agg(F.lit(med).cast("double").alias("med"), F.max("l_quantity").alias("top"), F.countDistinct("l_suppkey").alias("cams"))
    checks = [("median", F.col("med"), "<=", 40000), ("top", F.col("top"), "<", 50), ("cameras", F.col("cams"), ">=", 10), ("absent", F.lit(None), ">", 0)]
    return R.gates(s, checks).withColumn("value", F.round("value", 6))


@query("SELECT o_orderkey, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN quality = 0 THEN 'rejected' WHEN o_totalprice > 200000 THEN 'over_limit' WHEN toxic = 1 THEN 'prior' ELSE 'accepted' END AS decision FROM orders LEFT JOIN labels l ON l.doc_id = o_orderkey")
def decision_case(spark, sf):
    decision = F.when(F.col("doc_id").isNull(), "missing").when(F.col("quality") == 0, "rejected").when(F.col("o_totalprice") > 200000, "over_limit").when(F.col("toxic") == 1, "prior").otherwise("accepted")
    return t(spark, sf, "orders").join(t(spark, sf, "labels"), F.col("doc_id") == F.col("o_orderkey"), "left").select("o_orderkey", decision.alias("decision"))


@query("SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size > 45 THEN 'size' END, CASE WHEN p_retailprice < 950 THEN 'price' END], lambda x: x IS NOT NULL), ',') AS failures, CASE WHEN p_size > 45 OR p_retailprice < 950 THEN 'failed' WHEN p_size < 5 THEN 'warning' ELSE 'ok' END AS status FROM part")
def sanity_flags(spark, sf):
    bad = S.reasons((F.col("p_size") > 45, "size"), (F.col("p_retailprice") < 950, "price"))
    return t(spark, sf, "part").select("p_partkey", F.array_join(bad, ",").alias("failures"), F.when(F.size(bad) > 0, "failed").when(F.col("p_size") < 5, "warning").otherwise("ok").alias("status"))


@query("WITH d AS (SELECT c_nationkey, max(abs(c_acctbal - s_acctbal)) AS delta FROM customer JOIN supplier ON c_custkey = s_suppkey GROUP BY ALL) SELECT c_nationkey AS grp, round(delta, 6) AS delta, delta <= 3000 AS passed FROM d")
def prior_delta_gate(spark, sf):
    j = t(spark, sf, "customer").join(t(spark, sf, "supplier"), F.col("c_custkey") == F.col("s_suppkey"))
    d = j.groupBy(F.col("c_nationkey").alias("grp")).agg(F.max(F.abs(F.col("c_acctbal") - F.col("s_acctbal"))).alias("delta"))
    return d.select("grp", r6(F.col("delta"), "delta"), (F.col("delta") <= 3000).alias("passed"))


@query("SELECT l_suppkey AS camera, count(*) AS n_input, count(*) FILTER (WHERE l_returnflag = 'R') AS invalid, count(*) FILTER (WHERE l_returnflag <> 'R' AND l_extendedprice <= 50000) AS kept, count(*) FILTER (WHERE l_returnflag = 'R' OR l_extendedprice > 50000) AS removed FROM lineitem GROUP BY l_suppkey")
def gate_accounting(spark, sf):
    bad, in_ = F.col("l_returnflag") == "R", F.col("l_extendedprice") <= 50000
    return t(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("camera")).agg(n_rows("n_input"), F.count_if(bad).alias("invalid"), F.count_if(~bad & in_).alias("kept"), F.count_if(bad | ~in_).alias("removed"))


# scalars and structures -----------------------------------------------------------------------


@query("SELECT c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY regexp_replace(c_name, '\\d+', '', 'g'), CAST(regexp_extract(c_name, '(\\d+)', 1) AS BIGINT), c_name) AS pos FROM customer")
def natural_sort_rank(spark, sf):
    """Rank within the nation. Driver names share a text part, so the text and then the number order them alike."""
    w = W.partitionBy("c_nationkey").orderBy(S.natural_key("c_name"))
    return t(spark, sf, "customer").select("c_name", F.row_number().over(w).cast("bigint").alias("pos"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(CAST(json_extract_string(props, '$.absent') AS BIGINT), -1) AS absent FROM events")
def json_paths(spark, sf):
    return t(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"), S.int_or(F.get_json_object("props", "$.absent"), -1).alias("absent"))


@query("SELECT page_id, regexp_extract(replace(url, '\\', '/'), '([^/]*)$', 1) AS base, regexp_extract(url, '^(https?)://([^/]+)', 2) AS host, coalesce(try_cast(nullif(regexp_extract(url, '/(\\d+)', 1), '') AS BIGINT), page_id) AS frame_index FROM pages")
def path_functions(spark, sf):
    return t(spark, sf, "pages").select("page_id", S.basename("url").alias("base"), F.regexp_extract("url", "^(https?)://([^/]+)", 2).alias("host"), F.coalesce(F.nullif(F.regexp_extract("url", r"/(\d+)", 1), F.lit("")).try_cast("bigint"), F.col("page_id")).alias("frame_index"))


@query("SELECT event_id, round(CASE WHEN abs(value) < 50 THEN 0.5 * value * value ELSE 50 * (abs(value) - 25) END, 6) AS huber, round(CASE WHEN abs(value) < 80 THEN 6400.0 / 6 * (1 - pow(1 - (value / 80) * (value / 80), 3)) ELSE 6400.0 / 6 END, 6) AS tukey, round(0.5 * 900 * ln(1 + (value / 30) * (value / 30)), 6) AS cauchy FROM events")
def robust_loss_cost(spark, sf):
    return t(spark, sf, "events").select("event_id", F.round(S.huber("value", 50.0), 6).alias("huber"), F.round(S.tukey("value", 80.0), 6).alias("tukey"), F.round(S.cauchy("value", 30.0), 6).alias("cauchy"))


E4 = "e AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b, CAST(embedding[3] AS DOUBLE) AS c, CAST(embedding[4] AS DOUBLE) AS d FROM embeddings)"


def vec4(spark, sf):
    return t(spark, sf, "embeddings").select("vec_id", "label", *(F.element_at("embedding", k + 1).cast("double").alias(n) for k, n in enumerate("abcd")))


@query(f"WITH {E4} SELECT vec_id, round(degrees(acos(greatest(-1.0, least(1.0, (4 * d * d / (a * a + b * b + c * c + d * d) - 2) / 2)))), 4) AS angle FROM e")
def quat_rotation_angle(spark, sf):
    return vec4(spark, sf).select("vec_id", F.round(S.rotation_angle(S.quaternion_trace("a", "b", "c", "d")), 4).alias("angle"))


PIN = {"fx": 500.0, "fy": 500.0, "cx": 320.0, "cy": 240.0, "k1": 0.1, "k2": 0.01, "p1": 0.001, "p2": 0.002}


@query(f"WITH {E4}, n AS (SELECT vec_id, a / (2 + c) AS u, b / (2 + c) AS v FROM e WHERE 2 + c > 0), q AS (SELECT *, u * u + v * v AS r2 FROM n) SELECT vec_id, round(500 * (u * (1 + r2 * (0.1 + r2 * 0.01)) + 2 * 0.001 * u * v + 0.002 * (r2 + 2 * u * u)) + 320, 6) AS px, round(500 * (v * (1 + r2 * (0.1 + r2 * 0.01)) + 0.001 * (r2 + 2 * v * v) + 2 * 0.002 * u * v) + 240, 6) AS py FROM q")
def opencv_project(spark, sf):
    px, py = S.project(F.col("a"), F.col("b"), F.col("z"), PIN)
    return vec4(spark, sf).withColumn("z", 2 + F.col("c")).where("z > 0").select("vec_id", r6(px, "px"), r6(py, "py"))


@query(f"WITH {E4} SELECT x.vec_id AS id_a, y.vec_id AS id_b FROM e x JOIN e y ON x.label = y.label AND x.vec_id < y.vec_id AND sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c)) <= 0.05")
def similarity_self_join(spark, sf):
    """Radius join on a grid of cells one radius wide: each left row meets the 27 cells around it, not its whole group."""
    radius = 0.05
    e = vec4(spark, sf).withColumns({f"g{k}": F.floor(F.col(k) / radius) for k in "abc"})
    near = e
    for k in "abc":
        near = near.withColumn(f"h{k}", F.explode(F.array(*(F.col(f"g{k}") + d for d in (-1, 0, 1)))))
    x, y = near.alias("x"), e.alias("y")
    same = (F.col("x.label") == F.col("y.label")) & (F.col("x.vec_id") < F.col("y.vec_id"))
    for k in "abc":
        same &= F.col(f"x.h{k}") == F.col(f"y.g{k}")
    d = F.sqrt(sum(((F.col(f"x.{k}") - F.col(f"y.{k}")) * (F.col(f"x.{k}") - F.col(f"y.{k}")) for k in "abc"), F.lit(0.0)))
    return x.join(y, same & (d <= radius)).select(F.col("x.vec_id").alias("id_a"), F.col("y.vec_id").alias("id_b"))


@query("SELECT label, k AS component, round(median(CAST(v AS DOUBLE)), 6) AS median, count(*) AS n FROM (SELECT label, unnest(range(1, len(embedding) + 1)) AS k, unnest(embedding) AS v FROM embeddings) GROUP BY ALL")
def component_median(spark, sf):
    """The median of every component of each group's vectors."""
    long = t(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("k", "v")).select("label", (F.col("k") + 1).cast("bigint").alias("component"), F.col("v").cast("double").alias("v"))
    q = grouped_quantiles(long, ["label", "component"], {"median": ("v", 0.5)})
    return q.select("label", "component", r6(F.col("median"), "median"), "n")


NEAR = "g AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.label = y.label AND x.vec_id < y.vec_id AND sqrt((x.a - y.a) * (x.a - y.a) + (x.b - y.b) * (x.b - y.b) + (x.c - y.c) * (x.c - y.c)) <= 0.05)"


@query(f"WITH RECURSIVE {E4}, {NEAR}, u AS (SELECT a, b FROM g UNION SELECT b, a FROM g), w(n, r) AS (SELECT a, a FROM u UNION SELECT u.b, w.r FROM w JOIN u ON u.a = w.n) SELECT n AS node, min(r) AS component FROM w GROUP BY n")
def component_labels(spark, sf):
    """Components of the graph of vectors that lie close to each other."""
    return R.component_labels(similarity_self_join(spark, sf), "id_a", "id_b")


@query("SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS roles, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY conv_id")
def ordered_sequences(spark, sf):
    rows = F.sort_array(F.collect_list(F.struct("turn", "role")))
    return t(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(rows, lambda x: x["role"]), ">").alias("roles"), n_rows("turns"), F.sum(F.length("text")).alias("chars"))


@query("SELECT lo AS day, event_type, count(*) AS n FROM (SELECT date_trunc('day', ts) AS lo, event_type FROM events) GROUP BY ALL")
def stream_window_count(spark, sf):
    """The batch form of streaming.windows.counts: the same expression over the same rows."""
    from sightline.streaming.windows import counts

    return counts(t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type").select(F.col("window.start").cast("timestamp_ntz").alias("day"), "event_type", "n")
