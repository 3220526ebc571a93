"""Queries on names, times, records and look-ups of the studio's files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions import records as X
from sightline.operators import lookups as L
from sightline.plans.catalog import n_rows, query, r6, t


@query("""SELECT s_suppkey, concat(lpad(CAST(s_suppkey AS VARCHAR), 6, '0'), '.png') AS image, concat('cam', lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0'), '_', s_nationkey) AS dir,
 CASE WHEN s_suppkey % 7 = 0 THEN '.tif' WHEN s_suppkey % 5 = 0 THEN '.jpg' ELSE '.png' END AS extension,
 CASE WHEN s_suppkey % 3 = 0 THEN concat('w', s_suppkey % 6, CASE WHEN s_suppkey % 6 BETWEEN 1 AND 4 THEN '_D' ELSE 'x_D' END) WHEN s_suppkey % 3 = 1 THEN 'lab_D' ELSE 'fallback' END AS machine,
 CAST(s_suppkey % 8 AS INT) AS side, CAST(s_suppkey % 4 AS INT) AS level FROM supplier""")
def name_functions(spark, sf):
    """Padded names, the first suffix among ordered fields, machine of a worker id, side and level of a label."""
    s = t(spark, sf, "supplier")
    k = F.col("s_suppkey")
    text = lambda c: c.cast("string")
    worker = F.when(k % 3 == 0, F.concat(F.lit("w"), text(k % 6), F.when((k % 6).between(1, 4), "_7").otherwise("x"))).when(k % 3 == 1, F.lit(" lab_D ")).otherwise(F.lit(""))
    label = X.side_level(F.concat_ws("-", text(k % 8), text(k % 4)))
    suffix = X.first_suffix(F.when(k % 7 == 0, F.concat(F.lit("a/b.c/x"), text(k), F.lit(".tif"))), F.when(k % 5 == 0, F.lit("d\\e.jpg")).otherwise(F.lit("plain")), F.lit("z.png"), default=".bmp")
    return s.select(
        "s_suppkey", F.concat(X.padded(k, 6), F.lit(".png")).alias("image"), F.concat(F.lit("cam"), X.padded(k % 100, 2), F.lit("_"), text(F.col("s_nationkey"))).alias("dir"),
        suffix.alias("extension"), X.machine(worker, F.lit("fallback")).alias("machine"), label["side"].alias("side"), label["level"].alias("level"),
    )


@query("""SELECT event_id, epoch_us(ts) * 1000 AS ns, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS sec, strftime(ts, '%Y_%m_%d-%H_%M_%S') AS capture, event_id % 3 <> 0 AS valid,
 CASE WHEN event_id % 3 <> 0 THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) END AS back FROM events""")
def time_functions(spark, sf):
    """Seconds and nanoseconds to one stamp, capture ids to times; an id that is none is null."""
    e = t(spark, sf, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    stamp = X.stamp_ns(F.floor(us / 1_000_000).cast("bigint"), F.pmod(us, F.lit(1_000_000)) * 1000)
    capture = F.date_format("ts", "yyyy_MM_dd-HH_mm_ss")
    parsed = X.capture_time(F.when(F.col("event_id") % 3 != 0, capture).otherwise(F.concat(F.lit("x"), capture)))
    return e.select("event_id", stamp.alias("ns"), F.floor(stamp / 1_000_000_000).cast("bigint").alias("sec"), capture.alias("capture"), parsed.isNotNull().alias("valid"), F.unix_seconds(parsed.cast("timestamp")).alias("back"))


@query("""WITH k AS (SELECT conv_id, list(turn ORDER BY turn) AS ts, list(length(text) ORDER BY turn) AS ls FROM conversations GROUP BY conv_id)
SELECT conv_id, array_to_string(list_transform(range(len(ts)), lambda i: concat(ts[i + 1], '=', ls[i + 1] * 2)), ';') AS doubled, CAST(coalesce(list_sum(list_filter(ls, lambda v, i: i % 3 = 0)), 0) AS BIGINT) AS thirds, CAST(len(ls) // 3 AS BIGINT) AS n_points, CAST(CASE WHEN len(ls) >= 3 THEN ls[3] END AS BIGINT) AS first_z FROM k""")
def token_functions(spark, sf):
    """key:value text to a map and back, every third token, a flat array as points."""
    c = t(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.length("text").alias("l")))).alias("rows"))
    pairs = F.array_join(F.transform("rows", lambda r: F.concat(r["turn"].cast("string"), F.lit(" : "), r["l"].cast("string"))), " , ")
    lengths = F.transform("rows", lambda r: r["l"].cast("bigint"))
    m = X.label_map(pairs)
    keys = F.array_sort(F.transform(F.map_keys(m), lambda k: k.cast("int")))
    points = X.points_of(lengths)
    return c.select(
        "conv_id", F.array_join(F.transform(keys, lambda k: F.concat(k.cast("string"), F.lit("="), (F.element_at(m, k.cast("string")) * 2).cast("string"))), ";").alias("doubled"),
        F.aggregate(X.every_third(lengths), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("thirds"), F.size(points).cast("bigint").alias("n_points"), F.get(F.get(points, F.lit(0)), F.lit(2)).alias("first_z"),
    )


@query("""WITH f AS (SELECT event_id, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_id, printf('%.6f', value) AS six, CASE WHEN k % 2 = 0 THEN printf('%.2f', value) ELSE '' END AS two_or_blank, CAST(k AS VARCHAR) AS k_text,
 round(127 + 127 * sin(atan2(value, k)), 6) AS red, round(127 + 127 * cos(atan2(value, k)), 6) AS green, round(least(1.0, sqrt(value * value + k * k) / 100), 6) AS magnitude,
 round(greatest(0.0, least(1.0, ln(1 + abs(value)) / ln(11))), 6) AS residual_colour, CAST((77 * k + 150 * (k * 2 % 256) + 29 * (k * 3 % 256)) >> 8 AS BIGINT) AS luma,
 CASE WHEN k % 5 = 0 THEN 'Infinity' ELSE CAST(round(sqrt(value * value + pow(abs(ln((1 + k) / 50.0)) * 0.25 * 480, 2)), 4) AS VARCHAR) END AS motion FROM f""")
def number_functions(spark, sf):
    """Numbers as text, error and residual colours, luma, board motion between two views."""
    e = t(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    k, v = F.col("k"), F.col("value")
    direction, magnitude = X.direction_colour(k.cast("double"), v), X.magnitude_factor(k.cast("double"), v, 100.0)
    motion = X.board_motion((F.when(k % 5 == 0, None).otherwise(v), F.lit(0.0), (1 + k).cast("double")), (F.lit(0.0), F.lit(0.0), F.lit(50.0)), 640, 480)
    return e.select(
        "event_id", X.fixed(v, 6).alias("six"), X.fixed(F.when(k % 2 == 0, v), 2).alias("two_or_blank"), F.coalesce(k.cast("string"), F.lit("")).alias("k_text"), r6(direction[0], "red"), r6(direction[1], "green"), r6(magnitude, "magnitude"),
        r6(X.residual_colour(F.abs(v)), "residual_colour"), X.luma(k, k * 2 % 256, k * 3 % 256).alias("luma"), F.when(motion == float("inf"), "Infinity").otherwise(F.round(motion, 4).cast("string")).alias("motion"),
    )


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'vertical4' WHEN s_suppkey % 4 = 1 THEN 'horizontal4' ELSE 'grid2x2' END AS layout,
 CAST(CASE WHEN s_suppkey % 4 = 0 THEN 3 * (400 // 4) WHEN s_suppkey % 4 = 1 THEN 0 ELSE 60 + s_suppkey // 2 END AS BIGINT) AS top, CAST(CASE WHEN s_suppkey % 4 = 0 THEN 100 WHEN s_suppkey % 4 = 1 THEN 400 ELSE 121 + s_suppkey END AS BIGINT) AS "right" FROM supplier WHERE s_suppkey < 50""")
def tile_grid(spark, sf):
    """The last of four tiles of packed frames whose layout follows from their size."""
    s = t(spark, sf, "supplier").where("s_suppkey < 50")
    k = F.col("s_suppkey")
    width = F.when(k % 4 == 0, 100).when(k % 4 == 1, 400).otherwise(121 + k)
    height = F.when(k % 4 == 0, 400).when(k % 4 == 1, 100).otherwise(120 + k - k % 2)
    layout = X.layout(width, height)
    last = F.element_at(X.tiles(layout, width, height), 4)
    return s.select("s_suppkey", layout.alias("layout"), last["top"].cast("bigint").alias("top"), last["right"].cast("bigint").alias("right"))


TARGET = dict(faces=8, rows=16, columns=2, tag_size=0.08, spacing=0.02, face_width=0.4, first_tag=0, stride=32)


@query("""WITH g AS (SELECT f, r, c, f * 32 + r * 2 + c AS tag, 2 * pi() * f / 8 AS th, (c - 0.5) * 0.1 AS u, (r - 7.5) * 0.1 AS z FROM range(8) a(f), range(16) b(r), range(2) d(c)), k(corner, du, dz) AS (VALUES (0, -1, -1), (1, 1, -1), (2, 1, 1), (3, -1, 1))
SELECT CAST(tag * 4 + corner AS BIGINT) AS feature, CAST(f AS BIGINT) AS face, round(cos(th) * 0.2 / tan(pi() / 8) - sin(th) * (u + du * 0.04), 6) AS x, round(sin(th) * 0.2 / tan(pi() / 8) + cos(th) * (u + du * 0.04), 6) AS y, round(CAST(z + dz * 0.04 AS DOUBLE), 6) AS z, n FROM g, k JOIN (SELECT l_partkey % 1100 AS feature, count(*) AS n FROM lineitem GROUP BY ALL) s ON s.feature = tag * 4 + corner""")
def target_geometry(spark, sf):
    """Corner points of the faceted target, made from its layout, that lines see, and how many do."""
    seen = t(spark, sf, "lineitem").groupBy((F.col("l_partkey") % 1100).alias("feature")).agg(n_rows("n"))
    return seen.join(F.broadcast(L.target_points(spark, **TARGET)), "feature").select("feature", "face", r6(F.col("x"), "x"), r6(F.col("y"), "y"), r6(F.col("z"), "z"), "n")


@query("""WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey - 100 AS feature FROM lineitem), d AS (SELECT *, CAST(floor(feature / 4.0) AS BIGINT) AS tag FROM f)
SELECT tag BETWEEN 0 AND 255 AS valid, CASE WHEN tag BETWEEN 0 AND 255 THEN tag // 32 END AS face, CASE WHEN tag BETWEEN 0 AND 255 THEN tag % 32 // 2 END AS grid_row, CASE WHEN tag BETWEEN 0 AND 255 THEN tag % 2 END AS grid_col, CASE WHEN tag BETWEEN 0 AND 255 THEN feature % 4 END AS corner, count(*) AS n FROM d GROUP BY ALL""")
def feature_fields(spark, sf):
    """Tag, corner, face and grid place of feature ids; ids outside the target have none. Kept apart by the target's valid ids."""
    f = X.feature_fields(F.col("l_partkey") - 100, **{k: TARGET[k] for k in ("faces", "rows", "columns", "first_tag", "stride")})
    d = t(spark, sf, "lineitem").select(f.alias("f"))
    return d.groupBy(F.col("f.tag").isNotNull().alias("valid"), F.col("f.face").alias("face"), F.col("f.row").alias("grid_row"), F.col("f.column").alias("grid_col"), F.col("f.corner").alias("corner")).agg(n_rows("n"))


@query("""WITH r AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS after_residual_px, CASE WHEN event_id % 2 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS residual_norm_px, CASE WHEN event_id % 5 = 0 THEN CAST(event_id AS VARCHAR) END AS reprojection_error_px, CASE WHEN event_id % 7 = 0 THEN 'nan' ELSE '0.5' END AS norm_px, CAST(event_id % 50 AS VARCHAR) AS corner_norm_px FROM events),
p AS (SELECT *, CASE WHEN event_id % 3 <> 0 THEN 'after_residual_px' WHEN event_id % 2 = 1 THEN 'residual_norm_px' WHEN event_id % 5 = 0 THEN 'reprojection_error_px' WHEN event_id % 7 <> 0 THEN 'norm_px' ELSE 'corner_norm_px' END AS by_value FROM r)
SELECT event_id, 'after_residual_px' AS by_presence, by_value, round(CAST(CASE by_value WHEN 'after_residual_px' THEN after_residual_px WHEN 'residual_norm_px' THEN residual_norm_px WHEN 'reprojection_error_px' THEN reprojection_error_px WHEN 'norm_px' THEN norm_px ELSE corner_norm_px END AS DOUBLE), 6) AS residual FROM p""")
def residual_columns(spark, sf):
    """The residual column by presence in the schema, and per row by the first finite value, suffixes after names."""
    k = F.col("event_id")
    e = t(spark, sf, "events").select(
        "event_id", (k % 50).cast("string").alias("corner_norm_px"), F.when(k % 7 == 0, "nan").otherwise("0.5").alias("norm_px"), F.when(k % 5 == 0, k.cast("string")).alias("reprojection_error_px"),
        F.when(k % 2 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("residual_norm_px"), F.when(k % 3 != 0, F.col("value").cast("string")).alias("after_residual_px"),
    )
    picked = X.residual_value(e.columns)
    return e.select("event_id", F.lit(X.residual_column(e.columns)).alias("by_presence"), picked["column"].alias("by_value"), r6(picked["value"], "residual"))


@query("""WITH d AS (SELECT l_orderkey % 50 AS camera, strftime(l_shipdate, '%Y') AS time, l_partkey AS frame, l_linenumber AS seq, l_quantity AS payload FROM lineitem), s AS (SELECT o_custkey % 50 AS camera, strftime(o_orderdate, '%Y') AS time, o_orderkey % 2000 AS frame, max_by(o_orderpriority, o_orderkey) AS chosen, max(o_orderkey) AS out_frame FROM orders GROUP BY ALL)
SELECT camera, time, frame, seq, payload, chosen, out_frame FROM d JOIN s USING (camera, time, frame)""")
def selected_merge(spark, sf):
    """Detections whose (camera, time, frame) is selected, with the last selected row's fields."""
    d = t(spark, sf, "lineitem").select((F.col("l_orderkey") % 50).alias("camera"), F.date_format("l_shipdate", "yyyy").alias("time"), F.col("l_partkey").alias("frame"), F.col("l_linenumber").alias("seq"), F.col("l_quantity").alias("payload"))
    s = t(spark, sf, "orders").select((F.col("o_custkey") % 50).alias("camera"), F.date_format("o_orderdate", "yyyy").alias("time"), (F.col("o_orderkey") % 2000).alias("frame"), F.col("o_orderpriority").alias("chosen"), F.col("o_orderkey").alias("out_frame"))
    return L.merge_last(d, s, ["camera", "time", "frame"], "out_frame")


@query("""WITH g AS (SELECT DISTINCT l_suppkey AS cam, l_linenumber AS frame, l_partkey AS feature, CAST(round(l_extendedprice, 9) AS DECIMAL(28, 9)) AS x, CAST(round(l_discount, 9) AS DECIMAL(28, 9)) AS y FROM lineitem WHERE l_returnflag = 'A')
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN g.cam IS NULL THEN 'no' ELSE 'yes' END AS used_after_gate, count(*) AS n FROM lineitem LEFT JOIN g ON cam = l_suppkey AND frame = l_linenumber AND feature = l_partkey AND x = CAST(round(l_extendedprice + 1e-11, 9) AS DECIMAL(28, 9)) AND y = CAST(round(l_discount, 9) AS DECIMAL(28, 9)) GROUP BY ALL""")
def gate_membership(spark, sf):
    """Which observations survived the gate: by frame, camera, feature and coordinates to nine decimals."""
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_linenumber").alias("frame"), F.col("l_suppkey").alias("cam"), F.col("l_partkey").alias("feature"), F.col("l_extendedprice").alias("x"), F.col("l_discount").alias("y"), "l_returnflag")
    out = L.flag_members(li.withColumn("x", F.col("x") + 1e-11), li.where("l_returnflag = 'A'"), ["frame", "cam", "feature"], ["x", "y"], "used_after_gate")
    return out.groupBy("l_orderkey", "l_linenumber", "l_partkey", "used_after_gate").agg(n_rows("n"))


@query("""WITH l AS (SELECT concat('rec/', s_suppkey * 3) AS path FROM supplier UNION ALL SELECT concat('mnt/', s_suppkey * 2) FROM supplier), c AS (SELECT p_partkey, unnest([concat('rec/', p_partkey), concat('mnt/', p_partkey), concat('dir/', p_size)]) AS path, unnest([1, 2, 3]) AS rank FROM part)
SELECT p_partkey, coalesce(min_by(path, rank) FILTER (WHERE path IN (SELECT path FROM l)), NULL) AS found, min_by(path, rank) AS unchecked FROM c GROUP BY p_partkey""")
def source_candidates(spark, sf):
    """The first existing path of recorded, mounted and manifest ones; unchecked: the first at all."""
    s = t(spark, sf, "supplier")
    name = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    listing = s.select(name("rec/", F.col("s_suppkey") * 3).alias("path")).unionByName(s.select(name("mnt/", F.col("s_suppkey") * 2).alias("path")))
    p = t(spark, sf, "part").withColumn("paths", F.array(name("rec/", F.col("p_partkey")), name("mnt/", F.col("p_partkey")), name("dir/", F.col("p_size"))))
    return L.first_existing(p, listing, "p_partkey", "paths", "path").select("p_partkey", "found", "unchecked")


@query("""WITH a AS (SELECT user_id, date_trunc('hour', ts) AS h, min(value) AS va FROM events WHERE event_type = 'click' GROUP BY ALL), b AS (SELECT user_id, date_trunc('hour', ts) AS h, max(value) AS vb FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT user_id, h AS hour, va, vb FROM a JOIN b USING (user_id, h) WHERE h >= TIMESTAMP '2024-01-02 00:00:00'""")
def log_pair(spark, sf):
    """Two logs joined on their common key and trimmed to a window; a bound of 0 is none."""
    e = t(spark, sf, "events").withColumn("hour", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz"))
    a = e.where("event_type = 'click'").groupBy("user_id", "hour").agg(F.min("value").alias("va"))
    b = e.where("event_type = 'view'").groupBy("user_id", "hour").agg(F.max("value").alias("vb"))
    seconds = F.unix_seconds(F.col("hour").cast("timestamp"))
    return L.trimmed_pair(a, b, ["user_id", "hour"], seconds, 1704153600, 0)


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN concat('inner-', c_nationkey) ELSE concat('outer-', c_nationkey) END AS label, CASE WHEN c_custkey % 3 = 0 THEN coalesce(n_name, 'none') ELSE coalesce(s_name, 'none') END AS quality
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 20 LEFT JOIN supplier ON s_suppkey = c_nationkey AND s_suppkey < 15""")
def label_lookup(spark, sf):
    """A label's prefix selects the table that is looked up; a label that it lacks gets the default."""
    c = t(spark, sf, "customer").withColumn("label", F.concat(F.when(F.col("c_custkey") % 3 == 0, "inner-").otherwise("outer-"), F.col("c_nationkey").cast("string")))
    inner = t(spark, sf, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("quality"))
    outer = t(spark, sf, "supplier").where("s_suppkey < 15").select(F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("quality"))
    return L.prefixed_lookup(c, "label", {"inner-": inner, "outer-": outer}, "key", "quality", "none").select("c_custkey", "label", "quality")


@query("SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority AS filename, round(l_quantity, 4) AS error FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_quantity <= 10")
def checked_views(spark, sf):
    """Views joined to the images they index; an index or a file name that doesn't fit is an error, a poor view is dropped."""
    views = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("error"))
    images = t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("filename"))
    views = views.join(images, "l_orderkey", "left").withColumn("filename", F.coalesce("filename", F.lit("lost")))
    return L.checked_join(views, images, ["l_orderkey"], "filename").where("error <= 10").select("l_orderkey", "l_linenumber", "l_partkey", "filename", F.round("error", 4).alias("error"))


@query("SELECT o_custkey AS camera, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y-%m'), o_orderkey) - 1 AS out_index, concat(lpad(CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y-%m'), o_orderkey) - 1 AS VARCHAR), 6, '0'), '.png') AS name FROM orders")
def camera_numbering(spark, sf):
    """Each camera's images numbered from 0 in order of time and frame."""
    n = (F.row_number().over(W.partitionBy("o_custkey").orderBy(F.date_format("o_orderdate", "yyyy-MM"), "o_orderkey")) - 1).cast("bigint")
    return t(spark, sf, "orders").select(F.col("o_custkey").alias("camera"), "o_orderkey", n.alias("out_index")).withColumn("name", F.concat(X.padded(F.col("out_index"), 6), F.lit(".png")))


@query("""WITH v AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id)
SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents JOIN v USING (doc_id) WHERE n_chars > 0 AND quality = 1 QUALIFY place <= 200""")
def numeric_order(spark, sf):
    """The 200 largest by number, nulls left out: two sorts merged from the tasks, no sort of the table."""
    good = t(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
    top = t(spark, sf, "documents").join(good, "doc_id").where("n_chars > 0").orderBy(F.desc("n_chars"), "doc_id").limit(200)
    return top.select("doc_id", F.row_number().over(W.orderBy(F.desc("n_chars"), "doc_id")).cast("bigint").alias("place"))


@query("""WITH f AS (SELECT conv_id, turn, concat('img_', lpad(CAST(turn AS VARCHAR), 4, '0'), CASE WHEN role = 'user' THEN '.jpg' ELSE '.png' END) AS name FROM conversations)
SELECT conv_id, coalesce(min(name) FILTER (WHERE name LIKE 'img_0003.%'), min(name) FILTER (WHERE name LIKE '%_0001.png'), list(name ORDER BY name)[CAST(least(3, count(*) - 1) AS BIGINT) + 1]) AS image FROM f GROUP BY conv_id""")
def frame_lookup(spark, sf):
    """A frame's image: by ordered patterns, else by its clamped place in the sorted list."""
    name = F.concat(F.lit("img_"), X.padded(F.col("turn"), 4), F.when(F.col("role") == "user", ".jpg").otherwise(".png"))
    return L.frame_image(t(spark, sf, "conversations").select("conv_id", name.alias("name")), "conv_id", "name", [r"^img_0003\..*$", r"^.*_0001\.png$"], 3)


@query("WITH u AS (SELECT c_nationkey AS v, c_custkey AS seq, 0 AS part FROM customer UNION ALL SELECT s_nationkey + 20, s_suppkey, 1 FROM supplier), f AS (SELECT v, min((part, seq)) AS first FROM u GROUP BY v) SELECT CAST(v AS INT) AS v, row_number() OVER (ORDER BY first) - 1 AS place FROM f")
def unique_append(spark, sf):
    """Two lists appended, each value kept once at its first place."""
    a = t(spark, sf, "customer").select(F.col("c_nationkey").alias("v"), F.col("c_custkey").alias("seq"))
    b = t(spark, sf, "supplier").select((F.col("s_nationkey") + 20).alias("v"), F.col("s_suppkey").alias("seq"))
    first = L.unique_append([a, b], "v", "seq")
    return first.select("v", (F.row_number().over(W.orderBy("part", "seq")) - 1).cast("bigint").alias("place"))


@query("SELECT user_id, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) AS span_us, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 0")
def stream_span(spark, sf):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return t(spark, sf, "events").groupBy("user_id").agg((F.max(us) - F.min(us)).alias("span_us"), n_rows("n"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN p_size WHEN p_size % 4 = 1 THEN CAST(floor(p_retailprice) AS INT) ELSE 1920 END AS width, CASE WHEN p_size % 4 = 0 THEN p_size + 1 WHEN p_size % 4 = 1 THEN 480 ELSE 1080 END AS height FROM part""")
def size_defaults(spark, sf):
    """An image size from an array, else from two columns, else the default; numbers that aren't positive don't count."""
    s = F.col("p_size")
    pair = F.when(s % 4 == 0, F.array(s, s + 1)).when(s % 4 == 3, F.array(s * -1, s))
    out = X.size_or(pair.cast("array<double>"), F.when(s % 4 == 1, F.col("p_retailprice").cast("int")).cast("double"), F.lit(480.0), 1920.0, 1080.0)
    return t(spark, sf, "part").select("p_partkey", out["width"].cast("int").alias("width"), out["height"].cast("int").alias("height"))


@query("""WITH s AS (SELECT conv_id FROM conversations UNION SELECT item_id + 90 FROM benchmark), i AS (SELECT conv_id, true AS there, turn // 2 AS frame, role = 'user' AND length(text) % 5 <> 0 AS image FROM conversations),
g AS (SELECT s.conv_id, coalesce(bool_or(there), false) AS there, count(*) FILTER (WHERE image) AS n, count(DISTINCT frame) FILTER (WHERE image) AS ids, min(frame) FILTER (WHERE image) AS lo, max(frame) FILTER (WHERE image) AS hi FROM s LEFT JOIN i USING (conv_id) GROUP BY s.conv_id),
m AS (SELECT *, max(n) OVER () - n AS short FROM g),
r AS (SELECT conv_id, CAST(n AS BIGINT) AS frames, CAST(short AS BIGINT) AS tail_short, CASE WHEN NOT there THEN 'image_dir_missing' WHEN n = 0 THEN 'no_images' WHEN lo <> 0 OR hi + 1 <> ids THEN 'non_contiguous_or_missing_interior_frames' WHEN short = 0 THEN 'ok' WHEN short <= 2 THEN concat('tail_trim_', short) ELSE 'short_sequence_not_tail_trim' END AS reason FROM m)
SELECT *, CASE WHEN reason = 'ok' OR reason LIKE 'tail_trim%' THEN 'usable' ELSE 'unusable' END AS status FROM r""")
def session_gate(spark, sf):
    """Listed sessions: is the folder there, has it images, do their ids run from 0 without a gap, and how many are missing at the end; the reasons by precedence."""
    c = t(spark, sf, "conversations").select("conv_id", F.floor(F.col("turn") / 2).alias("frame"), ((F.col("role") == "user") & (F.length("text") % 5 != 0)).alias("image"))
    listed = c.select("conv_id").union(t(spark, sf, "benchmark").select(F.col("item_id") + 90)).distinct()
    frame = F.when(F.col("image"), F.col("frame"))
    g = c.groupBy("conv_id").agg(F.count(frame).alias("n"), F.min(frame).alias("lo"), F.max(frame).alias("hi"), F.countDistinct(frame).alias("ids"), F.lit(True).alias("there"))
    g = listed.join(g, "conv_id", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "there": F.coalesce("there", F.lit(False))})
    short = F.col("most") - F.col("n")
    reason = X.session_reason(F.col("there"), F.col("n"), (F.col("lo") == 0) & (F.col("hi") + 1 == F.col("ids")), short, 2)
    out = g.crossJoin(F.broadcast(g.agg(F.max("n").alias("most")))).select("conv_id", F.col("n").alias("frames"), short.alias("tail_short"), reason.alias("reason"))
    return out.withColumn("status", F.when((F.col("reason") == "ok") | F.col("reason").startswith("tail_trim"), "usable").otherwise("unusable"))


@query("""WITH g AS (SELECT c_nationkey AS nation, count(*) AS n, count(*) FILTER (WHERE c_acctbal > 0) AS connected, list(c_name ORDER BY c_name) FILTER (WHERE c_acctbal <= 0) AS lost FROM customer GROUP BY c_nationkey)
SELECT n_nationkey AS nation, CASE WHEN n IS NULL THEN 'empty_summary' WHEN connected < n THEN 'disconnected_cameras' WHEN n <> 60 THEN 'connected_unexpected_camera_count' ELSE 'all_connected' END AS status, coalesce(array_to_string(lost, ','), '') AS labels FROM nation LEFT JOIN g ON nation = n_nationkey""")
def connectivity_status(spark, sf):
    """Is every camera connected, and which are not."""
    c = t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(n_rows("n"), F.count_if(F.col("c_acctbal") > 0).alias("connected"), F.array_join(F.sort_array(F.collect_list(F.when(F.col("c_acctbal") <= 0, F.col("c_name")))), ",").alias("labels"))
    out = t(spark, sf, "nation").select(F.col("n_nationkey").alias("nation")).join(c, "nation", "left")
    status = F.when(F.col("n").isNull(), "empty_summary").when(F.col("connected") < F.col("n"), "disconnected_cameras").when(F.col("n") != 60, "connected_unexpected_camera_count").otherwise("all_connected")
    return out.select("nation", status.alias("status"), F.coalesce("labels", F.lit("")).alias("labels"))


@query("""WITH m AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'fixed' WHEN 1 THEN 'per_camera_fxfycxcy' ELSE 'per_camera_opencv5' END AS mode, s_suppkey % 5 <> 0 AS pose, abs(s_acctbal) / 250000 AS focal, s_suppkey % 13 AS principal, (s_suppkey % 10) * 0.03 AS distortion FROM supplier),
k AS (SELECT *, focal <= 0.02 AND principal <= 8 AND (mode <> 'per_camera_opencv5' OR distortion <= 0.151) AS kept FROM m)
SELECT s_suppkey, CASE WHEN mode = 'fixed' THEN 'fixed_prior' WHEN NOT pose THEN 'pose_prior_intrinsics_prior' WHEN kept THEN 'accepted_refined' ELSE 'rejected_to_prior' END AS decision,
  CASE WHEN mode = 'fixed' THEN 'intrinsics_refine_mode_fixed' WHEN NOT pose THEN 'pose_not_accepted' WHEN kept THEN 'passes_acceptance_gate' ELSE 'intrinsic_delta_exceeds_acceptance_gate' END AS reason FROM k""")
def parameter_acceptance(spark, sf):
    """Refined parameters: fixed mode first, then the pose, then delta limits, of which one that is not positive is off."""
    key = F.col("s_suppkey")
    mode = F.when(key % 4 == 0, "fixed").when(key % 4 == 1, "per_camera_fxfycxcy").otherwise("per_camera_opencv5")
    out = X.accepted_parameters(mode, key % 5 != 0, F.abs("s_acctbal") / 250000, key % 13, key % 10 * 0.03, (0.02, 8.0, 0.151))
    return t(spark, sf, "supplier").select("s_suppkey", out["decision"].alias("decision"), out["reason"].alias("reason"))


@query("""SELECT s_suppkey, CASE WHEN n >= 50 THEN 'strong' WHEN n >= 10 THEN 'usable' WHEN n > 0 THEN 'weak' ELSE 'inactive' END AS selected, CASE WHEN n >= 500 THEN 'strong' WHEN n >= 50 THEN 'usable' WHEN n > 0 THEN 'weak' ELSE 'inactive' END AS final FROM (SELECT s_suppkey, (s_suppkey * 37 % 101) * (s_suppkey % 12) AS n FROM supplier)""")
def coverage_tiers(spark, sf):
    """Coverage by the threshold sets of selected frames and of final residuals."""
    n = F.col("s_suppkey") * 37 % 101 * (F.col("s_suppkey") % 12)
    return t(spark, sf, "supplier").select("s_suppkey", X.tier(n, 50, 10).alias("selected"), X.tier(n, 500, 50).alias("final"))


@query("SELECT count(*) AS n, 'within bounds' AS verdict FROM part")
def bounds_assertion(spark, sf):
    """Every part's size within bounds; a value outside would stop the query and be listed."""
    return L.assert_bounds(t(spark, sf, "part"), "p_partkey", "p_size", 0, 100)
