"""Queries that write the studio's file formats below the shared folder and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions.records import RESIDUAL_KEYS, RESIDUAL_SUFFIXES
from sightline.functions.shared import checkpoint_dir
from sightline.operators import lookups as L
from sightline.plans.catalog import n_rows, query, r6, t
from sightline.sources import calib, files, sfm


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}/{name}"


def text_of(frame, path: str) -> None:
    frame.write.mode("overwrite").text(path)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS camera, s_name AS name, CAST(NULL AS VARCHAR) AS user_id, CASE WHEN s_suppkey % 2 = 0 THEN 'w1' ELSE 'w2' END AS worker FROM supplier")
def tsv_tables(spark, sf):
    """Two workers' tables read as one, with the file each row is from; a column that a file lacks is null."""
    s = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("camera"), F.col("s_name").alias("name"), F.lit(1).alias("extra"))
    base = folder(spark, "")
    for worker, odd in (("w1", 0), ("w2", 1)):
        files.write_tsv(s.where(F.col("camera") % 2 == odd), f"{base}{worker}", ["camera", "name", "extra"] if odd else None)
    got = [files.read_tsv(spark, f"{base}{w}", ["camera", "name", "user_id"]) for w in ("w1", "w2")]
    return got[0].unionByName(got[1]).select("camera", "name", "user_id", F.regexp_extract("source_file", "/(w[0-9])/", 1).alias("worker"))


@query("SELECT c_custkey AS camera, c_name AS name, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS source_file FROM customer")
def missing_table(spark, sf):
    """A table whose file isn't there has no rows, so what is looked up in it is null for every camera."""
    absent = files.read_tsv_or_empty(spark, folder(spark, "absent.tsv"), ["camera", "status"])
    cameras = t(spark, sf, "customer").select(F.col("c_custkey").alias("camera"), F.col("c_name").alias("name"))
    return cameras.join(absent.withColumn("camera", F.col("camera").cast("long")), "camera", "left").select("camera", "name", "status", "source_file")


@query("SELECT o_orderkey AS frame, o_orderpriority AS name, 1 AS good FROM orders WHERE o_orderkey < 2000")
def json_lines(spark, sf):
    """Selected rows as JSON lines with their origin inside; blank lines are skipped, bad ones dropped."""
    o = t(spark, sf, "orders").where("o_orderkey < 2000").select(F.col("o_orderkey").alias("frame"), F.col("o_orderpriority").alias("name"), F.col("o_custkey").alias("source_line"))
    base = folder(spark, "rows")
    files.write_jsonl(o, base, {"source_line": "line"})
    bad = spark.createDataFrame([("{broken",), ("",), ("[",)], "value string")
    text_of(spark.read.text(base).unionByName(bad), f"{base}-more")
    return files.read_jsonl(spark, f"{base}-more", "frame long, name string, _selected struct<line:long>", strict=False).select("frame", "name", F.col("_selected.line").isNotNull().cast("int").alias("good"))


@query("SELECT count(*) + 2 AS scanned, CAST(2 AS BIGINT) AS malformed FROM nation")
def json_line_counts(spark, sf):
    base = folder(spark, "rows")
    lines = t(spark, sf, "nation").select(F.to_json(F.struct("n_nationkey", "n_name")).alias("value")).unionByName(spark.createDataFrame([("{broken",), (" ",), ("]",)], "value string"))
    text_of(lines, base)
    return files.count_jsonl(spark, base)


@query("SELECT p_partkey AS tag, round(p_retailprice, 4) AS residual FROM part WHERE p_partkey % 5 <> 0")
def json_records(spark, sf):
    """Residual records found by descent in nested documents, one document per brand."""
    p = t(spark, sf, "part").withColumn("r", F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice").cast("string")))
    inner = F.struct(F.lit("x").alias("kind"), F.sort_array(F.collect_list(F.struct(F.col("p_partkey").alias("tag"), F.col("r").alias("reprojection_error_px")))).alias("rows"))
    docs = p.groupBy("p_brand").agg(F.to_json(F.struct(F.struct(inner.alias("deep")).alias("outer"))).alias("value"))
    base = folder(spark, "docs")
    docs.repartition(8, "p_brand").groupBy(F.spark_partition_id()).agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(base)
    got = files.read_json_records(spark, base, RESIDUAL_KEYS, RESIDUAL_SUFFIXES)
    return got.select(F.col("record")["tag"].cast("bigint").alias("tag"), F.round(F.col("record")["reprojection_error_px"].cast("double"), 4).alias("residual"))


@query("SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS place, s_name AS camera_id FROM supplier")
def manifest_order(spark, sf):
    """Cameras in the order of their index, whatever the rows' order."""
    base = folder(spark, "manifest")
    s = t(spark, sf, "supplier").orderBy(F.desc("s_name")).select(F.col("s_suppkey").alias("camera_index"), F.col("s_name").alias("camera_id")).coalesce(1)
    files.write_tsv(s, base, ["camera_index", "camera_id"])
    return files.read_manifest(spark, base, ["camera_index", "camera_id"]).select(F.col("place").cast("bigint").alias("place"), "camera_id")


@query("SELECT n_nationkey AS grp, concat('{\"connected\":null,\"grp\":', n_nationkey, ',\"n\":', (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey), '}') AS text FROM nation")
def summary_file(spark, sf):
    """A summary per group as JSON with sorted keys."""
    n = t(spark, sf, "nation").select(F.col("n_nationkey").alias("grp"))
    c = t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("grp")).agg(n_rows("n"))
    base = folder(spark, "summary")
    files.write_summary(n.join(c, "grp", "left").select("grp", F.coalesce("n", F.lit(0)).alias("n"), F.lit(None).cast("string").alias("connected")), base)
    return spark.read.text(base).select(F.get_json_object("value", "$.grp").cast("int").alias("grp"), F.col("value").alias("text"))


_V = lambda k: F.element_at("embedding", k).cast("double")


@query("SELECT vec_id AS stamp, round(CAST(embedding[1] AS DOUBLE), 6) AS tx, round(CAST(embedding[7] AS DOUBLE), 6) AS qw, (SELECT count(*) FROM embeddings) AS n FROM embeddings")
def trajectory_file(spark, sf):
    e = t(spark, sf, "embeddings").select("vec_id", *(_V(k).alias(f"v{k}") for k in range(1, 8)))
    base = folder(spark, "trajectory")
    text_of(e.select(F.concat_ws(" ", *(F.col(c).cast("string") for c in e.columns)).alias("value")).unionByName(spark.createDataFrame([("# stamp and pose",), ("",)], "value string")), base)
    n = files.count_entries(spark, base)
    return files.read_trajectory(spark, base).crossJoin(F.broadcast(n)).select(F.col("stamp").cast("bigint").alias("stamp"), r6(F.col("tx"), "tx"), r6(F.col("qw"), "qw"), "n")


@query("SELECT CAST(k AS INT) AS \"index\", round(CAST(embedding[1] AS DOUBLE), 6) AS tx, vec_id IS NOT NULL AS used FROM range(60) r(k) LEFT JOIN embeddings ON vec_id = k AND k % 3 <> 0")
def pose_file(spark, sf):
    """Poses written and read; indices that the file lacks are unused."""
    e = t(spark, sf, "embeddings").where("vec_id < 60 and vec_id % 3 <> 0").select(F.col("vec_id").alias("index"), *(_V(k).alias(n) for k, n in enumerate(files.POSE[1:], 1)))
    base = folder(spark, "poses")
    files.write_poses(e.coalesce(1), base)
    return files.read_poses(spark, base, 60).select("index", r6(F.col("tx"), "tx"), "used")


@query("SELECT vec_id AS image_id, concat('cam', vec_id % 8, '.png') AS name, round(CAST(embedding[2] AS DOUBLE), 6) AS tx, CAST(3 AS INT) AS point2d_count, CAST(CASE WHEN vec_id % 2 = 0 THEN 3 ELSE 2 END AS INT) AS triangulated_point_count FROM embeddings")
def sfm_model(spark, sf):
    """Images of a text model: poses, and how many of their points are triangulated."""
    e = t(spark, sf, "embeddings").select(F.col("vec_id").alias("image_id"), *(_V(k).alias(n) for k, n in ((4, "qw"), (5, "qx"), (6, "qy"), (7, "qz"), (2, "tx"), (3, "ty"), (1, "tz"))), (F.col("vec_id") % 8).alias("camera_id"), F.concat(F.lit("cam"), (F.col("vec_id") % 8).cast("string"), F.lit(".png")).alias("name"))
    point = lambda k, lost: F.struct(F.lit(1.5 + k).alias("x"), F.lit(2.5).alias("y"), F.when(lost, -1).otherwise(k).alias("id"))
    base = folder(spark, "images")
    files.write_sfm_images(e.withColumn("points", F.array(point(7, F.lit(False)), point(8, F.col("image_id") % 2 == 1), point(9, F.lit(False)))), base)
    return files.read_sfm_images(spark, base).select("image_id", "name", r6(F.col("tx"), "tx"), "point2d_count", "triangulated_point_count")


@query("SELECT CAST(p_partkey AS INT) AS feature_id, round(p_size * 0.5, 4)::DOUBLE AS x, -1.25::DOUBLE AS y, p_partkey * 1e-3::DOUBLE AS z FROM part WHERE p_partkey <= 300")
def points_file(spark, sf):
    """A points file: a flat list, and which feature each point is."""
    p = t(spark, sf, "part").where("p_partkey <= 300").groupBy().agg(F.sort_array(F.collect_list(F.struct("p_partkey", "p_size"))).alias("rows"))
    flat = F.flatten(F.transform("rows", lambda r: F.array((r["p_size"] * 0.5).cast("string"), F.lit("-1.25"), F.format_string("%.3f", r["p_partkey"] * 0.001))))
    pairs = F.transform("rows", lambda r, i: F.concat(F.lit("  - feature_id: "), r["p_partkey"].cast("string"), F.lit("\n    point_index: "), i.cast("string")))
    base = folder(spark, "points")
    text_of(p.select(F.concat(F.lit("points: ["), F.array_join(flat, ", "), F.lit("]\nfeature_id_to_point_index:\n"), F.array_join(pairs, "\n")).alias("value")), base)
    got = files.read_points(spark, base)
    return got.select("feature_id", F.round("x", 4).alias("x"), "y", "z")


@query("SELECT c_nationkey AS camera_index, CASE WHEN c_nationkey % 3 = 0 THEN concat('intrinsics', c_nationkey, '.yaml') WHEN c_nationkey % 3 = 1 THEN concat('intrinsics', c_nationkey, '_a.yaml') END AS file, CASE WHEN c_nationkey % 3 < 2 THEN CAST(640 + count(*) AS INT) END AS width, CASE WHEN c_nationkey % 3 = 0 THEN 0.5 * max(c_custkey) WHEN c_nationkey % 3 = 1 THEN 0.25 * max(c_custkey) END::DOUBLE AS first FROM customer GROUP BY c_nationkey")
def camera_model_files(spark, sf):
    """Camera models read, and each camera's file resolved: by its exact name, else the first with its prefix. A camera is the customers of a nation; their number and largest key make its model."""
    k = F.col("camera_index")
    cameras = t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("camera_index")).agg(n_rows("n"), F.max("c_custkey").alias("top"))
    tails = F.when(k % 3 == 0, F.expr("map('', 0.5D, '_a', 0.25D)")).when(k % 3 == 1, F.expr("map('_b', 1.0D, '_a', 0.25D)"))
    rows = cameras.select(k, "n", "top", F.explode(tails).alias("tail", "share"))
    model = F.format_string("type : CentralOpenCVModel\nwidth : %d\nheight : 480\nparameters : [%s, 1e2, -3]", F.col("n") + 640, (F.col("share") * F.col("top")).cast("string"))
    base = folder(spark, "")
    rows.select(F.concat(F.lit("intrinsics"), k.cast("string"), "tail", F.lit(".yaml")).alias("name"), model.alias("value")).write.partitionBy("name").text(base)
    # a folder name=<file name> holds each file
    models = files.read_camera_models(spark, f"{base}name=*").withColumn("path", F.regexp_replace(F.regexp_extract("source_file", "^(.*)/[^/]*$", 1), "/name=([^/]*)$", "/$1"))
    found = files.intrinsics_paths(models, cameras.select(k))
    return found.join(models, F.col("intrinsics") == F.col("path"), "left").select("camera_index", F.regexp_extract("intrinsics", "([^/]*)$", 1).alias("file"), "width", F.get("parameters", F.lit(0)).alias("first"))


@query("SELECT concat(k, '_', CASE k % 4 WHEN 0 THEN 'frame_residuals' WHEN 1 THEN 'corner_error' WHEN 2 THEN 'camera_table' ELSE 'residual' END, '.tsv') AS name FROM (SELECT o_orderkey AS k FROM orders) WHERE k % 4 < 2 AND k <> 4")
def residual_files(spark, sf):
    """Files whose names mark residual tables, of a listing with one for each order."""
    base = folder(spark, "")
    kinds = ("frame_residuals", "corner_error", "camera_table", "residual")
    k = F.col("o_orderkey")
    listing = t(spark, sf, "orders").select(F.concat(F.lit(base), k.cast("string"), F.lit("_"), F.element_at(F.array(*map(F.lit, kinds)), (k % 4 + 1).cast("int")), F.lit(".tsv")).alias("path"))
    return L.candidate_residual_files(listing, "path", {"4_frame_residuals.tsv"}).select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"))


@query("SELECT vec_id // 50 AS n_file, CAST(count(*) AS BIGINT) AS points, round(sum(CAST(embedding[1] AS DOUBLE)), 4) AS total FROM embeddings GROUP BY ALL")
def cloud_files(spark, sf):
    """Point clouds as OBJ vertices, one folder for each 50 points, discovered and read."""
    e = t(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 50).alias("k"), *(_V(k).alias(n) for k, n in ((1, "x"), (2, "y"), (3, "z"))))
    base = folder(spark, "")
    files.write_obj(e.withColumns({"time": (F.col("k") % 7).cast("string"), "cam": F.col("k")}), base, ["time", "cam"])
    found = files.discover(spark, base, r"\.txt$")
    rows = spark.read.option("recursiveFileLookup", True).text(base).select(F.col("_metadata.file_path").alias("file"), F.split("value", " ").alias("v"))
    per = rows.groupBy(F.regexp_extract("file", "/cam=([0-9]+)/", 1).cast("bigint").alias("n_file")).agg(n_rows("points"), F.round(F.sum(F.get("v", F.lit(1)).cast("double")), 4).alias("total"))
    return per.join(found.select(F.regexp_extract("camera", "([0-9]+)$", 1).cast("bigint").alias("n_file")).distinct(), "n_file")


@query("SELECT CAST(dense_rank() OVER (ORDER BY o_orderkey) - 1 AS INT) AS imageset_index, CAST(k AS INT) AS camera_index, CAST(o_custkey * 4 + k AS INT) AS feature_id, (o_orderkey * 0.5)::DOUBLE AS x FROM orders, range(2) r(k) WHERE o_orderkey < 40")
def dataset_file(spark, sf):
    """The binary dataset format, written and read through the data source."""
    o = t(spark, sf, "orders").where("o_orderkey < 40")
    nth = (F.dense_rank().over(W.orderBy("o_orderkey")) - 1).cast("int")
    sets = o.select(nth.alias("imageset_index"), F.concat(F.lit("set"), F.col("o_orderkey").cast("string")).alias("filename"), "o_orderkey", "o_custkey")
    cameras = spark.createDataFrame([(0, 640, 480), (1, 800, 600)], calib.TABLES["cameras"])
    features = sets.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("camera_index")).select(
        "imageset_index", "camera_index", F.lit(0).alias("feature_pos"), (F.col("o_orderkey") * 0.5).cast("float").alias("x"), F.lit(1.5).cast("float").alias("y"), (F.col("o_custkey") * 4 + F.col("camera_index")).cast("int").alias("feature_id")
    )
    base = f"{checkpoint_dir(spark)}/dataset-{uuid.uuid4().hex}.bin"
    calib.save(base, cameras=cameras, imagesets=sets.select("imageset_index", "filename"), features=features)
    spark.dataSource.register(calib.CalibDataSource)
    got = spark.read.format("calib").option("table", "features").load(base)
    return got.select("imageset_index", "camera_index", "feature_id", F.col("x").cast("double").alias("x"))


_SEEN = "s AS (SELECT l_orderkey % 400 AS image_id, row_number() OVER (PARTITION BY l_orderkey % 400 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS idx, l_partkey AS point, l_quantity AS x FROM lineitem)"


@query(f"""WITH {_SEEN}, t AS (SELECT point, CASE WHEN point % 50 = 0 THEN image_id + 1000 ELSE image_id END AS image_id, CASE WHEN point % 50 = 1 THEN idx + 100000 WHEN point % 50 = 2 THEN (idx + 1) % 5 ELSE idx END AS idx FROM s),
j AS (SELECT t.point, CASE WHEN t.image_id >= 1000 THEN 'missing_image' WHEN s.point IS NULL THEN 'missing_observation' WHEN s.point <> t.point THEN 'other_point' ELSE 'ok' END AS status, s.x FROM t LEFT JOIN s ON s.image_id = t.image_id AND s.idx = t.idx)
SELECT point AS point3d_id, count(*) AS track, count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'missing_image') AS missing_image, count(*) FILTER (WHERE status = 'missing_observation') AS missing_observation, count(*) FILTER (WHERE status = 'other_point') AS other_point, round(coalesce(sum(x) FILTER (WHERE status = 'ok'), 0), 4) AS total FROM j GROUP BY point""")
def sfm_tracks(spark, sf):
    """A model of images that see lines of orders and of points with their tracks, written and read; some tracks lead nowhere."""
    w = W.partitionBy("image_id").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    s = t(spark, sf, "lineitem").withColumn("image_id", F.col("l_orderkey") % 400).select("image_id", (F.row_number().over(w) - 1).alias("idx"), F.col("l_partkey").alias("point"), F.col("l_quantity").alias("x"))
    pose = {"qw": 1.0, "qx": 0.0, "qy": 0.0, "qz": 0.0, "tx": 0.5, "ty": -1.25, "tz": 2.0}
    seen = F.transform(F.array_sort(F.collect_list(F.struct("idx", "x", "point"))), lambda o: F.struct(o["x"].alias("x"), F.lit(1.5).alias("y"), o["point"].alias("point3d_id")))
    images = s.groupBy("image_id").agg(seen.alias("observations")).withColumns({**{k: F.lit(v) for k, v in pose.items()}, "camera_id": F.col("image_id") % 8, "name": F.concat(F.lit("cam/"), F.col("image_id").cast("string"), F.lit(".png"))})
    image = F.when(F.col("point") % 50 == 0, F.col("image_id") + 1000).otherwise(F.col("image_id"))
    idx = F.when(F.col("point") % 50 == 1, F.col("idx") + 100_000).when(F.col("point") % 50 == 2, (F.col("idx") + 1) % 5).otherwise(F.col("idx"))
    points = s.groupBy(F.col("point").alias("point3d_id")).agg(F.collect_list(F.struct(image.alias("image_id"), idx.alias("point2d_idx"))).alias("track")).withColumns({**{k: F.lit(0.25) for k in ("x", "y", "z", "error")}, **{k: F.lit(7) for k in ("red", "green", "blue")}})
    base = folder(spark, "model")
    sfm.write_images(images, f"{base}/images.txt")
    sfm.write_points(points, f"{base}/points3D.txt")
    got = sfm.track_references(sfm.read_points(spark, f"{base}/points3D.txt"), sfm.read_images(spark, f"{base}/images.txt"))
    of = lambda k: F.count_if(F.col("status") == k).alias(k)
    return got.groupBy("point3d_id").agg(n_rows("track"), of("ok"), of("missing_image"), of("missing_observation"), of("other_point"), F.round(F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("x"))), F.lit(0.0)), 4).alias("total"))


@query("SELECT s_suppkey AS camera_id, CASE WHEN s_suppkey % 2 = 0 THEN 'PINHOLE' ELSE 'OPENCV' END AS model, CAST(640 + s_nationkey AS INT) AS width, CAST(480 AS INT) AS height, CASE WHEN s_suppkey % 2 = 0 THEN 2 ELSE 8 END::INT AS parameters, round(s_acctbal, 2) AS first, CAST(dense_rank() OVER (ORDER BY s_nationkey) - 1 AS INT) AS rig, min(s_suppkey) OVER (PARTITION BY s_nationkey) AS ref_camera_id, concat('cam', s_suppkey, '/') AS image_prefix FROM supplier")
def sfm_cameras_and_rigs(spark, sf):
    """Cameras with parameters of any number, and a rig for each nation's, written and read."""
    s = t(spark, sf, "supplier")
    even = F.col("s_suppkey") % 2 == 0
    values = F.array_repeat(F.round("s_acctbal", 2), F.when(even, 2).otherwise(8))
    cameras = s.select(F.col("s_suppkey").alias("camera_id"), F.when(even, "PINHOLE").otherwise("OPENCV").alias("model"), (640 + F.col("s_nationkey")).alias("width"), F.lit(480).alias("height"), values.alias("parameters"))
    nations = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("ref_camera_id"))
    ranks = nations.select("s_nationkey", "ref_camera_id", (F.dense_rank().over(W.orderBy("s_nationkey")) - 1).alias("rig"))  # one row per nation
    rigs = s.join(F.broadcast(ranks), "s_nationkey").select("rig", "ref_camera_id", F.col("s_suppkey").alias("camera_id"), F.concat(F.lit("cam"), F.col("s_suppkey").cast("string"), F.lit("/")).alias("image_prefix"))
    base = folder(spark, "rigs")
    sfm.write_cameras(cameras, f"{base}/cameras.txt")
    sfm.write_rigs(rigs, f"{base}/rigs.json")
    both = sfm.read_cameras(spark, f"{base}/cameras.txt").join(sfm.read_rigs(spark, f"{base}/rigs.json"), "camera_id")
    return both.select("camera_id", "model", "width", "height", F.size("parameters").alias("parameters"), F.get("parameters", F.lit(0)).alias("first"), "rig", "ref_camera_id", "image_prefix")
