"""Text models of structure from motion: cameras, images with their observations, rigs and points with their tracks.

A model is a folder of cameras.txt, images.txt, points3D.txt and rigs.json, each a file or a folder of part
files. Lines stay split over tasks; an image's two lines meet in a join on their numbers. Words that are
no numbers where one belongs are null: filters on what is read may be tried on other lines too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightline.sources.files import _lines

POSE = ("qw", "qx", "qy", "qz", "tx", "ty", "tz")
RIGS = "array<struct<ref_camera_id: bigint, cameras: array<struct<camera_id: bigint, image_prefix: string>>>>"


def _words(line: Column) -> Column:
    return F.filter(F.split(F.trim(line), r"\s+"), lambda w: w != "")


def _told(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor comments, as words."""
    rows = spark.read.text(path).where("trim(value) <> '' and not startswith(value, '#')")
    return rows.select(_words(F.col("value")).alias("w"))


def _number(k: int, kind: str = "double") -> Column:
    return F.get("w", F.lit(k)).try_cast(kind)


def _once(x: Column, f) -> Column:
    """f of x, which is bound as the element of an array of one, so that it isn't worked out for every use."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _places(size: Column, of: int) -> Column:
    """0 .. size / of - 1."""
    return F.sequence(F.lit(0), F.floor(size / of).cast("int") - 1)


def read_cameras(spark: SparkSession, path: str) -> DataFrame:
    """camera_id, model, width, height and parameters (array of double)."""
    return _told(spark, path).select(_number(0, "bigint").alias("camera_id"), F.get("w", F.lit(1)).alias("model"), _number(2, "int").alias("width"), _number(3, "int").alias("height"), F.transform(F.slice("w", 5, F.greatest(F.size("w") - 4, F.lit(0))), lambda v: v.try_cast("double")).alias("parameters"))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """image_id, pose, camera_id, name and observations (array of x, y, point3d_id; -1 for a point that isn't triangulated).

    Comments stand at the head of a file only, and the line after an image's own holds its
    observations, be it blank. An image that lacks it has none.
    """
    lines = _lines(spark, path)
    comments = lines.where("startswith(line, '#')").groupBy("source_file").agg(F.count(F.lit(1)).alias("_c"))
    numbered = lines.where("not startswith(line, '#')").join(comments, "source_file", "left").withColumn("_n", F.col("source_offset") - F.coalesce("_c", F.lit(0)))
    head = numbered.where("_n % 2 = 0 and trim(line) <> ''").select("source_file", (F.col("_n") + 1).alias("_n"), _words(F.col("line")).alias("w"))
    tail = numbered.where("_n % 2 = 1").select("source_file", "_n", _words(F.col("line")).alias("p"))
    both = head.join(tail, ["source_file", "_n"], "left")
    at = lambda p, k, j, kind: F.get(p, k * 3 + j).try_cast(kind)
    seen = lambda p: F.transform(_places(F.size(p), 3), lambda k: F.struct(at(p, k, 0, "double").alias("x"), at(p, k, 1, "double").alias("y"), at(p, k, 2, "bigint").alias("point3d_id")))
    none = F.array().cast("array<struct<x: double, y: double, point3d_id: bigint>>")
    observations = _once(F.coalesce("p", F.array().cast("array<string>")), lambda p: F.when(F.size(p) >= 3, seen(p)).otherwise(none))
    return both.select(_number(0, "bigint").alias("image_id"), *(_number(k).alias(n) for k, n in enumerate(POSE, 1)), _number(8, "bigint").alias("camera_id"), F.get("w", F.lit(9)).alias("name"), observations.alias("observations"))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """point3d_id, x, y, z, colour (red, green, blue), error and track (array of image_id, point2d_idx)."""
    each = lambda w, k: F.struct(F.get(w, 8 + k * 2).try_cast("bigint").alias("image_id"), F.get(w, 9 + k * 2).try_cast("int").alias("point2d_idx"))
    none = F.array().cast("array<struct<image_id: bigint, point2d_idx: int>>")
    track = _once(F.col("w"), lambda w: F.when(F.size(w) >= 10, F.transform(_places(F.size(w) - 8, 2), lambda k: each(w, k))).otherwise(none))
    return _told(spark, path).select(_number(0, "bigint").alias("point3d_id"), *(_number(k).alias(c) for k, c in enumerate("xyz", 1)), *(_number(k, "int").alias(c) for k, c in enumerate(("red", "green", "blue"), 4)), _number(7).alias("error"), track.alias("track"))


def read_rigs(spark: SparkSession, path: str) -> DataFrame:
    """rig (from 0), ref_camera_id, camera_id and image_prefix, a row per camera of a rig. The file is one document."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", RIGS).alias("r"))
    rigs = text.select(F.posexplode("r").alias("rig", "r"))
    return rigs.select("rig", F.col("r.ref_camera_id").alias("ref_camera_id"), F.explode("r.cameras").alias("c")).select("rig", "ref_camera_id", "c.camera_id", "c.image_prefix")


def _text(*columns: Column | str) -> Column:
    return F.concat_ws(" ", *((F.col(c) if isinstance(c, str) else c).cast("string") for c in columns))


def write_cameras(cameras: DataFrame, path: str) -> None:
    parameters = F.array_join(F.col("parameters").cast("array<string>"), " ")
    cameras.select(F.rtrim(_text("camera_id", "model", "width", "height", parameters)).alias("value")).write.mode("overwrite").text(path)


def write_images(images: DataFrame, path: str) -> None:
    seen = F.array_join(F.transform("observations", lambda o: _text(o["x"], o["y"], o["point3d_id"])), " ")
    images.select(F.concat_ws("\n", _text("image_id", *POSE, "camera_id", "name"), F.coalesce(seen, F.lit(""))).alias("value")).write.mode("overwrite").text(path)


def write_points(points: DataFrame, path: str) -> None:
    track = F.array_join(F.transform("track", lambda e: _text(e["image_id"], e["point2d_idx"])), " ")
    points.select(F.rtrim(_text("point3d_id", "x", "y", "z", "red", "green", "blue", "error", F.coalesce(track, F.lit("")))).alias("value")).write.mode("overwrite").text(path)


def write_rigs(rigs: DataFrame, path: str) -> None:
    """Rows as read_rigs gives them. The format is one document: a list of rigs, each of a rig's few cameras."""
    per = rigs.groupBy("rig", "ref_camera_id").agg(F.array_sort(F.collect_list(F.struct("camera_id", "image_prefix"))).alias("cameras"))
    one = per.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("rig", "ref_camera_id", "cameras"))), lambda r: F.struct(r["ref_camera_id"].alias("ref_camera_id"), r["cameras"].alias("cameras"))).alias("r"))
    one.select(F.to_json("r").alias("value")).coalesce(1).write.mode("overwrite").text(path)


def track_references(points: DataFrame, images: DataFrame) -> DataFrame:
    """Each element of each track with its observation: point3d_id, image_id, point2d_idx, x, y, and status.

    ok, missing_image, missing_observation (no such number in the image), or other_point if the
    observation names another point or none.
    """
    tracks = points.select("point3d_id", F.explode("track").alias("t")).select("point3d_id", F.col("t.image_id").alias("image_id"), F.col("t.point2d_idx").alias("point2d_idx"))
    seen = images.select("image_id", F.posexplode("observations").alias("point2d_idx", "o")).select("image_id", "point2d_idx", F.col("o.x").alias("x"), F.col("o.y").alias("y"), F.col("o.point3d_id").alias("_named"))
    there = images.select("image_id", F.lit(True).alias("_there")).distinct()
    both = tracks.join(seen, ["image_id", "point2d_idx"], "left").join(there, "image_id", "left")
    status = F.when(F.col("_there").isNull(), "missing_image").when(F.col("_named").isNull(), "missing_observation").when(F.col("_named") != F.col("point3d_id"), "other_point").otherwise("ok")
    return both.select("point3d_id", "image_id", "point2d_idx", "x", "y", status.alias("status"))
