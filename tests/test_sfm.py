"""A whole text model: round trips of all four files, and tracks that lead nowhere."""

from pyspark.sql import functions as F

from sightline.sources import sfm

IMAGES = "image_id long, qw double, qx double, qy double, qz double, tx double, ty double, tz double, camera_id long, name string, observations array<struct<x: double, y: double, point3d_id: bigint>>"
POINTS = "point3d_id long, x double, y double, z double, red int, green int, blue int, error double, track array<struct<image_id: bigint, point2d_idx: int>>"


def test_round_trip(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    cameras = spark.createDataFrame([(1, "PINHOLE", 640, 480, [1.5, 2.0]), (2, "FULL", 10, 20, [float(k) for k in range(12)]), (3, "NONE", 1, 1, [])], "camera_id long, model string, width int, height int, parameters array<double>")
    images = spark.createDataFrame([(k, 1.0, 0.0, 0.25, -0.5, 1e-7, 2.0, 3e20, k % 2, f"a/{k}.png", [(1.5 * j, -2.0, j if j % 3 else -1) for j in range(k % 4)]) for k in range(40)], IMAGES)
    points = spark.createDataFrame([(k, 0.5, k * 1.0, -1.0, 1, 2, 255, 0.125, [(j, j + 1) for j in range(k % 5)]) for k in range(30)], POINTS)
    rigs = spark.createDataFrame([(0, 2, 1, "x/"), (0, 2, 2, ""), (1, 3, 3, "ü/")], "rig int, ref_camera_id long, camera_id long, image_prefix string")
    sfm.write_cameras(cameras, at("cameras.txt"))
    sfm.write_images(images.repartition(3), at("images.txt"))
    sfm.write_points(points.repartition(3), at("points3D.txt"))
    sfm.write_rigs(rigs, at("rigs.json"))
    for want, got in ((cameras, sfm.read_cameras(spark, at("cameras.txt"))), (images, sfm.read_images(spark, at("images.txt"))), (points, sfm.read_points(spark, at("points3D.txt"))), (rigs, sfm.read_rigs(spark, at("rigs.json")))):
        assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_comments_blank_lines_and_short_files(spark, tmp_path):
    (tmp_path / "i.txt").write_text("# one\n# two\n1 1 0 0 0 0 0 0 7 a.png\n\n2 1 0 0 0 0 0 0 7 b.png\n1 2 3 4 5\n3 1 0 0 0 0 0 0 7 c.png")
    got = {r.image_id: (r.name, [tuple(o) for o in r.observations]) for r in sfm.read_images(spark, str(tmp_path / "i.txt")).collect()}
    assert got == {1: ("a.png", []), 2: ("b.png", [(1.0, 2.0, 3)]), 3: ("c.png", [])}
    (tmp_path / "p.txt").write_text("# none\n\n")
    assert sfm.read_points(spark, str(tmp_path / "p.txt")).count() == 0
    (tmp_path / "c.txt").write_text("# c\n5 SIMPLE 4 3 x 2\n")
    row = sfm.read_cameras(spark, str(tmp_path / "c.txt")).select("camera_id", F.size("parameters")).first()
    assert tuple(row) == (5, 2)


def test_references(spark):
    images = spark.createDataFrame([(1, *[0.0] * 7, 1, "a", [(1.0, 1.0, 10), (2.0, 2.0, -1), (3.0, 3.0, 11)]), (2, *[0.0] * 7, 1, "b", [])], IMAGES)
    points = spark.createDataFrame([(10, *[0.0] * 3, 0, 0, 0, 0.0, [(1, 0), (1, 1), (1, 2), (1, 9), (2, 0), (3, 0)]), (11, *[0.0] * 3, 0, 0, 0, 0.0, [])], POINTS)
    got = sorted((r.image_id, r.point2d_idx, r.status, r.x) for r in sfm.track_references(points, images).collect())
    assert got == [(1, 0, "ok", 1.0), (1, 1, "other_point", 2.0), (1, 2, "other_point", 3.0), (1, 9, "missing_observation", None), (2, 0, "missing_observation", None), (3, 0, "missing_image", None)]
