"""Edge cases of the operators, kernels, sources and streams on small inputs."""

import struct

import pytest
from pyspark.sql import functions as F

from sightline.functions import kernels as K
from sightline.functions import scalars as S
from sightline.operators import relational as R
from sightline.sources import calib, files
from sightline.streaming import windows


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_coercion(spark):
    df = spark.createDataFrame([("7",), (" 8",), ("x",), ("nan",), ("inf",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(S.int_or("s", -1)).collect()] == [7, 8, -1, -1, -1, -1, -1]
    assert [r[0] for r in df.select(S.finite("s")).collect()] == [7.0, 8.0, None, None, None, None, None]
    t = spark.createDataFrame([("Yes ",), ("ok",), ("0",), (None,)], "s string")
    assert [tuple(r) for r in t.select(S.truthy("s"), S.truthy("s", False)).collect()] == [(True, True), (True, False), (False, False), (False, False)]


def test_floored_remap_and_natural_order(spark):
    assert [r[0] for r in spark.createDataFrame([(0,), (7,), (-1,)], "i long").select(S.remap_corner("i", 1)).collect()] == [1, 4, -4]
    names = ["cam10", "cam2", "", "2b", "10a", "b"]
    df = spark.createDataFrame([(n,) for n in names], "s string").orderBy(S.natural_key("s"))
    assert [r[0] for r in df.collect()] == ["", "2b", "10a", "b", "cam2", "cam10"]


def test_range_list(spark):
    assert spark.createDataFrame([("0-3,7, 2",)], "s string").select(S.range_list("s")).first()[0] == [0, 1, 2, 3, 7]
    with pytest.raises(Exception, match="descending"):
        spark.createDataFrame([("3-0",)], "s string").select(S.range_list("s")).collect()


def test_nearest_ties_and_empty(spark):
    left = spark.createDataFrame([("a", 10, 1), ("a", 15, 2), ("b", 5, 3)], "k string, t long, id long")
    right = spark.createDataFrame([("a", 8, 100), ("a", 12, 101), ("a", 12, 102)], "k string, t long, id long")
    got = R.nearest_in_time(left, right, ["k"], "t", "id").select("id", "match_id", "delta")
    assert values(got)[:2] == [(1, 100, 2), (2, 101, 3)]
    assert R.nearest_in_time(left, right.limit(0), ["k"], "t", "id", 5).count() == 0


def test_cascade_skips_ambiguous(spark):
    fact = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "a long, b string")
    lookup = spark.createDataFrame([(1, "x", "p"), (1, "x", "q"), (2, "x", "r")], "a long, b string, v string")
    got = values(R.cascading_lookup(fact, lookup, [["a", "b"], ["a"]], "v").select("a", "v", "matched_level"))
    assert got == [(1, None, 0), (2, "r", 2), (3, None, 0)]


def test_components_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 30)] + [(100, 101)], "a long, b long")
    got = dict(values(R.component_labels(edges)))
    assert all(got[i] == 1 for i in range(1, 31)) and got[101] == 100


def test_kernels_recover(spark):
    pts = [(0, float(i), float(i * i % 7), float(i * 3 % 5)) for i in range(12)]
    df = spark.createDataFrame(pts, "k long, a double, b double, c double").withColumns({"x": -2 * F.col("b") + 1, "y": 2 * F.col("a") - 3, "z": 2 * F.col("c") + 5})
    r = K.umeyama(df, "k", ["a", "b", "c"], ["x", "y", "z"]).first()
    assert r.scale == pytest.approx(2) and r.translation == pytest.approx([1, -3, 5]) and r.rotation[:3] == pytest.approx([0, -1, 0])
    flat = spark.createDataFrame([(0, float(i), float(i % 3), 2.0) for i in range(9)], "k long, a double, b double, c double")
    assert tuple(K.plane_normal(flat, "k", ["a", "b", "c"]).first())[1:] == pytest.approx((0, 0, 1))
    q = spark.createDataFrame([(0, 0.1, 0.0, 0.0, 1.0), (0, -0.1, 0.0, 0.0, 1.0)], "k long, x double, y double, z double, w double")
    assert tuple(K.mean_rotation(q, "k", list("xyzw")).first())[1:] == pytest.approx((0, 0, 0, 1))


def test_calib_round_trip(spark, tmp_path):
    tables = {"cameras": [(0, 640, 480), (1, 800, 600)], "imagesets": [(0, "a"), (1, "bé")], "features": [(0, 0, 0, 1.5, 2.5, 7), (1, 1, 0, 3.0, 4.0, 8)], "geometry": [(0, 7, 8, 9, None, None, None, 0.5), (0, 9, None, None, 1.0, 2.0, 3.0, 0.5)]}
    raw = calib.encode(tables)
    assert calib.decode(raw) == tables
    with pytest.raises(ValueError):
        calib.decode(raw + b"x")
    (tmp_path / "d.bin").write_bytes(raw)
    spark.dataSource.register(calib.CalibDataSource)
    assert values(spark.read.format("calib").option("table", "features").load(str(tmp_path / "d.bin"))) == tables["features"]
    old = raw[:10] + struct.pack("<I", 0) + raw[14:]
    with pytest.raises(ValueError):
        calib.decode(old)


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\nbad\n{"x": 2}\n')
    assert sorted(r.x for r in files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "x int", strict=False).collect()) == [1, 2]
    assert tuple(files.count_jsonl(spark, str(tmp_path / "a.jsonl")).first()) == (3, 1)
    with pytest.raises(Exception):  # noqa: B017
        files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "x int").collect()
    (tmp_path / "t.tsv").write_text("a\tb\n1\t\n2\tz\n")
    assert values(files.read_tsv(spark, str(tmp_path / "t.tsv"), ["a", "b", "c"]).drop("source_file")) == [("1", None, None), ("2", "z", None)]
    assert files.read_tsv_or_empty(spark, str(tmp_path / "none.tsv"), ["a"]).count() == 0
    (tmp_path / "log").write_text("x_src1_a: 5 features\nx_src1_a: 6 features\nx_src2_b: 7 features\n")
    assert values(files.read_feature_log(spark, str(tmp_path / "log"))) == [(1, 6), (2, 7)]
    (tmp_path / "images.txt").write_text("# c\n1 1 0 0 0 1 2 3 5 left.png\n1.0 2.0 -1 3.0 4.0 17\n2 1 0 0 0 1 2 3 5 r.png\n\n")
    got = files.read_sfm_images(spark, str(tmp_path / "images.txt")).select("image_id", "name", "point2d_count", "triangulated_point_count")
    assert values(got) == [(1, "left.png", 2, 1), (2, "r.png", 0, 0)]


def test_streams_equal_batch(spark, tmp_path):
    rows = [(k % 3, f"2024-01-0{1 + k % 5} 00:00:{k % 60:02d}", k, float((k * 37) % 100)) for k in range(60)]
    df = spark.createDataFrame(rows, "user_id long, ts string, event_id long, value double").withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    picked = windows.selector(stream, "user_id", "ts", "event_id", "value", 20.0, 5)
    q = picked.writeStream.format("memory").queryName("picked").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = values(spark.table("picked").groupBy("user_id").agg(F.count_if(F.col("reason") == "selected"), F.count_if(F.col("reason") == "near_duplicate"), F.count_if(F.col("reason") == "max_selected")))
    assert got == values(R.greedy_selection(df, "user_id", ["ts", "event_id"], "value", 20.0, 5))
    counted = windows.counts(stream, "ts", "user_id")
    q = counted.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert values(spark.table("counted")) == values(windows.counts(df, "ts", "user_id"))


def test_yaml_poses_and_clouds(spark, tmp_path):
    assert files.simple_yaml("a: 1\nb: 2.5 # c\nc: true\nd: 'x y'\n\n# e: 1") == {"a": 1, "b": 2.5, "c": True, "d": "x y"}
    df = spark.createDataFrame([(2, 1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 1.0), (0, 4.0, 5.0, 6.0, 0.0, 0.0, 1.0, 0.0)], "index int, tx double, ty double, tz double, qx double, qy double, qz double, qw double")
    files.write_poses(df.coalesce(1), str(tmp_path / "poses"))
    got = files.read_poses(spark, str(tmp_path / "poses"), 3)
    assert [(r["index"], r.tx, r.used) for r in got.orderBy("index").collect()] == [(0, 4.0, True), (1, None, False), (2, 1.0, True)]
    (tmp_path / "c.ply").write_text(files.ply([(1.0, 2.0, 3.0), (4.0, 5.0, 6.5)]))
    assert values(files.read_ply(spark, str(tmp_path / "c.ply"))) == [(1.0, 2.0, 3.0), (4.0, 5.0, 6.5)]
    (tmp_path / "m.mlp").write_text('<MeshLabProject><MeshGroup><MLMesh label="a" filename="a.ply"><MLMatrix44>1 0 0 0</MLMatrix44></MLMesh></MeshGroup></MeshLabProject>')
    assert values(files.read_mesh_project(spark, str(tmp_path / "m.mlp"))) == [("a", "a.ply", "1 0 0 0")]


def test_calib_save(spark, tmp_path):
    cams = spark.createDataFrame([(0, 4, 5)], calib.TABLES["cameras"])
    sets = spark.createDataFrame([(0, "n")], calib.TABLES["imagesets"])
    feats = spark.createDataFrame([(0, 0, 0, 1.0, 2.0, 3)], calib.TABLES["features"])
    calib.save(str(tmp_path / "o.bin"), cameras=cams, imagesets=sets, features=feats)
    assert calib.decode((tmp_path / "o.bin").read_bytes())["features"] == [(0, 0, 0, 1.0, 2.0, 3)]


def test_dense_index(spark):
    df = spark.createDataFrame([(k * 7919 % 1000,) for k in range(300)], "k long").distinct()
    want = {k: n for n, k in enumerate(sorted(r.k for r in df.collect()))}
    assert {r.k: r.i for r in R.dense_index(df, "k", "i", 8).collect()} == want
