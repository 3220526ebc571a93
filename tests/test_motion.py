"""Poses, cameras, kernels and quantiles against numpy, and the checks that stop a query."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.functions import cameras as C
from sightline.functions import kernels as K
from sightline.functions import poses as P
from sightline.functions import records as X
from sightline.functions import scalars as S
from sightline.operators import lookups as L
from sightline.operators import motion as M
from sightline.operators import relational as R
from sightline.operators.quantiles import grouped_quantiles, table_quantile
from sightline.streaming import ingest


def table(spark, n=40, seed=1):
    r = np.random.default_rng(seed)
    q = r.normal(size=(n, 4))
    q /= np.linalg.norm(q, axis=1)[:, None]
    rows = [(k, *map(float, q[k]), *map(float, r.normal(size=3))) for k in range(n)]
    return spark.createDataFrame(rows, "id int, qx double, qy double, qz double, qw double, tx double, ty double, tz double"), q


def matrix(q):
    x, y, z, w = q
    k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    return np.eye(3) + 2 * w * k + 2 * k @ k


def test_pose_algebra(spark):
    df, qs = table(spark)
    pose = M.pose()
    nothing = P.compose(pose, P.invert(pose))
    m = P.to_matrix(M.rotation())
    back = P.from_matrix(m)
    out = df.select("id", F.array(*m).alias("m"), F.array(*back).alias("b"), F.array(*P.log(P.exp(M.position()))).alias("w"), F.array(*nothing[0], *nothing[1]).alias("e"), F.array("tx", "ty", "tz").alias("t")).collect()
    for r in out:
        assert np.allclose(np.array(r.m).reshape(3, 3), matrix(qs[r.id]))
        assert np.allclose(r.b, qs[r.id] * np.sign(qs[r.id][3]))
        assert np.linalg.norm(r.t) > np.pi or np.allclose(r.w, r.t)
        assert np.allclose(r.e, [0, 0, 0, np.sign(r.e[3]), 0, 0, 0])
    half = df.select(P.angle(M.rotation(), P.slerp(M.rotation(), (F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), F.lit(0.5))).alias("a"), P.angle(M.rotation(), (F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).alias("b")).collect()
    assert all(abs(2 * r.a - r.b) < 1e-6 for r in half)


def test_pose_of_half_turns(spark):
    for q in ([1.0, 0, 0, 0], [0, 1.0, 0, 0], [0, 0, 1.0, 0], [0, 0, 0, 1.0]):
        m = matrix(q).ravel()
        got = spark.range(1).select(F.array(*P.from_matrix([F.lit(float(x)) for x in m])).alias("q")).first().q
        assert np.allclose(np.abs(got), np.abs(q))


def test_rig_and_completion(spark):
    r = np.random.default_rng(5)
    cams = {c: (lambda q: q / np.linalg.norm(q))(r.normal(size=4)) for c in range(5)}
    spots = {c: r.normal(size=3) for c in cams}
    rows = []
    for frame in range(6):
        for c in cams:
            if c < 4:
                rows.append((frame, c, *map(float, cams[c]), *map(float, spots[c])))
    rows.append((9, 4, *map(float, cams[4]), *map(float, spots[4])))
    df = spark.createDataFrame(rows, "frame int, cam int, " + ", ".join(f"{k} double" for k in M.POSE))
    rig = {x.camera: x for x in M.rig_from_edges(M.pair_edges(df, "frame", "cam"), 0).collect()}
    for c in range(1, 4):
        want = matrix(cams[0]).T @ (spots[c] - spots[0])
        assert rig[c].reached and np.allclose([rig[c].tx, rig[c].ty, rig[c].tz], want)
    assert 4 not in rig  # shares no frame


def test_unproject_inverts_project(spark):
    r = np.random.default_rng(2)
    pts = [tuple(map(float, (*r.normal(size=2), 1 + abs(r.normal())))) for _ in range(50)]
    model = {"fx": 300.0, "fy": 310.0, "cx": 5.0, "cy": 6.0, "k1": 0.01, "k2": -0.002, "k3": 0.0003, "k4": 0.0}
    df = spark.createDataFrame(pts, "x double, y double, z double")
    px, py = S.project_equidistant(F.col("x"), F.col("y"), F.col("z"), model)
    got = df.select("*", px.alias("px"), py.alias("py")).select("x", "y", "z", F.array(*C.unproject_equidistant(F.col("px"), F.col("py"), model)).alias("d")).collect()
    for g in got:
        v = np.array([g.x, g.y, g.z])
        assert np.allclose(g.d, v / np.linalg.norm(v), atol=1e-9)


def test_rotation_means_agree(spark):
    df, qs = table(spark, 30)
    near = df.select(F.lit(1).alias("g"), *(F.col(k) * 0.05 + (1.0 if k == "qw" else 0.0) for k in M.POSE[:4])).toDF("g", "a", "b", "c", "d")
    one, two = K.mean_rotation(near, "g", list("abcd")).first(), K.mean_rotation_svd(near, "g", list("abcd")).first()
    assert np.allclose(matrix([one.qx, one.qy, one.qz, one.qw]), np.array(two.rotation).reshape(3, 3), atol=1e-3)


def test_quantiles(spark):
    r = np.random.default_rng(3)
    values = [(k % 5 if k % 7 else None, float(v)) for k, v in enumerate(r.integers(0, 50, 400))] + [(9, None), (8, 1.0)]
    df = spark.createDataFrame(values, "g int, v double")
    wanted = {"a": ("v", 0.5), "b": ("v", 0.9), "c": ("v", 0.5, "upper"), "d": ("v", 0.9, "lower"), "e": ("v", 0.25, "fence")}
    got = {x.g: x for x in grouped_quantiles(df, ["g"], wanted).collect()}
    for g in {g for g, _ in values}:
        v = sorted(x for h, x in values if h == g and x is not None)
        n = len(v)
        assert got[g].n == sum(h == g for h, _ in values)
        want = [np.quantile(v, 0.5), np.quantile(v, 0.9), v[n // 2], v[int(0.9 * (n - 1))], v[min(n - 1, int(0.25 * n + 0.5))]] if v else [None] * 5
        assert [got[g][k] for k in "abcde"] == pytest.approx(want)


def test_table_quantile_narrows(spark, monkeypatch):
    from sightline.operators import quantiles

    monkeypatch.setattr(quantiles, "FEW", 10)
    v = np.concatenate([np.random.default_rng(1).normal(size=2000), np.zeros(500)])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    for q in (0.0, 0.123, 0.5, 1.0):
        assert table_quantile(df, "v", q) == pytest.approx(np.quantile(v, q))
    assert table_quantile(df.limit(0), "v", 0.5) is None


def test_checks_stop(spark):
    views = spark.createDataFrame([(1, "a"), (2, "b")], "i int, name string")
    images = spark.createDataFrame([(1, "a"), (2, "c")], "i int, name string")
    assert L.checked_join(views.where("i = 1"), images, ["i"], "name").count() == 1
    with pytest.raises(Exception, match="file name mismatch: 2"):
        L.checked_join(views, images, ["i"], "name").collect()
    with pytest.raises(Exception, match="index out of range: 2"):
        L.checked_join(views, images.where("i = 1"), ["i"], "name").collect()
    with pytest.raises(Exception, match="out of bounds: 2"):
        L.assert_bounds(views, "i", "i", 0, 1).collect()


def test_big_ids_and_names(spark):
    big = 2**62 + 7
    row = spark.createDataFrame([(big, -9)], "a long, b long").select(S.floor_div("a", 4).alias("a"), S.floor_div("b", 4).alias("b")).first()
    assert (row.a, row.b) == (big // 4, -9 // 4)
    names = ["f99999999999999999999", "f5", "f10", "f007"]
    got = [r.s for r in spark.createDataFrame([(n,) for n in names], "s string").orderBy(S.natural_key("s")).collect()]
    assert got == ["f5", "f007", "f10", "f99999999999999999999"]
    one = spark.range(1).select(X.first_suffix(F.lit(".hidden"), F.lit("a/b.c/d"), F.lit(None).cast("string"), default=".x").alias("e"), X.label_map(F.lit("4-1:8, 4-2 : 9,")).alias("m"), X.machine(F.lit(None).cast("string"), F.lit("f")).alias("w")).first()
    assert (one.e, one.m, one.w) == (".x", {"4-1": 8, "4-2": 9}, "f")


def test_long_paths_are_reached(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(3, 1), (50, 51)], "a int, b int")
    got = R.reachable(edges, spark.createDataFrame([(1,)], "node int"))
    assert sorted(r.node for r in got.collect()) == list(range(1, 41))


def test_ingest(spark, tmp_path):
    def put(name, rows):
        spark.createDataFrame(rows, "k int, n int, tags array<int>").coalesce(1).write.mode("append").json(str(tmp_path / name))

    def stream():
        return spark.readStream.schema("k int, n int, tags array<int>").json(str(tmp_path / "in"))

    put("in", [(1, 1, [1]), (1, 2, []), (2, 1, None), (2, 2, [3, 4])])

    def run():
        ingest.shards(ingest.imagesets(stream(), "tags"), str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
        return sorted((r.k, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run() == [(1, 1), (2, 2)]
    put("in", [(3, 1, [5])])
    assert run() == [(1, 1), (2, 2), (3, 1)] == run()
    put("quota", [(1, n, [n] if n % 2 else []) for n in range(8)])
    q = ingest.until_quota(spark.readStream.schema("k int, n int, tags array<int>").json(str(tmp_path / "quota")), "k", ["n"], F.size("tags") > 0, 2)
    ingest.shards(q, str(tmp_path / "kept"), str(tmp_path / "kept_at")).awaitTermination()
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "kept")).collect()) == [0, 1, 2, 3]
    a, b = (spark.createDataFrame([(t, v)], f"t int, {n} int") for t, v, n in ((2, 1, "image"), (1, 5, "imu")))
    assert [(r.t, r.topic, r.image, r.imu) for r in ingest.merged({"image": a, "imu": b}, "t").collect()] == [(1, "imu", None, 5), (2, "image", 1, None)]


def test_own_columns_stay(spark):
    """Columns named like the operators' helpers keep their values."""
    clash = {n: F.lit(7) for n in ("_n", "_nth", "_p", "_run", "_r", "_id", "_left", "_b", "_f", "_pick", "_v", "_key", "_fence")}
    df = spark.createDataFrame([(1, k, float(k)) for k in range(12)], "g int, t long, v double").withColumns(clash)
    outs = [
        R.best_per_key(df, ["g"], [F.col("t")]), R.stride_limit(df, [F.col("t")], 5, 2), R.fenced(df, "g", "v"),
        R.nearest_in_time(df, df.where("t % 3 = 0"), ["g"], "t", "t"), R.interpolated(df, df.where("t % 3 = 0"), ["g"], "t", "v"),
    ]
    for out, n in zip(outs, (1, 2, 12, 12, 12), strict=True):
        rows = out.collect()
        assert len(rows) == n and all(r[c] == 7 for r in rows for c in clash)
    assert [(r.match_id, r.delta) for r in outs[3].where("t in (4, 5)").orderBy("t").collect()] == [(3, 1), (6, 1)]
    assert R.runs(df, ["g"], F.col("t"), F.col("v") != 5).first().asDict() == {"g": 1, "n_runs": 2, "longest_run": 6}
