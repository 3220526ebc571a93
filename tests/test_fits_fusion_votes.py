"""Local fits, least squares, dataset fusion and frame votes against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sightline.operators import fits as L
from sightline.operators import fusion as U
from sightline.operators import votes as V


def test_local_curvature_and_slope(spark):
    rng = np.random.default_rng(1)
    t = np.sort(rng.uniform(1e6, 1e6 + 50, 60))
    t[20:30] = t[20]  # no span
    v = np.stack((np.sin(t) + rng.normal(size=60), (t - 1e6) ** 2), 1)
    v = v[np.lexsort((v[:, 0], t))]
    df = spark.createDataFrame([("a", float(x), float(p), float(q), int(x * 1e9)) for x, (p, q) in zip(t, v, strict=True)] + [("b", 1.0, 2.0, 3.0, 5)] * 4, "k string, t double, p double, q double, ns long")
    c = L.local_curvature(F.col("t"), [F.col("p"), F.col("q")], W.partitionBy("k").orderBy("t", "p"), 3)
    s = L.local_slope(F.col("t"), [F.col("p")], ["k"], F.col("ns"), 2_000_000_000)
    got = sorted(df.select("k", "t", "p", "ns", c[0].alias("cp"), c[1].alias("cq"), s[0].alias("s")).collect(), key=lambda r: r[:4])
    a = [r for r in got if r.k == "a"]
    for i, r in enumerate(a):
        lo, hi = max(0, i - 3), min(len(t), i + 4)
        tau = t[lo:hi] - t[i]
        if hi - lo < 5 or tau.max() - tau.min() < 1e-3:
            assert r.cp is None
        elif len(np.unique(tau)) >= 4:
            fit = np.linalg.lstsq(np.stack((np.ones_like(tau), tau, tau**2 / 2), 1), v[lo:hi], rcond=None)[0][2]
            assert np.allclose([r.cp, r.cq], fit, rtol=1e-6, atol=1e-6)
        near = [j for j in range(len(t)) if abs(a[j].ns - r.ns) <= 2_000_000_000]
        if len(near) < 5:
            assert r.s is None
        else:
            assert np.isclose(r.s, np.polyfit(t[near] - t[i], v[near, 0], 1)[0], rtol=1e-6, atol=1e-7)
    assert all(r.cp is None and r.s is None for r in got if r.k == "b")


def _columns(names):
    return lambda b: (np.stack([np.asarray(b.column(n)) for n in names], 1), np.asarray(b.column("y")))


def test_least_squares_rank_and_condition(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(500, 4)) * [1, 10, 1e-4, 1]
    y = a @ [1, 2, 3, 4] + rng.normal(size=500) * 0.01
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(a, y, strict=True)], "a double, b double, c double, d double, y double").repartition(7)
    got = L.least_squares(df, _columns("abcd"), 4)
    x, _, rank, singular = np.linalg.lstsq(a, y, rcond=None)
    assert np.allclose(got.x, x) and got.rank == rank == 4 and got.n == 500 and np.allclose(got.singular, singular) and np.isclose(got.condition, singular[0] / singular[-1])
    assert np.isclose(got.rms, np.sqrt(np.mean((a @ x - y) ** 2)))
    same = L.least_squares(df.withColumn("d", F.col("a")), _columns("abcd"), 4)
    assert same.rank == 3
    none = L.least_squares(df.limit(0), _columns("abcd"), 4)
    assert none.n == 0 and none.rank == 0 and none.condition is None
    first, fit, told = L.trimmed_least_squares(df.withColumn("y", F.col("y") + F.when(F.col("a") > 1.5, 50.0).otherwise(0.0)), _columns("abcd"), 4, 1, 0.9)
    assert np.abs(fit.x - [1, 2, 3, 4])[[0, 1, 3]].max() < np.abs(first.x - [1, 2, 3, 4])[[0, 1, 3]].max()
    assert told.where("inlier").count() == 450


def test_motion_samples_and_system(spark):
    """A turning, accelerating camera with a sensor beside it: the sensor's place comes back from poses and readings."""
    rng = np.random.default_rng(3)
    steps, dt = 400, 0.01
    r_ci, t_ci, gravity, bias = np.array([[0, -1, 0], [1, 0, 0], [0, 0, 1.0]]), np.array([0.2, -0.1, 0.15]), np.array([0, 0, -9.8]), np.array([0.05, -0.02, 0.03])
    when = np.arange(steps) * dt

    def rotation(s):  # camera to world, smooth
        a, b, c = 0.8 * np.sin(1.7 * s), 0.6 * np.sin(2.3 * s + 1), 0.7 * np.sin(1.3 * s + 2)
        m = lambda i, j, x: np.array([[np.cos(x) if p == q and p in (i, j) else 1.0 if p == q else (-np.sin(x) if (p, q) == (i, j) else np.sin(x) if (p, q) == (j, i) else 0.0) for q in range(3)] for p in range(3)])
        return m(0, 1, a) @ m(1, 2, b) @ m(0, 2, c)

    place = lambda s: np.array([np.sin(1.1 * s), 0.5 * np.cos(0.9 * s), 0.3 * np.sin(1.9 * s)])
    h = 1e-4
    sensor = lambda s: place(s) + rotation(s) @ t_ci
    poses, imu = [], []
    for k, s in enumerate(when):
        stamp = int(s * 1e9)
        r_cw = rotation(s).T
        q = V.quaternions(r_cw[None])[0]
        poses.append(("cam", stamp, *map(float, q), *map(float, place(s))))
        acc = (sensor(s + h) - 2 * sensor(s) + sensor(s - h)) / h**2
        reading = (rotation(s) @ r_ci).T @ (acc - gravity) + bias
        imu.append(("cam", stamp - 2_000_000, *map(float, reading)))
        imu.append(("cam", stamp + 2_000_000, *map(float, reading)))
    p = spark.createDataFrame(poses, "camera string, stamp long, qx double, qy double, qz double, qw double, px double, py double, pz double")
    i = spark.createDataFrame(imu, "camera string, stamp long, ax double, ay double, az double")
    rows = L.motion_samples(p, i, "camera", "stamp", alpha_window_ns=40_000_000, sign=-1.0)
    got = rows.collect()
    assert 300 < len(got) <= steps and rows.columns[:2] == ["camera", "stamp"]
    for r in got[50:300:40]:
        s = r.stamp / 1e9
        want = (place(s + h) - 2 * place(s) + place(s - h)) / h**2
        assert np.abs(np.array([r.ax, r.ay, r.az]) - want).max() < 0.05
    for sign in (1.0, -1.0):
        rows = L.motion_samples(p, i, "camera", "stamp", alpha_window_ns=40_000_000, sign=sign)
        _, fit, _ = L.trimmed_least_squares(rows, L.accelerometer_rows({"cam": (0, r_ci, np.eye(4))}, "camera", 1), 9, 3, 0.95)
        if fit.rank == 9 and np.abs(fit.x[:3] - t_ci).max() < 0.02 and np.abs(fit.x[3:6] - gravity).max() < 0.2 and np.abs(fit.x[6:] - bias).max() < 0.2:
            return
    pytest.fail(f"{fit}")


def plain_fusion(points, radius):
    """As fuse, by plain lists that shrink."""
    radius, lists = np.float32(radius), [[(k, x) for k, x in enumerate(p.astype(np.float32))] for p in points]
    square = float(radius) ** 2
    centres, f = [], 0
    while f < len(lists[0]):
        centre, before = lists[0][f][1], None
        for _ in range(1000):
            covered = []
            for rows in lists:
                best, found = square, -1
                for o, (_, x) in enumerate(rows):
                    d = x - centre
                    s = float(d[0] * d[0] + d[1] * d[1])
                    if s <= best:
                        best, found = s, o
                covered.append(found)
            near = [rows[o][1] for rows, o in zip(lists, covered, strict=True) if o >= 0]
            centre = np.sum(near, axis=0, dtype=np.float32) / np.float32(len(near))
            if covered == before:
                break
            before = covered
        if min(covered) >= 0:
            centres.append(centre)
        else:
            for rows, o in zip(lists, covered, strict=True):
                if o >= 0:
                    del rows[o]
            if covered[0] <= f:
                f -= 1
        f += 1
    within = lambda x: any(float((c - x)[0] ** 2 + (c - x)[1] ** 2) <= square for c in centres)
    return [sorted(k for k, x in rows if within(x)) for rows in lists]


def test_fusion_equals_plain_lists():
    r = random.Random(5)
    for case in range(300):
        grid = case % 3 == 0  # whole coordinates: many ties and equal centres
        n, d = r.randint(0, 14), r.randint(1, 4)
        base = [(r.randint(0, 8), r.randint(0, 8)) if grid else (r.uniform(0, 12), r.uniform(0, 12)) for _ in range(n)]
        points = []
        for _ in range(d):
            rows = [(x + (r.randint(-1, 1) if grid else r.gauss(0, 0.4)), y + (r.randint(-1, 1) if grid else r.gauss(0, 0.4))) for x, y in base if r.random() < 0.85]
            r.shuffle(rows)
            points.append(np.array(rows, np.float32).reshape(-1, 2))
        radius = r.choice([0.0, 1.0, 1.5, 2.0])
        got = [np.flatnonzero(k).tolist() for k in U.fuse(points, radius)]
        assert got == plain_fusion(points, radius), (case, points, radius)


def test_fusion_of_tables(spark):
    rows = [(0, "a", 0, 0, 1.0, 1.0, 7), (0, "a", 0, 1, 9.0, 9.0, 8), (1, "a", 0, 0, 9.2, 9.0, 9), (1, "a", 0, 1, 1.1, 1.0, 10), (0, "b", 0, 0, 1.0, 1.0, 11), (0, "c", 1, 0, 5.0, 5.0, 12), (1, "c", 1, 0, 25.0, 5.0, 13), (0, "a", None, 0, 1.0, 1.0, 14), (1, "d", 0, 0, 1.0, 1.0, 15)]
    f = spark.createDataFrame(rows, "dataset int, filename string, camera int, feature_pos int, x float, y float, feature_id int")
    sets = spark.createDataFrame([(d, n) for d, n in ((0, "a"), (1, "a"), (0, "b"), (0, "c"), (1, "c"), (1, "d"), (0, "e"), (1, "e"))], "dataset int, filename string")
    got = sorted((r.dataset, r.filename, r.feature_pos, r.feature_id) for r in U.intersect_datasets(f, sets, 2, 1.0).collect())
    assert got == [(0, "a", 0, 7), (0, "a", 1, 8), (1, "a", 0, 9), (1, "a", 1, 10)]
    assert U.intersect_datasets(f.limit(0), sets, 2, 1.0).count() == 0


def test_votes_against_loops(spark):
    rng = np.random.default_rng(6)
    rig = rng.normal(size=(6, 3))
    turns = np.linalg.qr(rng.normal(size=(6, 3, 3)))[0]
    turns *= np.sign(np.linalg.det(turns))[:, None, None]
    rows = []
    for f in range(30):
        q = np.linalg.qr(rng.normal(size=(3, 3)))[0]
        q *= np.sign(np.linalg.det(q))
        for c in range(6):
            if f == 4 and c == 1:
                continue
            centre = q @ rig[c] * (1 + f / 10) + f + rng.normal(size=3) * 0.001 + (0.8 if c == 5 and f % 4 == 0 else 0.0) + (np.array([2.0, 0, 0]) if f == 9 and c == 0 else 0.0)
            rows.append((f, f"c{c}", *map(float, centre), *map(float, V.quaternions((q @ turns[c])[None])[0]), 10 * c))
    df = spark.createDataFrame(rows, "frame int, label string, cx double, cy double, cz double, qx double, qy double, qz double, qw double, tracks int").withColumn("scale", F.lit(1))
    anchors = spark.createDataFrame([(f"c{c}", *map(float, rig[c])) for c in range(4)], "label string, ax double, ay double, az double")
    out = V.frame_votes(df, anchors, max_rms=0.05, max_norm=50.0, least_tracks=10)
    status = {r.frame: (r.status, r.missing) for r in out.frames.collect()}
    assert status[4] == ("missing_anchors", ["c1"]) and status[9][0] == "bad_anchor_alignment" and sum(s == "accepted" for s, _ in status.values()) == 28
    poses = {r.label: r for r in V.robust_poses(out.votes, "label", 5, 0.01).collect()}
    assert set(poses) == {f"c{c}" for c in range(1, 6)}  # c0 has too few tracks
    votes = out.votes.collect()
    for c in range(1, 6):
        p, mine = poses[f"c{c}"], np.array([[r.cx, r.cy, r.cz] for r in votes if r.label == f"c{c}"])
        off = np.linalg.norm(mine - np.median(mine, 0), axis=1)
        mad = np.median(np.abs(off - np.median(off)))
        inner = mine[off <= max(0.01, np.median(off) + 3 * 1.4826 * mad)]
        assert (p.raw_votes, p.inlier_votes) == (len(mine), len(inner)) and np.allclose([p.cx, p.cy, p.cz], np.median(inner, 0), atol=1e-9)
        assert np.abs(np.array([p.cx, p.cy, p.cz]) - rig[c]).max() < 0.01
        assert abs(np.dot([p.qx, p.qy, p.qz, p.qw], V.quaternions(turns[c][None])[0])) > 1 - 1e-6
        assert np.isclose(p.center_p90_residual_m, np.percentile(np.linalg.norm(inner - np.median(inner, 0), axis=1), 90))
    assert V.frame_votes(df.limit(0), anchors, 0.05, 50.0, 10).frames.count() == 0
