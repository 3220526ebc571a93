"""Lens calibration against a dense least-squares solution of all unknowns together, and edge cases."""

import numpy as np

from sightline.operators.calibrate import calibrate
from sightline.operators.refine import LENS, POSE, moved, project, turned


def scene(views, noise, seed=1):
    rng = np.random.default_rng(seed)
    lens = np.array([800.0, 820, 330, 235, 0, 0, 0, 0, 0])
    obs, poses, true = [], [], []
    for v in range(views):
        q = np.array([*rng.normal(size=3) * 0.3, 1.0])
        pose = np.array([*(q / np.linalg.norm(q)), *rng.normal(size=2) * 0.3, 2.5 + 0.4 * rng.normal()])
        x = rng.uniform(-0.6, 0.6, (20, 3)) * [1, 1, 0.3]
        p = turned(np.tile(pose[:4], (20, 1)), x) + pose[4:]
        uv = project(p[:, :2] / p[:, 2:], np.tile(lens, (20, 1)))[1] + rng.normal(size=(20, 2)) * noise
        obs += [("a", v, *map(float, (*a, *b))) for a, b in zip(x, uv, strict=True)]
        true.append(pose)
        poses.append(("a", v, *map(float, moved(rng.normal(size=6) * 0.01, pose))))
    return obs, poses, true


def tables(spark, obs, poses, lenses):
    return (
        spark.createDataFrame(obs, "camera string, view int, x double, y double, z double, u double, v double"),
        spark.createDataFrame(poses, "camera string, view int, " + ", ".join(f"{k} double" for k in POSE)),
        spark.createDataFrame(lenses, "camera string, " + ", ".join(f"{k} double" for k in LENS)),
    )


def dense(obs, poses, lens, m):
    """Gauss-Newton on all poses and the lens at once, with derivatives by differences."""
    poses = {p[1]: np.array(p[2:]) for p in poses}
    lens = np.array(lens)
    views = sorted(poses)

    def residuals(step):
        out, at = [], lens.copy()
        at[:2] *= 1 + step[-m:][:2]
        at[2:m] += step[-m:][2:]
        for _, v, *x, a, b in obs:
            pose = moved(step[6 * views.index(v) : 6 * views.index(v) + 6], poses[v])
            p = turned(pose[:4], np.array(x)) + pose[4:]
            out.append(project((p[:2] / p[2])[None], at[None])[1][0] - [a, b])
        return np.concatenate(out), at, {v: moved(step[6 * k : 6 * k + 6], poses[v]) for k, v in enumerate(views)}

    n = 6 * len(views) + m
    for _ in range(8):
        jac = np.stack([(residuals(e)[0] - residuals(-e)[0]) / 2e-6 for e in np.eye(n) * 1e-6], 1)
        _, lens, poses = residuals(np.linalg.lstsq(jac, -residuals(np.zeros(n))[0], rcond=None)[0])
    return lens


def test_equals_a_dense_solution(spark):
    obs, poses, _ = scene(5, 0.5)
    start = ("a", 760.0, 850.0, 320.0, 240.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    extra = [("b", 0, 0.0, 0.0, 0.0, 1.0, 1.0), ("a", 77, 0.0, 0.0, 0.0, 1.0, 1.0), ("a", 0, None, 0.0, 0.0, 1.0, 1.0)]
    o, v, lens = tables(spark, obs + extra, [*poses, ("a", 50, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 2.0)], [start, ("c", *start[1:])])
    got = calibrate(o, v, lens, mode="per_camera_fxfycxcy", holdout=0.0)
    row = {r.camera: r for r in got.cameras.collect()}
    want = dense(obs, poses, start[1:], 4)
    assert np.allclose([row["a"][k] for k in LENS], want, atol=1e-4)
    assert all(b <= a for a, b in zip(got.costs, got.costs[1:], strict=False)) and row["a"].views == 6 and row["a"].observations == 101
    assert row["c"].rms is None and [row["c"][k] for k in LENS] == list(start[1:])
    poses_now = {r.view: tuple(r[2:]) for r in got.views.collect()}
    assert poses_now[50] == (0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 2.0)


def test_holdout_and_outliers(spark):
    obs, poses, _ = scene(12, 0.0, seed=3)
    obs = [(*o[:5], o[5] + (80.0 if k % 37 == 0 else 0.0), o[6]) for k, o in enumerate(obs)]
    start = ("a", 790.0, 790.0, 320.0, 240.0, 0.0, 0.0, 0.0, 0.0, 0.0)
    plain, clipped = (calibrate(*tables(spark, obs, poses, [start]), mode="per_camera_fxfycxcy", clip=c, holdout=0.2).cameras.first() for c in (0.0, 2.0))
    off = [max(abs(r[k] - t) for k, t in zip(LENS[:4], (800, 820, 330, 235), strict=True)) for r in (plain, clipped)]
    assert off[1] < off[0] and plain.holdout_rms > 0
    empty = calibrate(*(x.limit(0) for x in tables(spark, obs, poses, [start])))
    assert empty.costs == [] and empty.cameras.count() == 0 and empty.views.count() == 0
