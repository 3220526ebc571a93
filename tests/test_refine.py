"""Block refinement: planted deltas and lenses come back, steps are limited, and a numeric reference agrees."""

import numpy as np
import pyarrow as pa
import pytest

from sightline.operators.framewise import whole_frames
from sightline.operators.refine import LENS, POSE, Settings, limited, logarithm, moved, multiplied, project, refine, solved, turned


def test_batched_motions():
    rng = np.random.default_rng(1)
    step = rng.normal(size=(50, 6)) * np.array([1, 1, 1, 2, 2, 2.0])
    pose = np.concatenate((rng.normal(size=(50, 4)), rng.normal(size=(50, 3))), 1)
    pose[:, :4] /= np.linalg.norm(pose[:, :4], axis=1, keepdims=True)
    out = moved(step, pose)
    for xi, a, b in zip(step, pose, out, strict=True):
        m = np.zeros((4, 4))
        m[:3, :3] = [[0, -xi[2], xi[1]], [xi[2], 0, -xi[0]], [-xi[1], xi[0], 0]]
        m[:3, 3] = xi[3:]
        e, power = np.eye(4), np.eye(4)
        for k in range(1, 40):
            power = power @ m / k
            e = e + power
        x = rng.normal(size=3)
        assert np.allclose(e[:3, :3] @ (turned(a[:4], x) + a[4:]) + e[:3, 3], turned(b[:4], x) + b[4:], atol=1e-9)
    zero = np.array([0, 0, 0, 1.0, 0, 0, 0])
    small = rng.normal(size=(20, 6)) * 0.3
    assert np.allclose(logarithm(moved(np.concatenate((small[:, :3], 0 * small[:, 3:]), 1), np.tile(zero, (20, 1))))[:, :3], small[:, :3], atol=1e-9)
    assert np.allclose(np.linalg.norm(limited(step.copy(), 0.1, 0.2)[:, 3:], axis=1).max(), 0.2)
    assert (solved(np.zeros((1, 6, 6)), np.ones((1, 6)), 0.0) == 0).all()


def scene(frames, cameras, moving, seed=2, noise=0.0, tilt=0.01):
    """True poses and pixels of a board of 12 points seen by all cameras; the first cameras of moving have a planted delta."""
    rng = np.random.default_rng(seed)
    unit = lambda q: q / np.linalg.norm(q)
    board = np.array([[0.1 * i, 0.1 * j, 0.02 * ((i + j) % 2)] for i in range(4) for j in range(3)])
    priors = {}
    for c in range(cameras):
        q = unit(np.array([0.02 * c, -0.03 * (c % 3), 0.01, 1.0]))
        priors[c] = np.array([*q, 0.1 * c - 0.3, 0.05 * (c % 2), 0.02 * c])
    deltas = {c: moved(rng.normal(size=6) * np.array([tilt] * 3 + [2 * tilt] * 3), np.array([0, 0, 0, 1.0, 0, 0, 0])) if c in moving else np.array([0, 0, 0, 1.0, 0, 0, 0]) for c in range(cameras)}
    lens = np.array([1000.0, 1010.0, 640.0, 480.0, -0.1, 0.02, 0.001, -0.002, 0.003])
    obs, start = [], []
    for f in range(frames):
        true = np.array([*unit(np.array([*rng.normal(size=3) * 0.1, 1.0])), *rng.normal(size=3) * 0.1]) + np.array([0, 0, 0, 0, 0, 0, 2.0])
        start.append((f, *moved(rng.normal(size=6) * 0.004, true)))
        for c, prior in priors.items():
            p = turned(true[:4], board) + true[4:]
            q = multiplied(deltas[c][:4], prior[:4])
            p = turned(q, p) + turned(deltas[c][:4], prior[4:]) + deltas[c][4:]
            x, y = p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]
            fx, fy, cx, cy, k1, k2, p1, p2, k3 = lens
            r2 = x * x + y * y
            radial = 1 + k1 * r2 + k2 * r2**2 + k3 * r2**3
            u = fx * (x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x)) + cx
            v = fy * (y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y) + cy
            obs += [(f, c, *b, *uv) for b, uv in zip(board, np.stack((u, v), 1) + rng.normal(size=(len(u), 2)) * noise, strict=True)]
    return obs, [(c, *p, *lens) for c, p in priors.items()], start, deltas


def tables(spark, obs, cameras, frames):
    plain = lambda rows: [tuple(x if isinstance(x, int | type(None)) else float(x) for x in r) for r in rows]
    return (
        spark.createDataFrame(plain(obs), "frame long, camera int, x double, y double, z double, u double, v double"),
        spark.createDataFrame(plain(cameras), "camera int, " + ", ".join(f"{k} double" for k in (*POSE, *LENS))),
        spark.createDataFrame(plain(frames), "frame long, " + ", ".join(f"{k} double" for k in POSE)),
    )


def test_planted_deltas_come_back(spark):
    obs, cameras, frames, deltas = scene(40, 6, {0, 3})
    obs += [(0, 1, 0.0, 0.0, 0.0, 5000.0, 0.0), (999, 1, 0.0, 0.0, 0.0, 1.0, 1.0), (1, 77, 0.0, 0.0, 0.0, 1.0, 1.0), (1, 1, None, 0.0, 0.0, 1.0, 1.0)]
    got = refine(*tables(spark, obs, cameras, frames), Settings(rounds=7, rotation_sigma=10.0, translation_sigma=10.0, least_camera=10))
    assert got.gate == {"input_observations": len(obs), "kept_observations": len(obs) - 4, "removed_observations": 4, "missing_pose_or_invalid_projection": 3}
    assert all(b < a for a, b in zip(got.costs, got.costs[1:], strict=False)) and got.costs[-1] < 1e-3 * got.costs[0]
    # a motion of the whole rig can hide in the frames: the cameras' poses are right up to one common motion
    then = lambda a, b: np.concatenate((multiplied(a[:4], b[:4]), turned(a[:4], b[4:]) + a[4:]))
    flip = np.array([-1.0, -1, -1, 1])
    back = lambda p: np.concatenate((p[:4] * flip, -turned(p[:4] * flip, p[4:])))
    prior = {c[0]: np.array(c[1:8]) / np.array([*[np.linalg.norm(c[1:5])] * 4, 1, 1, 1]) for c in cameras}
    common = np.array([logarithm(then(back(then(deltas[r.camera], prior[r.camera])), np.array([r[k] for k in POSE]))) for r in got.cameras.collect()])
    assert np.abs(common - common.mean(0)).max() < 4e-3, common
    assert np.abs(np.array([logarithm(x) for x in deltas.values()])).max() > 0.02


def plain_round(obs, cameras, frames, settings):
    """One round with derivatives by differences and loops over frames, then cameras."""
    poses, priors, lens = {f[0]: np.array(f[1:]) for f in frames}, {c[0]: np.array(c[1:8]) for c in cameras}, np.array(cameras[0][8:])
    deltas = {c: np.array([0, 0, 0, 1.0, 0, 0, 0]) for c in priors}
    then = lambda a, b: np.concatenate((multiplied(a[:4], b[:4]), turned(a[:4], b[4:]) + a[4:]))

    def residuals(rows, pose=None, delta=None):
        out = []
        for f, c, *x, u, v in rows:
            a, b = pose if pose is not None else poses[f], then(delta if delta is not None else deltas[c], priors[c])
            p = turned(b[:4], turned(a[:4], np.array(x)) + a[4:]) + b[4:]
            r = project((p[:2] / p[2])[None], lens[None])[1][0] - [u, v]
            n = np.linalg.norm(r)
            out.append(r * settings.clip / n if n > settings.clip else r)
        if delta is not None:
            out.append(logarithm(delta) / np.array([settings.rotation_sigma] * 3 + [settings.translation_sigma] * 3))
        return np.concatenate(out)

    def block(start, of, rotation, translation):
        r, eps = of(start), 1e-6
        jac = np.stack([(of(moved(e, start)) - of(moved(-e, start))) / (2 * eps) for e in np.eye(6) * eps], 1)
        trial = moved(limited(np.linalg.solve(jac.T @ jac + settings.damping * np.eye(6), -jac.T @ r)[None], rotation, translation)[0], start)
        return trial if (of(trial) ** 2).sum() <= (r**2).sum() else start

    new = {f: block(p, lambda x, f=f: residuals([o for o in obs if o[0] == f], pose=x), settings.frame_rotation_step, settings.frame_translation_step) for f, p in poses.items()}
    poses = new
    return new, {c: block(d, lambda x, c=c: residuals([o for o in obs if o[1] == c], delta=x), settings.camera_rotation_step, settings.camera_translation_step) for c, d in deltas.items()}


def test_one_round_equals_plain_loops(spark):
    obs, cameras, frames, _ = scene(5, 3, {1}, noise=2.0, tilt=0.02)
    obs = [(*o[:5], o[5] + (40.0 if k % 13 == 0 else 0.0), o[6]) for k, o in enumerate(obs)]
    settings = Settings(rounds=1, clip=15.0, least_camera=5, camera_rotation_step=0.004, frame_translation_step=0.003)
    cameras = [(c[0], *(np.array(c[1:5]) / np.linalg.norm(c[1:5])), *c[5:]) for c in cameras]
    got = refine(*tables(spark, obs, cameras, frames), settings)
    want_frames, want_deltas = plain_round(obs, cameras, frames, settings)
    for r in got.frames.collect():
        assert np.allclose(r[1:], want_frames[r.frame], atol=2e-6)
    for r in got.cameras.collect():
        assert np.allclose([r[f"d{k}"] for k in POSE], want_deltas[r.camera], atol=2e-6)


def test_lens_and_small_blocks_and_empty(spark):
    obs, cameras, frames, _ = scene(30, 3, set())
    wrong = [(c[0], *c[1:8], c[8] * 1.004, c[9] * 0.997, c[10] + 1.5, c[11] - 1.0, *c[12:]) if c[0] == 1 else c for c in cameras]
    obs = [o for o in obs if not (o[0] == 5 and (o[1] != 0 or o[2] > 0.0 or o[3] > 0.1))]  # two observations are left of frame 5
    settings = Settings(rounds=6, mode="per_camera_fxfycxcy", rotation_sigma=1e-6, translation_sigma=1e-6, focal_sigma=1.0, principal_sigma=100.0, least_camera=10)
    o, c, f = tables(spark, obs, wrong, frames)
    got = refine(o, c, f, settings)
    lens = {r.camera: [r[k] for k in LENS[:4]] for r in got.cameras.collect()}
    assert np.abs(np.array(lens[1]) - [1000, 1010, 640, 480]).max() < 3.0 and np.abs(np.array(lens[0]) - [1000, 1010, 640, 480]).max() < 3.0
    assert got.costs[-1] < 0.02 * got.costs[0]
    before, after = ({r.frame: tuple(r[1:]) for r in x.collect()} for x in (f, got.frames))
    assert before[5] == after[5] and before[6] != after[6]
    nothing = refine(o.limit(0), c, f.limit(0))
    assert nothing.costs == [] and nothing.frames.count() == 0 and nothing.cameras.count() == 3


def test_clip_bounds_outliers(spark):
    obs, cameras, frames, _ = scene(20, 3, set())
    obs = [(*o[:5], o[5] + (300.0 if k % 11 == 0 else 0.0), o[6]) for k, o in enumerate(obs)]
    plain, clipped = (refine(*tables(spark, obs, cameras, frames), Settings(rounds=3, clip=clip, rotation_sigma=1e-6, translation_sigma=1e-6)) for clip in (0.0, 3.0))
    true = {r[0]: np.array(r[1:]) for r in frames}
    off = [np.median([np.abs(np.array(r[1:]) - true[r.frame]).max() for r in x.frames.collect()]) for x in (plain, clipped)]
    assert clipped.costs[-1] < plain.costs[-1] and off[1] < off[0]


def test_too_many_cameras(spark):
    o, c, f = tables(spark, [], [(k, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, *[1.0] * 9) for k in range(257)], [])
    with pytest.raises(ValueError, match="at most 256"):
        refine(o, c, f)


def test_a_round_takes_few_passes(spark):
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    obs, cameras, frames, _ = scene(6, 3, {1}, noise=1.0)
    taken = []
    for rounds in (1, 3):
        context.setJobGroup(f"rounds-{rounds}", "")
        refine(*tables(spark, obs, cameras, frames), Settings(rounds=rounds, least_camera=5))
        taken.append(len(tracker.getJobIdsForGroup(f"rounds-{rounds}")))
    context.setJobGroup("", "")
    assert (taken[1] - taken[0]) / 2 <= 10, taken


def test_a_frame_of_several_blocks_weighs_as_one(spark):
    obs, cameras, frames, _ = scene(2, 3, {1}, noise=2.0, tilt=0.02)
    obs, k = [(*o[:5], o[5] + (40.0 if i % 13 == 0 else 0.0), o[6]) for i, o in enumerate(obs)], 700
    o, c, f = tables(spark, obs, cameras, frames)
    many = o.crossJoin(spark.range(k).select("id")).drop("id").repartition(5)
    short = {"rounds": 2, "clip": 15.0, "least_camera": 5}
    one = refine(o, c, f, Settings(damping=1e-3, rotation_sigma=1.0, translation_sigma=1.0, **short))
    all_ = refine(many, c, f, Settings(damping=1e-3 * k, rotation_sigma=k**-0.5, translation_sigma=k**-0.5, **short))
    assert all_.gate["kept_observations"] == k * one.gate["kept_observations"] and np.allclose(np.array(all_.costs), k * np.array(one.costs), rtol=1e-9)
    for x, y in ((one.frames, all_.frames), (one.cameras.drop("observations"), all_.cameras.drop("observations"))):
        assert np.allclose(np.array(sorted(map(tuple, x.collect())), float), np.array(sorted(map(tuple, y.collect())), float), atol=1e-9)


def test_observations_made_where_they_are_packed(spark):
    obs, cameras, frames, _ = scene(8, 3, {1}, noise=1.0)
    o, c, f = tables(spark, obs, cameras, frames)
    settings = Settings(rounds=2, gate=1.5, least_camera=5)
    plain, packed = refine(o, c, f, settings), refine(o, c, f, settings, lambda b: b)
    assert plain.gate == packed.gate and 0 < plain.gate["removed_observations"] < len(obs) and np.allclose(plain.costs, packed.costs, rtol=1e-12)


def test_whole_frames_over_batches():
    batch = lambda frame, piece: pa.RecordBatch.from_arrays([pa.array(frame), pa.array(piece), pa.array([np.full(6, float(p)).tobytes() for p in piece], pa.binary())], ["frame", "piece", "packed"])
    got = [(t.column("frame").to_pylist(), t.column("piece").to_pylist(), starts.tolist()) for t, starts in whole_frames(iter([batch(["a", "a", "b"], [2, 1, 3]), batch([], []).slice(0, 0), batch(["b", "b"], [5, 4]), batch(["b", "c"], [6, 7]), batch(["d"], [8])]))]
    rows = [(f, p) for frame, piece, _ in got for f, p in zip(frame, piece, strict=True)]
    assert rows == [("a", 1), ("a", 2), ("b", 3), ("b", 4), ("b", 5), ("b", 6), ("c", 7), ("d", 8)]
    assert sum(len(starts) for *_, starts in got) == 4
