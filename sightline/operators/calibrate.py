"""Lens calibration of many cameras at once: every view's pose is eliminated from its camera's equations.

Each step sums a view's normal equations of its pose and its camera's lens in one pass, removes the pose from
them where they are (a Schur complement of a 6 x 6 block), and adds up what is left by camera. Only these
blocks of cameras reach the driver; their solutions go back to the views, which then find their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.shared import checkpoint_dir
from sightline.functions.ship import ship
from sightline.operators.refine import LENS, MODES, MOST_CAMERAS, POSE, Cameras, moved, sums, symmetric

_SEED = 11


@dataclass
class Calibrated:
    """cameras: camera, views, observations, the lens, rms and holdout_rms in pixels; views: camera, view and pose; costs: the sum of squares at the start and after each step."""

    cameras: DataFrame
    views: DataFrame
    costs: list[float] = field(default_factory=list)


def _cut(frame: DataFrame) -> DataFrame:
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def calibrate(observations: DataFrame, views: DataFrame, lenses: DataFrame, mode: str = "per_camera_opencv5", steps: int = 15, clip: float = 0.0, holdout: float = 0.1, least_view: int = 12, settled: float = 1e-9) -> Calibrated:
    """Lenses (and views' poses) that bring the projected points nearest to the observed pixels.

    observations: camera, view, x, y, z, u, v; views: camera, view and the target's pose seen from the
    camera (POSE) to start from; lenses: camera and LENS to start from, at most MOST_CAMERAS. mode
    says which parameters move. A share of holdout of each view's observations, drawn by their
    content, is not used and measures the result. Damping is each camera's own: it falls when its cost
    falls, else grows, and the step is not taken. Ends when no camera gains more than the share
    settled. Observations with nulls or without camera don't count; a view of fewer than least_view
    used observations stays as it is and measures nothing. Empty tables give empty results.
    """
    ship(observations.sparkSession)
    m = MODES[mode]
    listed = lenses.select("camera", *LENS).limit(MOST_CAMERAS + 1).toArrow()
    if listed.num_rows > MOST_CAMERAS:
        raise ValueError(f"at most {MOST_CAMERAS} cameras")
    names = listed.column("camera").combine_chunks()
    lens = np.stack([np.asarray(listed.column(k), np.float64) for k in LENS], 1)
    eye, size = np.tile([0.0, 0, 0, 1, 0, 0, 0], (len(names), 1)), 6 + m
    low, cells = np.triu_indices(size), size * (size + 1) // 2
    label = F.concat_ws("/", F.col("camera").cast("string"), F.col("view").cast("string"))
    poses = _cut(views.dropna(subset=["camera", "view", *POSE]).select(label.alias("frame"), "camera", "view", *(F.col(k).cast("double").alias(f"f_{k}") for k in POSE)))
    rows = observations.dropna(subset=["camera", "view", "x", "y", "z", "u", "v"]).withColumn("frame", label).select("frame", "camera", *(F.col(k).cast("double").alias(k) for k in ("x", "y", "z", "u", "v")))
    drawn = F.pmod(F.xxhash64(*rows.columns, F.lit(_SEED)), F.lit(1_000_000)) < int(holdout * 1_000_000)
    rows = _cut(rows.withColumn("held", drawn).repartition("frame"))
    enough = rows.where("not held").groupBy("frame").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least_view).select("frame")
    counted = _cut(rows.join(enough, "frame"))
    used, unused = counted.where("not held").drop("held"), counted.where("held").drop("held")

    def camera(at: np.ndarray) -> Cameras:
        return Cameras(names, eye, at, at)

    def changed(at: np.ndarray, step: np.ndarray) -> np.ndarray:
        out = at.copy()
        out[:, :2] *= 1 + step[:, :2]
        out[:, 2:m] += step[:, 2:]
        return out

    def by_camera(source: DataFrame, now: DataFrame, at: np.ndarray) -> np.ndarray:
        """Observations and cost of each camera."""
        out = np.zeros((len(names), 2))
        for r in sums(source.join(now.drop("camera", "view"), "frame"), "camera", camera(at), clip).collect():
            out[names.index(pa.scalar(r[0], names.type)).as_py()] = r[1:]
        return out

    def parts(b: pa.RecordBatch, damping: np.ndarray):
        """Camera numbers, pose blocks (damped, inverted), mixed blocks, lens blocks and right-hand sides of a batch of views."""
        total = np.stack([np.asarray(b.column(f"s{k}"), np.float64) for k in range(2 + cells + size)], 1)
        at = np.asarray(pc.index_in(b.column("camera"), value_set=names))
        h, g = symmetric(total[:, 2 : 2 + cells], size), total[:, 2 + cells :]
        pose = h[:, :6, :6].copy()
        diagonal = np.einsum("nii->ni", pose)
        diagonal += damping[at, None] * diagonal + 1e-9
        return at, np.linalg.inv(pose), h[:, :6, 6:], h[:, 6:, 6:], g, total[:, :2]

    def eliminated(equations: DataFrame, damping: np.ndarray) -> np.ndarray:
        i, j = np.triu_indices(m)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    _, inverse, mixed, own, g, told = parts(b, damping)
                    back = mixed.transpose(0, 2, 1) @ inverse
                    s, r = own - back @ mixed, g[:, 6:] - (back @ g[:, :6, None])[..., 0]
                    yield pa.RecordBatch.from_arrays([b.column("camera"), *(pa.array(c) for c in np.concatenate((told, s[:, i, j], r), 1).T)], columns)

        columns = ["camera", *(f"e{k}" for k in range(2 + len(i) + m))]
        got = equations.mapInArrow(run, f"camera {kind}, " + ", ".join(f"{c} double" for c in columns[1:])).groupBy("camera").agg(*(F.sum(c).alias(c) for c in columns[1:])).collect()
        out = np.zeros((len(names), 2 + len(i) + m))
        for r in got:
            out[names.index(pa.scalar(r[0], names.type)).as_py()] = r[1:]
        return out

    def solved(equations: DataFrame, damping: np.ndarray, step: np.ndarray) -> DataFrame:
        """The views' poses after their part of the step."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    at, inverse, mixed, _, g, _ = parts(b, damping)
                    delta = -(inverse @ (g[:, :6] + (mixed @ step[at][:, :, None])[..., 0])[:, :, None])[..., 0]
                    pose = moved(delta, np.stack([np.asarray(b.column(f"f_{k}"), np.float64) for k in POSE], 1))
                    yield pa.RecordBatch.from_arrays([b.column("frame"), *(pa.array(p) for p in pose.T)], ["frame", *(f"t_{k}" for k in POSE)])

        return equations.mapInArrow(run, "frame string, " + ", ".join(f"t_{k} double" for k in POSE))

    kind = lenses.schema["camera"].dataType.simpleString()
    costs: list[float] = []
    damping = np.full(len(names), 1e-3)
    before = by_camera(used, poses, lens)
    live = before[:, 0] > 0
    if live.any():
        costs.append(float(before[:, 1].sum()))
        for _ in range(steps):
            now = camera(lens)
            derivative = lambda v, now=now: np.concatenate((now.of_frame(v), now.of_lens(v, m)), 2)
            sums_of = sums(used.join(poses.drop("camera", "view"), "frame"), "frame", now, clip, derivative, size)
            equations = _cut(sums_of.join(poses, "frame"))
            total = eliminated(equations, damping)
            s, r = symmetric(total[:, 2 : 2 + m * (m + 1) // 2], m), total[:, 2 + m * (m + 1) // 2 :]
            step = np.zeros((len(names), m))
            for c in np.flatnonzero(live):
                a = s[c] + np.diag(damping[c] * np.diag(s[c]) + 1e-12)
                step[c] = -np.linalg.lstsq(a, r[c], rcond=None)[0]
            trial_lens = changed(lens, step)
            trial = _cut(poses.join(solved(equations, damping, step), "frame", "left").select("frame", "camera", "view", *(F.coalesce(f"t_{k}", f"f_{k}").alias(f"f_{k}") for k in POSE), *(F.col(f"f_{k}").alias(f"o_{k}") for k in POSE)))
            after = by_camera(used, trial.drop(*(f"o_{k}" for k in POSE)), trial_lens)
            better = live & (after[:, 1] < before[:, 1]) & (after[:, 0] >= before[:, 0])
            won = [n for n, ok in zip(names.to_pylist(), better, strict=True) if ok]
            take = F.col("camera").isin(won) if won else F.lit(False)
            poses = trial.select("frame", "camera", "view", *(F.when(take, F.col(f"f_{k}")).otherwise(F.col(f"o_{k}")).alias(f"f_{k}") for k in POSE))
            lens = np.where(better[:, None], trial_lens, lens)
            damping = np.where(better, damping / 10, damping * 10)
            gain = np.where(better, before[:, 1] - after[:, 1], 0.0)
            lately = np.where(better, after[:, 1], before[:, 1])
            costs.append(float(lately.sum()))
            done = (gain <= settled * np.maximum(before[:, 1], 1e-300)) & (better | (damping > 1e6)) | (lately <= 1e-18 * before[:, 0])
            before = np.where(better[:, None], after, before)
            live &= ~done
            if not live.any():
                break
    held = by_camera(unused, poses, lens)
    seen = {r["camera"]: r["count"] for r in rows.groupBy("camera").count().collect()}
    shown = {r["camera"]: r["count"] for r in poses.groupBy("camera").count().collect()}
    rms = lambda t: [float(np.sqrt(c / n)) if n else None for n, c in t]
    out = [(c, shown.get(c, 0), seen.get(c, 0), *map(float, x), a, b) for c, x, a, b in zip(names.to_pylist(), lens, rms(before), rms(held), strict=True)]
    told = lenses.sparkSession.createDataFrame(out, f"camera {kind}, views long, observations long, " + ", ".join(f"{k} double" for k in LENS) + ", rms double, holdout_rms double")
    return Calibrated(told, poses.select("camera", "view", *(F.col(f"f_{k}").alias(k) for k in POSE)), costs)
