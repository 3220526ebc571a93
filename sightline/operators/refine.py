"""Refinement of camera poses, and of their lenses, by damped Gauss-Newton steps on blocks.

Observations say where a camera saw a point of the target in a frame. Every round first moves each
frame's target pose with the cameras held, then each camera with the frames held. A step that doesn't
lower its block's cost is not taken.

The observations are dealt by frame once, packed, sorted and kept on the executors' disks. A pass joins
them with the frames' states, which are small, without moving them again. What belongs to a frame (its
normal equations, the trial of its step, the equations of the cameras at its new pose) is done while its
observations are at hand; only the sums of cameras, of which there are at most MOST_CAMERAS, reach the
driver. A pass also tells the cost of the cameras' last trial step and goes on as if all trials were taken,
so a round is one pass; where one is not, the pass is made again. The frames' states are cut from their
lineage in the shared folder after each pass that moves them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.shared import checkpoint_dir
from sightline.functions.ship import ship
from sightline.operators.framewise import BLOCK, blocks, by_camera, by_frame, camera_columns, matrices, pack, parts, products, view as columns_of, whole_frames

MOST_CAMERAS = 256
#: Tasks that add up what a pass tells of cameras; each sends a row a camera to the driver.
TOLD_BY = 16
POSE = ("qx", "qy", "qz", "qw", "tx", "ty", "tz")
LENS = ("fx", "fy", "cx", "cy", "k1", "k2", "p1", "p2", "k3")
#: Lens parameters that each mode moves: the shares of focal lengths, the principal point, and distortion.
MODES = {"fixed": 0, "per_camera_fxfycxcy": 4, "per_camera_opencv5": 9}


@dataclass(frozen=True)
class Settings:
    """A limit or gate that is not positive is off. Angles are radians, lengths those of the poses."""

    rounds: int = 5
    steps: int = 1  # of a block in each round
    damping: float = 1e-3
    clip: float = 500.0  # pixels; longer residuals count as this long
    gate: float = 600.0  # pixels; observations farther off at the start are left out
    frame_rotation_step: float = 0.05
    frame_translation_step: float = 0.1
    camera_rotation_step: float = 0.02
    camera_translation_step: float = 0.03
    rotation_sigma: float = np.radians(3.0)  # of the prior of camera deltas
    translation_sigma: float = 0.12
    least_frame: int = 4  # observations of a frame that moves
    least_camera: int = 30
    mode: str = "fixed"
    focal_sigma: float = 0.01
    principal_sigma: float = 8.0
    distortion_sigma: float = 0.05
    focal_step: float = 0.002
    principal_step: float = 2.0
    distortion_step: float = 0.01
    lens_damping: float = 1e-2
    focal_most: float = 0.02
    principal_most: float = 16.0
    distortion_most: float = 0.15


@dataclass
class Refined:
    """cameras: one row per camera with its delta (d*), pose and lens; frames: frame and pose; costs: of the start and after each round; gate: counts of the start."""

    cameras: DataFrame
    frames: DataFrame
    costs: list[float] = field(default_factory=list)
    gate: dict[str, int] = field(default_factory=dict)


# small batched motions: quaternions (x, y, z, w) and positions of many blocks at once


def turned(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    once = 2 * np.cross(q[..., :3], p)
    return p + q[..., 3:] * once + np.cross(q[..., :3], once)


def multiplied(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.concatenate((a[..., 3:] * b[..., :3] + b[..., 3:] * a[..., :3] + np.cross(a[..., :3], b[..., :3]), a[..., 3:] * b[..., 3:] - (a[..., :3] * b[..., :3]).sum(-1, keepdims=True)), -1)


def moved(step: np.ndarray, pose: np.ndarray) -> np.ndarray:
    """exp(step) after pose; a step is a turn vector and a speed."""
    w, v, angle = step[..., :3], step[..., 3:], np.linalg.norm(step[..., :3], axis=-1, keepdims=True)
    small = angle < 1e-6
    a = np.where(small, 1.0, angle)
    half, one, two = np.where(small, 0.5, np.sin(a / 2) / a), np.where(small, 0.5, (1 - np.cos(a)) / a**2), np.where(small, 1 / 6, (a - np.sin(a)) / a**3)
    q = np.concatenate((half * w, np.cos(angle / 2)), -1)
    once = np.cross(w, v)
    out = np.concatenate((multiplied(q, pose[..., :4]), turned(q, pose[..., 4:]) + v + one * once + two * np.cross(w, once)), -1)
    out[..., :4] /= np.linalg.norm(out[..., :4], axis=-1, keepdims=True)
    return out


def logarithm(pose: np.ndarray) -> np.ndarray:
    """The turn vector and the position."""
    q = np.where(pose[..., 3:4] < 0, -1, 1) * pose[..., :4]
    s = np.linalg.norm(q[..., :3], axis=-1, keepdims=True)
    return np.concatenate((q[..., :3] * np.where(s > 1e-12, 2 * np.arctan2(s, q[..., 3:]) / np.where(s > 1e-12, s, 1), 2.0), pose[..., 4:]), -1)


def solved(h: np.ndarray, g: np.ndarray, damping: float) -> np.ndarray:
    """The damped step of each block; zero where the equations have no solution."""
    a = h + damping * np.eye(h.shape[-1])
    good = np.isfinite(a).all((-1, -2)) & np.isfinite(g).all(-1)
    # sums of squares have no negative eigenvalues, so the damping bounds most blocks' condition
    doubtful = good & ~(np.trace(a, axis1=-2, axis2=-1) < 1e12 * damping)
    good[doubtful] = np.linalg.cond(a[doubtful]) < 1e15
    out = np.zeros_like(g)
    out[good] = -np.linalg.solve(a[good], g[good][..., None])[..., 0]
    return out


def limited(step: np.ndarray, rotation: float, translation: float) -> np.ndarray:
    """Turn and way of each step shortened to their most."""
    for part, most in ((slice(0, 3), rotation), (slice(3, 6), translation)):
        n = np.linalg.norm(step[..., part], axis=-1, keepdims=True)
        if most > 0:
            step[..., part] *= np.where(n > most, most / np.where(n > most, n, 1), 1)
    return step


def symmetric(flat: np.ndarray, k: int) -> np.ndarray:
    """Matrices from their upper triangles, row by row."""
    out = np.zeros((*flat.shape[:-1], k, k))
    i, j = np.triu_indices(k)
    out[..., i, j] = flat
    out[..., j, i] = flat
    return out


# rows


@dataclass
class View:
    """Rows of one batch: residual r (clipped), a (the point in the rig), p (in the camera), by_p (2 x 3 derivative of the pixel), plane (undistorted x, y), spread (distorted ones) and whether it projects."""

    r: np.ndarray
    a: np.ndarray
    p: np.ndarray
    by_p: np.ndarray
    plane: np.ndarray
    spread: np.ndarray
    ok: np.ndarray
    camera: np.ndarray


def project(plane: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distorted x, y; pixels; and the pixels' 2 x 2 derivative by the undistorted x, y."""
    (x, y), (fx, fy, cx, cy, k1, k2, p1, p2, k3) = plane.T, lens.T
    r2 = x * x + y * y
    radial, slope = 1 + r2 * (k1 + r2 * (k2 + r2 * k3)), 2 * (k1 + r2 * (2 * k2 + 3 * k3 * r2))
    spread = np.stack((x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x), y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y), 1)
    both = x * y * slope + 2 * p1 * x + 2 * p2 * y
    d = np.stack((fx * (radial + x * x * slope + 2 * p1 * y + 6 * p2 * x), fx * both, fy * both, fy * (radial + y * y * slope + 6 * p1 * y + 2 * p2 * x)), 1).reshape(-1, 2, 2)
    return spread, spread * np.stack((fx, fy), 1) + np.stack((cx, cy), 1), d


def view(batch: pa.RecordBatch, cameras: Cameras, frame: str) -> View:
    """The rows' residuals with the frames' poses in columns of the prefix."""
    columns = lambda names: np.stack([np.asarray(batch.column(k), np.float64) for k in names], 1)
    at = np.asarray(pc.fill_null(pc.index_in(batch.column("camera"), value_set=cameras.names), -1))
    x, uv, pose = columns("xyz"), columns("uv"), columns([frame + k for k in POSE])
    eye, lens = cameras.pose[at], cameras.lens[at]
    a = turned(pose[:, :4], x) + pose[:, 4:]
    p = turned(eye[:, :4], a) + eye[:, 4:]
    ok = (p[:, 2] > 1e-9) & (at >= 0) & np.isfinite(pose).all(1) & np.isfinite(uv).all(1)
    z = np.where(ok, p[:, 2], 1.0)
    plane = np.where(ok[:, None], p[:, :2] / z[:, None], 0.0)
    spread, pixel, d = project(plane, lens)
    by_p = np.concatenate((d, -(d @ plane[:, :, None])), 2) / z[:, None, None]
    return View(np.where(ok[:, None], pixel - uv, 0.0), a, p, by_p, plane, spread, ok, at)


def clipped(r: np.ndarray, by: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Residuals (n x 2) longer than most shortened to it, and the derivative (n x 2 x k) of what is then left."""
    n = np.linalg.norm(r, axis=1)
    over = n > most if most > 0 else np.zeros(len(r), bool)
    if over.any():
        e = r[over] / n[over, None]
        share = (most / n[over])[:, None]
        by, r = by.copy(), r.copy()
        by[over] = share[:, :, None] * (by[over] - e[:, :, None] * np.einsum("ni,nik->nk", e, by[over])[:, None])
        r[over] *= share
    return r, by


@dataclass
class Cameras:
    """The driver's blocks: at most MOST_CAMERAS names, poses and lenses."""

    names: pa.Array
    pose: np.ndarray
    lens: np.ndarray
    base: np.ndarray

    def of_frame(self, v: View) -> np.ndarray:
        """Derivative of the pixels by a small motion of the frame's target (turn, speed) after its pose."""
        q = self.pose[v.camera][:, None, :4] * np.array([-1.0, -1, -1, 1])
        h = turned(np.broadcast_to(q, (len(q), 2, 4)), v.by_p)
        return np.concatenate((np.cross(v.a[:, None], h), h), 2)

    def of_camera(self, v: View) -> np.ndarray:
        """By one of the camera after its pose."""
        return np.concatenate((np.cross(v.p[:, None], v.by_p), v.by_p), 2)

    def of_lens(self, v: View, size: int) -> np.ndarray:
        """By the shares of the focal lengths, the principal point and the distortion."""
        (x, y), f, r2 = v.plane.T, self.lens[v.camera][:, :2], (v.plane**2).sum(1)
        out = np.zeros((len(x), 2, 9))
        out[:, [0, 1], [0, 1]] = self.base[v.camera][:, :2] * v.spread
        out[:, [0, 1], [2, 3]] = 1.0
        for k, (a, b) in enumerate(((x * r2, y * r2), (x * r2**2, y * r2**2), (2 * x * y, r2 + 2 * y * y), (r2 + 2 * x * x, 2 * x * y), (x * r2**3, y * r2**3)), 4):
            out[:, 0, k], out[:, 1, k] = f[:, 0] * a, f[:, 1] * b
        return out[:, :, :size]


def sums(rows: DataFrame, by: str, cameras: Cameras, clip: float, derivative: Callable[[View], np.ndarray] | None = None, size: int = 0, frame: str = "f_") -> DataFrame:
    """Per block (a value of column by): n (rows that project), cost, and with a derivative h (upper triangle of sum JᵀJ) and g (sum Jᵀr), as doubles s0, s1, ..."""
    i, j = np.triu_indices(size)
    width = 2 + len(i) + size

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = view(b, cameras, frame)
            block = b.column(by).dictionary_encode()
            at = np.asarray(block.indices)
            r, jac = clipped(v.r, derivative(v) if derivative else np.zeros((len(v.r), 2, 0)), clip)
            each = np.concatenate((v.ok[:, None], (r * r).sum(1, keepdims=True), (jac[:, :, i] * jac[:, :, j]).sum(1), (jac * r[:, :, None]).sum(1)), 1)[v.ok]
            order = np.argsort(at[v.ok], kind="stable")
            found, first = np.unique(at[v.ok][order], return_index=True)
            total = np.add.reduceat(each[order], first, axis=0) if len(first) else np.zeros((0, width))
            yield pa.RecordBatch.from_arrays([block.dictionary.take(pa.array(found)), *(pa.array(x) for x in total.T)], [by, *(f"s{k}" for k in range(width))])

    schema = f"{by} {rows.schema[by].dataType.simpleString()}, " + ", ".join(f"s{k} double" for k in range(width))
    return rows.mapInArrow(part, schema).groupBy(by).agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(width)))


def _frames_pass(held: DataFrame, states: DataFrame, cameras: Cameras, settings: Settings, derivative: str | None = None, size: int = 0, move: bool = False) -> DataFrame:
    """One pass over the packed observations and their frames' states (f_*, and mask: the bits of those that count, null for all).

    Rows with a camera's number have in told its observations and cost with the frames as they are, then,
    with a derivative ("camera" or "lens"), its equations after the frames moved. With move the other rows
    are the new states.
    """
    s, n_cameras, table_of = settings, len(cameras.names), camera_columns(cameras.pose, cameras.lens, cameras.base)
    width = 2 + size * (size + 3) // 2 if derivative else 0
    poses = [f"f_{k}" for k in POSE]
    kind = held.schema["frame"].dataType

    def block(packed: np.ndarray, first: np.ndarray, good: np.ndarray | None, pose: np.ndarray, told: np.ndarray) -> np.ndarray:
        """The frames' new poses; told grows by the cameras' sums."""
        n = packed.shape[1]
        owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))

        def views(pose: np.ndarray):
            m = matrices(pose)
            for part in parts(n):
                yield part, columns_of(packed[:, part], m.take(owner[part], axis=1, mode="clip"), table_of, s.clip, None if good is None else good[part])

        def add(total: np.ndarray, columns: Iterable[np.ndarray], part: slice) -> None:
            begin = np.flatnonzero(np.diff(owner[part], prepend=-1))
            total[:, owner[part][begin]] += by_frame(begin, columns)

        total, last, new = np.zeros((29, len(first))), [], pose
        for part, v in views(pose):
            told[:, :2] += by_camera(packed[:, part], products(v), n_cameras)
            if move:
                add(total, products(v, v.of_frame()), part)
            last = [(part, v)]
        if move:
            step = limited(solved(symmetric(total[2:23].T, 6), total[23:].T, s.damping), s.frame_rotation_step, s.frame_translation_step)
            trial, after = moved(step, pose), np.zeros((2, len(first)))
            tried = []
            for part, v in views(trial):
                add(after, products(v), part)
                tried = [(part, v)]
            better = (total[0] >= s.least_frame) & (after[1] <= total[1]) & (after[0] >= total[0])
            new = np.where(better[:, None], trial, pose)
            if derivative and n <= BLOCK:
                tried[0][1].put_back(last[0][1], np.flatnonzero(~better[owner]))
                last = tried
            else:
                last = []
        if derivative:
            for part, v in last if n <= BLOCK else views(new):
                told[:, 2:] += by_camera(packed[:, part], products(v, v.of_camera() if derivative == "camera" else v.of_lens(size)), n_cameras)
        return new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.zeros((n_cameras, 2 + width))
        for table, starts in whole_frames(batches):
            pose = np.stack([np.asarray(table.column(k), np.float64) for k in poses], 1)[starts]
            mask, new = table.column("mask").take(pa.array(starts)).to_pylist(), pose.copy()
            for i, j, packed, first in blocks(table, starts):
                good, ends = None, np.append(first[1:], packed.shape[1])
                if any(m is not None for m in mask[i:j]):
                    good = np.concatenate([np.ones(b - a, bool) if m is None else np.unpackbits(np.frombuffer(m, np.uint8), count=b - a).astype(bool) for m, a, b in zip(mask[i:j], first, ends, strict=True)])
                new[i:j] = block(packed, first, good, pose[i:j], told)
            if move:
                yield _state_rows(table, starts, new, mask)
        yield _told_rows(kind_of, np.arange(n_cameras), told)

    from pyspark.sql.pandas.types import to_arrow_type

    kind_of = to_arrow_type(kind)
    rows = held.join(states.hint("merge"), "frame").select("frame", "piece", "packed", *poses, "mask")
    return rows.mapInArrow(run, _state_schema(kind.simpleString()))


def _state_schema(kind: str) -> str:
    return f"frame {kind}, " + ", ".join(f"f_{k} double" for k in POSE) + ", mask binary, camera int, told array<double>"


_STATE = ["frame", *(f"f_{k}" for k in POSE), "mask", "camera", "told"]


def _state_rows(table: pa.Table, starts: np.ndarray, pose: np.ndarray, mask: list) -> pa.RecordBatch:
    n = len(starts)
    frame = table.column("frame").chunk(0).take(pa.array(starts))
    return pa.RecordBatch.from_arrays([frame, *(pa.array(x) for x in pose.T), pa.array(mask, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.float64()))], _STATE)


def _told_rows(kind: pa.DataType, camera: np.ndarray, told: np.ndarray) -> pa.RecordBatch:
    n = len(camera)
    return pa.RecordBatch.from_arrays([pa.nulls(n, kind), *(pa.nulls(n, pa.float64()) for _ in POSE), pa.nulls(n, pa.binary()), pa.array(camera, pa.int32()), pa.array(told.tolist(), pa.list_(pa.float64()))], _STATE)


def _gated(held: DataFrame, frames: DataFrame, cameras: Cameras, settings: Settings) -> DataFrame:
    """The first states, of frames with an observation that counts: one that projects, and lies within the gate. Told are each camera's observations and cost, and by camera -1 how many observations there are, count, and don't project."""
    s, n_cameras, table_of = settings, len(cameras.names), camera_columns(cameras.pose, cameras.lens, cameras.base)
    poses = [f"f_{k}" for k in POSE]
    kind = held.schema["frame"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, counts = np.zeros((n_cameras, 2)), np.zeros(3)
        for table, starts in whole_frames(batches):
            pose = np.stack([np.asarray(table.column(k), np.float64) for k in poses], 1)[starts]
            mask, some = [], []
            for i, j, packed, first in blocks(table, starts):
                n = packed.shape[1]
                owner, m, good = np.repeat(np.arange(j - i), np.diff(np.append(first, n))), matrices(pose[i:j]), np.zeros(n, bool)
                for part in parts(n):
                    v = columns_of(packed[:, part], m.take(owner[part], axis=1, mode="clip"), table_of, 0.0)
                    good[part] = v.seen & ((v.far() <= s.gate) if s.gate > 0 else True)
                    cost = v.r[0] ** 2 + v.r[1] ** 2
                    rows = np.where(good[part], np.stack((good[part], np.minimum(cost, s.clip**2) if s.clip > 0 else cost)), 0.0)
                    told += by_camera(packed[:, part], rows, n_cameras)
                    counts += [v.seen.size, good[part].sum(), v.seen.size - v.seen.sum()]
                kept = np.add.reduceat(good.astype(np.int64), first)
                some += (kept > 0).tolist()
                ends = np.append(first[1:], n)
                mask += [None if k == b - a else np.packbits(good[a:b]).tobytes() for k, a, b in zip(kept, first, ends, strict=True)]
            at = np.flatnonzero(some)
            yield _state_rows(table, starts[at], pose[at], [mask[k] for k in at])
        yield _told_rows(kind_of, np.array([-1]), counts[None])
        yield _told_rows(kind_of, np.arange(n_cameras), told)

    from pyspark.sql.pandas.types import to_arrow_type

    kind_of = to_arrow_type(kind)
    rows = held.join(frames.hint("merge"), "frame", "left").select("frame", "piece", "packed", *poses)
    return rows.mapInArrow(run, _state_schema(kind.simpleString()))


def _told(rows: DataFrame, n: int, width: int) -> np.ndarray:
    """What a pass told of camera -1 and of each camera, summed."""
    out = np.zeros((n + 1, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n + 1, width))
        for b in batches:
            for camera, x in zip(b.column("camera").to_pylist(), b.column("told").to_pylist(), strict=True):
                total[camera, : len(x)] += x
        yield pa.RecordBatch.from_arrays([pa.array(range(n + 1), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["camera", "told"])

    for r in rows.where(F.col("camera").isNotNull()).select("camera", "told").coalesce(TOLD_BY).mapInArrow(run, "camera int, told array<double>").collect():
        out[r["camera"]] += r["told"]
    return out


@dataclass
class _Trial:
    """A step of cameras that the next pass judges: what they'd be, their observations and cost before, which move, and whether a round ends with it."""

    delta: np.ndarray
    lens: np.ndarray
    total: np.ndarray
    moving: np.ndarray
    ends: bool = False


def _cut(frame: DataFrame) -> DataFrame:
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def refine(observations: DataFrame, cameras: DataFrame, frames: DataFrame, settings: Settings = Settings(), made: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> Refined:
    """Camera deltas, lenses and frame poses that lower the observations' pixel errors.

    observations: frame, camera, x, y, z (point of the target), u, v. cameras: camera, the pose of the rig
    as seen from it (POSE) and its lens (LENS). frames: frame and the target's pose in the rig (POSE).
    A camera's pose is its delta after its prior pose; deltas and lens changes are held by normal
    priors. Observations without a frame or camera, with nulls, or beyond settings.gate at the start
    are left out and counted. A frame of fewer than least_frame observations and a camera of fewer than
    least_camera stay as they are; the steps' lengths are limited, and a step counts only if the block's cost
    does not rise and no observation is lost. Empty tables give empty results. Columns of other names are ignored.
    With made, the rows of observations are a frame and whatever made takes to make a batch of observations of
    a batch of rows, in the task that packs them. A frame's observations are in one task, 48 bytes each.
    """
    ship(observations.sparkSession)
    s = settings
    listed = cameras.select("camera", *POSE, *LENS).limit(MOST_CAMERAS + 1).toArrow()
    if listed.num_rows > MOST_CAMERAS:
        raise ValueError(f"a rig has at most {MOST_CAMERAS} cameras")
    columns = lambda names: np.stack([np.asarray(listed.column(k), np.float64) for k in names], 1)
    names, prior, base, size = listed.column("camera").combine_chunks(), columns(POSE), columns(LENS), MODES[s.mode]
    delta, lens_delta = np.tile([0.0, 0, 0, 1, 0, 0, 0], (len(names), 1)), np.zeros((len(names), size))
    sigma = np.array([s.focal_sigma] * 2 + [s.principal_sigma] * 2 + [s.distortion_sigma] * 5)[:size]
    step_most = np.array([s.focal_step] * 2 + [s.principal_step] * 2 + [s.distortion_step] * 5)[:size]
    most = np.array([s.focal_most] * 2 + [s.principal_most] * 2 + [s.distortion_most] * 5)[:size]
    pose_weight = np.array([1 / s.rotation_sigma] * 3 + [1 / s.translation_sigma] * 3)

    def placed(delta: np.ndarray, lens_delta: np.ndarray) -> Cameras:
        lens = base.copy()
        lens[:, :2] *= 1 + lens_delta[:, :2] if size else 1
        lens[:, 2:size] += lens_delta[:, 2:]
        pose = np.concatenate((multiplied(delta[:, :4], prior[:, :4]), turned(delta[:, :4], prior[:, 4:]) + delta[:, 4:]), 1)
        return Cameras(names, pose, lens, base)

    def priors(delta: np.ndarray, lens_delta: np.ndarray) -> np.ndarray:
        return ((logarithm(delta) * pose_weight) ** 2).sum(1) + ((lens_delta / sigma) ** 2).sum(1)

    n, now = len(names), placed(delta, lens_delta)
    poses = _cut(frames.select("frame", *(F.col(k).cast("double").alias(f"f_{k}") for k in POSE)).dropna())
    # dealt by frame and sorted once: persisted tables keep their partitions in later joins, checkpoints don't
    held = pack(observations, names, made).repartition("frame").sortWithinPartitions("frame", "piece").persist(StorageLevel.DISK_ONLY)
    costs: list[float] = []
    pending: _Trial | None = None
    moving, cost = np.zeros(n, bool), 0.0

    def settle(new: np.ndarray) -> np.ndarray:
        """Which cameras' trial blocks are kept, as the cost doesn't rise and no observation is lost."""
        nonlocal pending, moving, cost
        t, pending = pending, None
        before, after = t.total[:, 1] + priors(delta, lens_delta), new[:, 1] + priors(t.delta, t.lens)
        moving = t.moving & (new[:, 0] >= t.total[:, 0]) & (after <= before)
        delta[moving], lens_delta[moving] = t.delta[moving], t.lens[moving]
        cost = float(np.where(moving, after, before).sum())
        if t.ends:
            costs.append(cost)
        return moving

    def sweep(derivative: str | None = None, k: int = 0, move: bool = False) -> np.ndarray:
        """The cameras' equations after the frames moved, if they shall, with the trial before it settled."""
        nonlocal states, now

        def made(at: Cameras) -> tuple[DataFrame, np.ndarray]:
            rows = _frames_pass(held, states, at, s, derivative, k, move)
            rows = _cut(rows) if move else rows
            return rows, _told(rows, n, 2 + (2 + k * (k + 3) // 2 if derivative else 0))[:n]

        trial, at = pending, now
        if trial:  # go on as if all its blocks were kept
            every = trial.moving[:, None]
            at = placed(np.where(every, trial.delta, delta), np.where(every, trial.lens, lens_delta))
        rows, told = made(at)
        if trial:
            kept = settle(told[:, :2])
            now = placed(delta, lens_delta)
            if (derivative or move) and (kept != trial.moving).any():
                rows, told = made(now)
        if move:
            states = rows.where(F.col("camera").isNull()).drop("camera", "told")
        return told[:, 2:]

    try:
        start = _cut(_gated(held, poses, now, s))
        told = _told(start, n, 3)
        counts, seen = told[-1].astype(int).tolist(), told[:n, :2]
        gate = {"input_observations": counts[0], "kept_observations": counts[1], "removed_observations": counts[0] - counts[1], "missing_pose_or_invalid_projection": counts[2]}
        states = start.where(F.col("camera").isNull()).drop("camera", "told")
        active = seen[:, 0] >= s.least_camera
        if counts[1]:
            costs.append(float((seen[:, 1] + priors(delta, lens_delta)).sum()))
        for _ in range(s.rounds if counts[1] else 0):
            for _ in range(s.steps - 1):
                sweep(move=True)
            for step in range(s.steps):
                total = sweep("camera", 6, move=step == 0)
                if step and not moving.any():
                    break
                h, g = symmetric(total[:, 2:23], 6) + np.diag(pose_weight**2), total[:, 23:] + pose_weight**2 * logarithm(delta)
                pending = _Trial(moved(limited(solved(h, g, s.damping), s.camera_rotation_step, s.camera_translation_step), delta), lens_delta.copy(), total[:, :2], moving if step else active)
            if size:
                total, cells = sweep("lens", size), 2 + size * (size + 1) // 2
                change = solved(symmetric(total[:, 2:cells], size) + np.diag(sigma**-2.0), total[:, cells:] + lens_delta / sigma**2, s.lens_damping)
                pending = _Trial(delta.copy(), np.clip(lens_delta + np.clip(change, -step_most, step_most), -most, most), total[:, :2], active)
            if pending:
                pending.ends = True
            else:
                costs.append(cost)
        if pending:
            sweep()
    finally:
        held.unpersist()
    rows = [(c, int(n), bool(a), *map(float, (*d, *p, *x))) for c, n, a, d, p, x in zip(names.to_pylist(), seen[:, 0], active, delta, now.pose, now.lens, strict=True)]
    schema = "camera {}, observations long, active boolean, {}".format(cameras.schema["camera"].dataType.simpleString(), ", ".join(f"{k} double" for k in (*(f"d{k}" for k in POSE), *POSE, *LENS)))
    last = states.select("frame", *(F.col(f"f_{k}").alias(f"n_{k}") for k in POSE))
    every = poses.join(last, "frame", "left").select("frame", *(F.coalesce(f"n_{k}", f"f_{k}").alias(k) for k in POSE))
    return Refined(cameras.sparkSession.createDataFrame(rows, schema), every, costs, gate)
