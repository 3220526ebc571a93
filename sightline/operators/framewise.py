"""Observations of whole frames, packed, and their residuals and derivatives as columns.

A frame's observations lie packed in few rows, so that a join with the frame's state moves no single
observation. They are computed in blocks of about BLOCK, a column a quantity, which stay in a core's cache.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Observations that are computed at once.
BLOCK = 8192
#: Numbers of a packed observation: the camera's number (-1: none), x, y, z, u, v.
PACKED = 6


@dataclass
class View:
    """Observations of one block in columns: r (2) residuals, clipped; over, share and e (2): the clipped ones, to which share, and their directions; a (3): the point in the rig; p (3): in the camera; by (2 x 3): the pixel by p, clipped; plane (2) undistorted and spread (2) distorted; seen: whether it counts; cameras: their columns."""

    r: np.ndarray
    clip: tuple[np.ndarray, np.ndarray, np.ndarray] | None
    a: np.ndarray
    p: np.ndarray
    by: np.ndarray
    plane: np.ndarray
    spread: np.ndarray
    seen: np.ndarray
    cameras: list

    def far(self) -> np.ndarray:
        """The residual's length; infinite where there is none."""
        return np.where(self.seen, np.sqrt(self.r[0] ** 2 + self.r[1] ** 2), np.inf)

    def put_back(self, old: View, rows: np.ndarray) -> None:
        """What the cameras' equations need, as it was in another view at the rows."""
        for x, y in ((self.r, old.r), (self.p, old.p), (self.by, old.by), (self.seen, old.seen)):
            x[..., rows] = y[..., rows]

    def of_frame(self) -> np.ndarray:
        """Derivative (2 x 6) of the pixels by a small motion of the frame's target (turn, speed) after its pose."""
        c, (a0, a1, a2), out = self.cameras, self.a, np.empty((2, 6, self.r.shape[1]))
        for row, by in zip(out, self.by, strict=True):
            for k in range(3):
                row[3 + k] = c[k] * by[0] + c[3 + k] * by[1] + c[6 + k] * by[2]
            row[0], row[1], row[2] = a1 * row[5] - a2 * row[4], a2 * row[3] - a0 * row[5], a0 * row[4] - a1 * row[3]
        return out

    def of_camera(self) -> np.ndarray:
        """By one of the camera after its pose."""
        (p0, p1, p2), out = self.p, np.empty((2, 6, self.r.shape[1]))
        out[:, 3:] = self.by
        for row, (x, y, z) in zip(out, self.by, strict=True):
            row[0], row[1], row[2] = p1 * z - p2 * y, p2 * x - p0 * z, p0 * y - p1 * x
        return out

    def of_lens(self, size: int) -> np.ndarray:
        """By the shares of the focal lengths, the principal point and the distortion."""
        (x, y), (fx, fy), base = self.plane, self.cameras[12:14], self.cameras[21:23]
        r2, out = x * x + y * y, np.zeros((2, 9, self.r.shape[1]))
        out[0, 0], out[1, 1] = base[0] * self.spread[0], base[1] * self.spread[1]
        out[0, 2] = out[1, 3] = 1.0
        for k, (a, b) in enumerate(((x * r2, y * r2), (x * r2**2, y * r2**2), (2 * x * y, r2 + 2 * y * y), (r2 + 2 * x * x, 2 * x * y), (x * r2**3, y * r2**3)), 4):
            out[0, k], out[1, k] = fx * a, fy * b
        out = np.where(self.seen, out, 0.0)[:, :size]
        shorten(out, self.clip)
        return out


def matrices(pose: np.ndarray) -> np.ndarray:
    """Rows 0 to 8 the rotations of the poses, row by row, 9 to 11 their positions; a column for each pose."""
    x, y, z, w, *t = pose.T
    return np.stack((1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y), *t))


def camera_columns(pose: np.ndarray, lens: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Rotation and position, lens, and the first lens's focal lengths; a column for each camera and one more for none."""
    table = np.concatenate((matrices(pose), lens.T, base[:, :2].T))
    return np.concatenate((table, np.zeros((len(table), 1))), 1)


def carried(m: np.ndarray | list, p: np.ndarray) -> np.ndarray:
    """The points (3 x n) after the motions in columns."""
    out = np.empty((3, p.shape[1]))
    for k in range(3):
        out[k] = m[3 * k] * p[0]
        out[k] += m[3 * k + 1] * p[1]
        out[k] += m[3 * k + 2] * p[2]
        out[k] += m[9 + k]
    return out


def shorten(by: np.ndarray, clip: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> None:
    """What is left of derivatives (2 x k x n) where residuals are held at a length."""
    if clip is not None:
        over, share, e = clip
        some = by[:, :, over]
        by[:, :, over] = share * (some - e[:, None] * (e[0] * some[0] + e[1] * some[1]))


def view(packed: np.ndarray, pose: np.ndarray, cameras: np.ndarray, most: float, good: np.ndarray | None = None) -> View:
    """The observations (PACKED x n) with their frames' motions and the cameras in columns; residuals longer than most are shortened to it; only good ones count."""
    at = packed[0].astype(np.int64)
    none = at < 0
    at[none] = cameras.shape[1] - 1
    # what all cameras share is one number
    c = [x[0] if (x[:-1] == x[0]).all() else x.take(at, mode="clip") for x in cameras]
    a = carried(pose, packed[1:4])
    p = carried(c, a)
    seen = (p[2] > 1e-9) & ~none & np.isfinite(a.sum(0) + p.sum(0) + packed[4] + packed[5])
    if good is not None:
        seen &= good
    whole = bool(seen.all())
    if not whole:
        a[:, ~seen], p[:, ~seen] = 0.0, [[0.0], [0.0], [1.0]]
    inverse = 1 / p[2]
    plane = p[:2] * inverse
    (x, y), (fx, fy, cx, cy, k1, k2, p1, p2, k3) = plane, c[12:21]
    r2, xy = x * x + y * y, x * y
    radial, slope = 1 + r2 * (k1 + r2 * (k2 + r2 * k3)), 2 * (k1 + r2 * (2 * k2 + 3 * k3 * r2))
    spread = np.stack((x * radial + 2 * p1 * xy + p2 * (r2 + 2 * x * x), y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * xy))
    both = xy * slope + 2 * p1 * x + 2 * p2 * y
    r = np.stack((fx * spread[0] + cx - packed[4], fy * spread[1] + cy - packed[5]))
    by = np.empty((2, 3, len(x)))
    by[0, 0], by[0, 1] = fx * (radial + x * x * slope + 2 * p1 * y + 6 * p2 * x), fx * both
    by[1, 0], by[1, 1] = fy * both, fy * (radial + y * y * slope + 6 * p1 * y + 2 * p2 * x)
    by[:, :2] *= inverse
    by[:, 2] = -(by[:, 0] * x + by[:, 1] * y)
    clip = None
    if not whole:
        r[:, ~seen], by[:, :, ~seen] = 0.0, 0.0
    if most > 0:
        n2 = r[0] ** 2 + r[1] ** 2
        over = np.flatnonzero(n2 > most * most)
        if len(over):
            n = np.sqrt(n2[over])
            clip = over, most / n, r[:, over] / n
            r[:, over] *= most / n
            shorten(by, clip)
    return View(r, clip, a, p, by, plane, spread, seen, c)


def products(v: View, jac: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Columns of what is summed, one by one in the same memory: whether it counts, the cost and, with a derivative, the upper triangle of JᵀJ, and Jᵀr."""
    yield v.seen.astype(np.float64)
    out, more = np.empty((2, len(v.seen)))
    pairs = [(v.r, v.r)]
    if jac is not None:
        rows = jac.transpose(1, 0, 2)
        pairs += [(rows[i], rows[j]) for i in range(len(rows)) for j in range(i, len(rows))] + [(row, v.r) for row in rows]
    for x, y in pairs:
        np.multiply(x[0], y[0], out=out)
        np.multiply(x[1], y[1], out=more)
        out += more
        yield out


def by_camera(packed: np.ndarray, columns: Iterable[np.ndarray], n: int) -> np.ndarray:
    """The columns' sums for each of n cameras."""
    at = packed[0].astype(np.int64)
    at[at < 0] = n
    return np.stack([np.bincount(at, x, n + 1)[:n] for x in columns], 1)


def by_frame(first: np.ndarray, columns: Iterable[np.ndarray]) -> np.ndarray:
    """The columns' sums for each frame, of which first are the first rows."""
    return np.stack([np.add.reduceat(x, first) for x in columns])


def pack(observations: DataFrame, names: pa.Array, made: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """frame, piece (a number that orders a frame's rows) and packed: the observations of a batch and frame, PACKED doubles each. With made, it makes them of the rows in the same task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches if made is None else map(made, batches):
            if not b.num_rows:
                continue
            frame = b.column("frame").dictionary_encode(null_encoding="encode")
            at = np.asarray(frame.indices)
            order = np.argsort(at, kind="stable")
            camera = pc.fill_null(pc.index_in(b.column("camera"), value_set=names), -1)
            rows = np.stack([np.asarray(x, np.float64) for x in (camera, *(b.column(k) for k in "xyzuv"))], 1)[order]
            ends = np.cumsum(np.bincount(at)) * rows.itemsize * PACKED
            blob = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes()), pa.py_buffer(rows.tobytes())])
            yield pa.RecordBatch.from_arrays([frame.dictionary, blob], ["frame", "packed"])

    rows = observations if made else observations.select("frame", "camera", *(F.col(k).cast("double").alias(k) for k in "xyzuv"))
    return rows.mapInArrow(run, f"frame {rows.schema['frame'].dataType.simpleString()}, packed binary").withColumn("piece", F.monotonically_increasing_id())


def whole_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole frames from rows sorted by frame, in order of frame and piece, and where each frame starts."""

    def told(parts: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(parts)
        at = table.column_names.index("packed")
        table = table.set_column(at, "packed", table.column(at).cast(pa.large_binary())).combine_chunks()
        run = np.asarray(table.column("frame").chunk(0).dictionary_encode(null_encoding="encode").indices)
        piece = np.asarray(table.column("piece"))
        if ((run[1:] == run[:-1]) & (piece[1:] < piece[:-1])).any():
            table = table.take(pa.array(np.lexsort((piece, run)))).combine_chunks()
        return table, np.flatnonzero(np.diff(run, prepend=-1))

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        run = np.asarray(b.column("frame").dictionary_encode(null_encoding="encode").indices)
        last = int(np.flatnonzero(np.diff(run, prepend=-1))[-1])
        if held and (last or held[0].column("frame")[0] != b.column("frame")[0]):
            first = int(np.searchsorted(run, 0, "right")) if held[0].column("frame")[0] == b.column("frame")[0] else 0
            yield told([*held, b.slice(0, first)])
            b, held, last = b.slice(first), [], last - first
        if last:
            yield told([b.slice(0, last)])
        held.append(b.slice(last))
    if held:
        yield told(held)


def blocks(table: pa.Table, starts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last frame, the packed observations (PACKED x n) and the first of each frame, of blocks of whole frames with about BLOCK observations."""
    column = table.column("packed").chunk(0)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.float64).reshape(-1, PACKED)
    first = np.append(offsets[starts] - offsets[0], offsets[-1] - offsets[0]) // (8 * PACKED)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(first, first[i] + BLOCK, "right")) - 1)
        yield i, j, np.ascontiguousarray(data[first[i] : first[j]].T), first[i:j] - first[i]
        i = j


def parts(n: int) -> Iterator[slice]:
    """A block's observations in parts; a frame of very many has several."""
    for i in range(0, n, BLOCK):
        yield slice(i, min(n, i + BLOCK))
