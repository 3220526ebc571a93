"""Projection into generic cameras: which pixel's ray a direction or point lies on, by damped Newton steps on B-spline grids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sightline.functions.ship import ship


def spline_terms(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights (n x 4) of the control values around an interval of a uniform cubic B-spline at share t, and their derivatives."""
    s, t2 = 1 - t, t * t
    w = np.stack((s**3, 3 * t2 * t - 6 * t2 + 4, -3 * t2 * t + 3 * t2 + 3 * t + 1, t2 * t), 1) / 6
    d = np.stack((-s * s, 3 * t2 - 4 * t, -3 * t2 + 2 * t + 1, t2), 1) / 2
    return w, d


def surface(grid: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values (n x depth) of the surface over a grid (height x width x depth) at (x, y), and their derivatives (n x depth x 2)."""
    height, width, _ = grid.shape
    ix, iy = np.clip(np.floor(x), 1, width - 3).astype(int), np.clip(np.floor(y), 1, height - 3).astype(int)
    (wx, dx), (wy, dy) = spline_terms(x - ix), spline_terms(y - iy)
    near = np.arange(-1, 3)
    cells = grid[(iy[:, None] + near)[:, :, None], (ix[:, None] + near)[:, None, :]]
    along = lambda a, b: np.einsum("nj,ni,njid->nd", a, b, cells)
    return along(wy, wx), np.stack((along(wy, dx), along(dy, wx)), 2)


class Camera:
    """A generic camera: a grid of directions over the image, and for a non-central one a grid of points on the rays."""

    def __init__(self, directions, size: tuple[int, int], origins=None):
        self.directions, self.size = np.asarray(directions, float), np.asarray(size, float)
        self.origins = None if origins is None else np.asarray(origins, float)

    def _at(self, grid: np.ndarray, pixel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scale = np.array([grid.shape[1] - 3, grid.shape[0] - 3]) / self.size
        place = 1 + pixel * scale
        value, by = surface(grid, place[:, 0], place[:, 1])
        return value, by * scale

    def rays(self, pixel: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Unit directions and origins (0 of a central camera) of pixels, each with the derivative by the pixel."""
        raw, by = self._at(self.directions, pixel)
        n = np.linalg.norm(raw, axis=1)[:, None]
        d = raw / n
        by = (by - d[:, :, None] * np.einsum("nd,ndk->nk", d, by)[:, None]) / n[:, :, None]
        o, by_o = (np.zeros_like(d), np.zeros_like(by)) if self.origins is None else self._at(self.origins, pixel)
        return d, by, o, by_o

    def _off(self, pixel: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ray's direction less that of the point as seen from the ray's origin, and its derivative by the pixel."""
        d, by, o, by_o = self.rays(pixel)
        to = points - o
        n = np.linalg.norm(to, axis=1)[:, None]
        unit = to / np.where(n > 0, n, 1)
        by_unit = -(by_o - unit[:, :, None] * np.einsum("nd,ndk->nk", unit, by_o)[:, None]) / np.where(n > 0, n, 1)[:, :, None]
        return d - unit, by - by_unit

    def project(self, points: np.ndarray, steps: int = 60, tolerance: float = 1e-11, starts: int = 16) -> tuple[np.ndarray, np.ndarray]:
        """Pixels whose rays the points (for a central camera also directions) lie on, and whether each was found within the image.

        The nearest of starts x starts rays over the image is the start. A step solves the damped 2 x 2
        equations and stays in the image; the damping falls after a step that helps and grows after
        one that doesn't.
        """
        at = np.stack(np.meshgrid(*(np.linspace(0, s, starts) for s in self.size)), -1).reshape(-1, 2)
        d, _, o, _ = self.rays(at)
        best, pixel = np.full(len(points), -np.inf), np.tile(self.size / 2, (len(points), 1))
        for k in range(len(at)):
            to = points - o[k]
            near = to @ d[k] / np.maximum(np.linalg.norm(to, axis=1), 1e-300)
            better = near > best
            best[better], pixel[better] = near[better], at[k]
        damping = np.full(len(points), 1e-3)
        r, jac = self._off(pixel, points)
        cost = (r * r).sum(1)
        live = np.isfinite(points).all(1) & (np.linalg.norm(points, axis=1) > 0)
        for _ in range(steps):
            go = np.flatnonzero(live & (cost > tolerance**2))
            if not len(go):
                break
            h = np.einsum("ndi,ndj->nij", jac[go], jac[go])
            g = np.einsum("ndi,nd->ni", jac[go], r[go])
            h[:, [0, 1], [0, 1]] *= 1 + damping[go, None]
            det = h[:, 0, 0] * h[:, 1, 1] - h[:, 0, 1] ** 2
            safe = np.where(det > 0, det, np.inf)
            step = np.stack((h[:, 1, 1] * g[:, 0] - h[:, 0, 1] * g[:, 1], h[:, 0, 0] * g[:, 1] - h[:, 0, 1] * g[:, 0]), 1) / safe[:, None]
            trial = np.clip(pixel[go] - step, 0, self.size)
            r2, jac2 = self._off(trial, points[go])
            cost2 = (r2 * r2).sum(1)
            better = cost2 < cost[go]
            damping[go] = np.where(better, damping[go] / 10, damping[go] * 10)
            won = go[better]
            pixel[won], r[won], jac[won], cost[won] = trial[better], r2[better], jac2[better], cost2[better]
            live[go] &= damping[go] < 1e12
        found = np.isfinite(cost) & (cost <= (100 * tolerance) ** 2) & np.isfinite(points).all(1)
        return pixel, found


def project_generic(rows: DataFrame, point: list[str], camera: Camera) -> DataFrame:
    """rows with px, py and converged: where the points (directions too, for a central camera) fall in the image; nulls and points off the image have null pixels and converged false."""
    ship(rows.sparkSession)
    fields = [f for f in rows.schema if f.name not in ("px", "py", "converged")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = np.stack([np.asarray(b.column(k), np.float64) for k in point], 1)
            usable = np.isfinite(points).all(1)
            pixel, found = camera.project(np.where(usable[:, None], points, 1.0)) if len(points) else (np.zeros((0, 2)), np.zeros(0, bool))
            found &= usable
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), *(pa.array(p, mask=~found) for p in pixel.T), pa.array(found)], [*(f.name for f in fields), "px", "py", "converged"])

    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "px double, py double, converged boolean"]))
