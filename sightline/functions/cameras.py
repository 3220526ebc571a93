"""Camera models as column expressions: projection, unprojection, splines, sampling."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions import poses as P


def prism_shift(u: Column, v: Column, p1: float, p2: float, sx: float, sy: float) -> tuple[Column, Column]:
    """Tangential and thin-prism shift of a normalised point."""
    r2 = u * u + v * v
    return 2 * p1 * u * v + p2 * (r2 + 2 * u * u) + sx * r2, 2 * p2 * u * v + p1 * (r2 + 2 * v * v) + sy * r2


def project_thin_prism(x: Column, y: Column, z: Column, p: dict[str, float], equidistant: bool = True) -> tuple[Column, Column]:
    """Fisheye projection with radial (k1..k4), tangential and thin-prism terms; null behind the camera."""
    u, v = F.when(z > 0, x / z), F.when(z > 0, y / z)
    r = F.hypot(u, v)
    k = F.when(r > 1e-6, F.atan(r) / r).otherwise(1.0) if equidistant else F.lit(1.0)
    u, v = u * k, v * k
    r2 = u * u + v * v
    radial = r2 * (p["k1"] + r2 * (p["k2"] + r2 * (p["k3"] + r2 * p["k4"])))
    dx, dy = prism_shift(u, v, p["p1"], p["p2"], p["sx1"], p["sy1"])
    return p["fx"] * (u + radial * u + dx) + p["cx"], p["fy"] * (v + radial * v + dy) + p["cy"]


def unproject_equidistant(px: Column, py: Column, p: dict[str, float], steps: int = 20) -> P.Vector:
    """The unit direction that a pixel of the odd-polynomial fisheye model (k1..k4) looks along: Newton steps on the angle."""
    mx, my = (px - p["cx"]) / p["fx"], (py - p["cy"]) / p["fy"]
    r = F.hypot(mx, my)
    k = [p.get(f"k{n}", 0.0) for n in range(1, 5)]

    def step(theta: Column, _: Column) -> Column:
        t2 = theta * theta
        value = theta * (1 + t2 * (k[0] + t2 * (k[1] + t2 * (k[2] + t2 * k[3])))) - r
        slope = 1 + t2 * (3 * k[0] + t2 * (5 * k[1] + t2 * (7 * k[2] + t2 * 9 * k[3])))
        return theta - value / slope

    theta = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), r, step)
    s = F.when(r > 1e-12, F.sin(theta) / r).otherwise(1.0)
    return mx * s, my * s, F.cos(theta)


def constants(values: list[float]) -> Column:
    """Numbers as one array expression, which the optimizer folds: small plans even where it is used often."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<double>")


def spline_weights(t: Column) -> tuple[Column, Column, Column, Column]:
    """Weights of the four control values around a uniform cubic B-spline's interval, at share t of it."""
    s, t2, t3 = 1 - t, t * t, t * t * t
    return s * s * s / 6, (3 * t3 - 6 * t2 + 4) / 6, (-3 * t3 + 3 * t2 + 3 * t + 1) / 6, t3 / 6


def spline(values: list[float], at: Column) -> Column:
    """A uniform cubic B-spline over its control values at place at, 1 at the least and len - 2 at the most; outside, the end pieces go on."""
    chunk = F.greatest(F.lit(1), F.least(F.lit(len(values) - 3), F.floor(at))).cast("int")
    control = constants(values)
    return P.dot(spline_weights(at - chunk), tuple(F.get(control, chunk + k) for k in (-1, 0, 1, 2)))


def surface(grid: list[list[list[float]]], x: Column, y: Column) -> list[Column]:
    """A uniform cubic B-spline surface over a grid (rows of cells of numbers) at (x, y), one column for each number of a cell. Inside, 1 <= x < width - 2, and y alike."""
    width, height, depth = len(grid[0]), len(grid), len(grid[0][0])
    ix, iy = (F.greatest(F.lit(1), F.least(F.lit(n - 3), F.floor(a))).cast("int") for a, n in ((x, width), (y, height)))
    wx, wy = spline_weights(x - ix), spline_weights(y - iy)
    flat = constants([float(v) for row in grid for cell in row for v in cell])
    cell = lambda j, i, d: F.get(flat, ((iy + j) * width + ix + i) * depth + d)
    return [P.dot(wy, tuple(P.dot(wx, tuple(cell(j, i, d) for i in (-1, 0, 1, 2))) for j in (-1, 0, 1, 2))) for d in range(depth)]


def project_radial_spline(x: Column, y: Column, z: Column, p: dict[str, float], values: list[float]) -> tuple[Column, Column]:
    """Pinhole projection whose radial factor is a spline of the angle from the axis; null behind the camera."""
    u, v = F.when(z > 0, x / z), F.when(z > 0, y / z)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), z / P.norm((x, y, z)))))
    factor = spline(values, 1 + (len(values) - 3) / (F.pi() / 2) * angle)
    dx, dy = prism_shift(u, v, p["p1"], p["p2"], p["sx1"], p["sy1"])
    return p["fx"] * (u + factor * u + dx) + p["cx"], p["fy"] * (v + factor * v + dy) + p["cy"]


def grid_place(px: Column, py: Column, grid: list, size: tuple[int, int]) -> tuple[Column, Column]:
    """Where a pixel lies in the grid of a generic camera, which spans the image; as columns of their own they keep surface() small."""
    return 1 + px / size[0] * (len(grid[0]) - 3), 1 + py / size[1] * (len(grid) - 3)


def unproject_grid(px: Column, py: Column, grid: list, size: tuple[int, int]) -> P.Vector:
    """The unit direction of a pixel of a generic camera, from its grid of directions."""
    return P.unit(tuple(surface(grid, *grid_place(px, py, grid, size))))


def unproject_line(px: Column, py: Column, directions: list, origins: list, size: tuple[int, int]) -> tuple[P.Vector, P.Vector]:
    """The line of a pixel of a non-central camera: its unit direction and a point of it, from two grids."""
    return unproject_grid(px, py, directions, size), tuple(surface(origins, *grid_place(px, py, origins, size)))


def field_of_view(a: P.Vector, b: P.Vector) -> Column:
    """Degrees between the unit directions of two borders of the image."""
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), P.dot(a, b)))))


def triangle_area(a: tuple, b: tuple, c: tuple) -> Column:
    """Of three points in the plane or in space."""
    three = lambda p: p if len(p) == 3 else (*p, F.lit(0.0))
    return P.norm(P.cross(P.sub(three(b), three(a)), P.sub(three(c), three(a)))) / 2


def line_crossing(a: tuple, b: tuple, c: tuple, d: tuple) -> tuple[Column, Column]:
    """Where the line through a and b meets that through c and d; null where they are parallel."""
    ux, uy, vx, vy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
    det = ux * vy - uy * vx
    s = ((c[0] - a[0]) * vy - (c[1] - a[1]) * vx) / F.when(det != 0, det)
    return a[0] + s * ux, a[1] + s * uy


def bilinear(v00: Column, v10: Column, v01: Column, v11: Column, fx: Column, fy: Column) -> Column:
    return (v00 * (1 - fx) + v10 * fx) * (1 - fy) + (v01 * (1 - fx) + v11 * fx) * fy
