"""Rigid motions as column expressions.

A vector is three columns, a quaternion four (x, y, z, w), a pose a pair (quaternion, vector) that
maps p to rotate(quaternion, p) + vector. Everything stays in generated JVM code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Vector = tuple[Column, Column, Column]
Quaternion = tuple[Column, Column, Column, Column]
Pose = tuple[Quaternion, Vector]


def dot(a: tuple, b: tuple) -> Column:
    return reduce(lambda x, y: x + y, (p * q for p, q in zip(a, b, strict=True)))


def cross(a: Vector, b: Vector) -> Vector:
    return a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]


def add(a: Vector, b: Vector) -> Vector:
    return tuple(x + y for x, y in zip(a, b, strict=True))


def sub(a: Vector, b: Vector) -> Vector:
    return tuple(x - y for x, y in zip(a, b, strict=True))


def scaled(a: tuple, k: Column) -> tuple:
    return tuple(x * k for x in a)


def norm(a: tuple) -> Column:
    return F.sqrt(dot(a, a))


def unit(q: tuple) -> tuple:
    n = norm(q)
    return tuple(x / n for x in q)


def multiply(a: Quaternion, b: Quaternion) -> Quaternion:
    """The rotation b followed by a."""
    (u, s), (v, r) = (a[:3], a[3]), (b[:3], b[3])
    return (*add(add(scaled(v, s), scaled(u, r)), cross(u, v)), s * r - dot(u, v))


def conjugate(q: Quaternion) -> Quaternion:
    return -q[0], -q[1], -q[2], q[3]


def rotate(q: Quaternion, p: Vector) -> Vector:
    """p turned by a unit quaternion."""
    once = scaled(cross(q[:3], p), F.lit(2.0))
    return add(p, add(scaled(once, q[3]), cross(q[:3], once)))


def transform(pose: Pose, p: Vector) -> Vector:
    return add(rotate(pose[0], p), pose[1])


def compose(a: Pose, b: Pose) -> Pose:
    """The motion b followed by a."""
    return multiply(a[0], b[0]), transform(a, b[1])


def invert(pose: Pose) -> Pose:
    back = conjugate(pose[0])
    return back, scaled(rotate(back, pose[1]), F.lit(-1.0))


def to_matrix(q: Quaternion) -> list[Column]:
    """The nine entries, row by row, of a unit quaternion's matrix."""
    axes = [rotate(q, tuple(F.lit(1.0 if k == j else 0.0) for k in range(3))) for j in range(3)]
    return [axes[j][i] for i in range(3) for j in range(3)]


def from_matrix(m: list[Column]) -> Quaternion:
    """The unit quaternion, w not negative, of a rotation matrix; the largest of x, y, z and w is taken from the diagonal."""
    d = (m[0], m[4], m[8])
    four = [1 + d[0] - d[1] - d[2], 1 - d[0] + d[1] - d[2], 1 - d[0] - d[1] + d[2], 1 + d[0] + d[1] + d[2]]  # 4 x^2, 4 y^2, 4 z^2, 4 w^2
    mixed = {(0, 1): m[1] + m[3], (0, 2): m[2] + m[6], (1, 2): m[5] + m[7], (0, 3): m[7] - m[5], (1, 3): m[2] - m[6], (2, 3): m[3] - m[1]}
    most = F.greatest(*four)

    def entry(k: int) -> Column:
        out = None
        for lead in (3, 0, 1, 2):
            root = F.sqrt(F.greatest(four[lead], F.lit(0.0))) / 2
            value = root if k == lead else mixed[min(k, lead), max(k, lead)] / (4 * root)
            out = F.when(four[lead] == most, value) if out is None else out.when(four[lead] == most, value)
        return out

    q = tuple(entry(k) for k in range(4))
    sign = F.when(q[3] < 0, -1.0).otherwise(1.0)
    return scaled(q, sign)


def exp(w: Vector) -> Quaternion:
    """The rotation about w by its length."""
    a = norm(w)
    k = F.when(a > 1e-12, F.sin(a / 2) / a).otherwise(0.5)
    return (*scaled(w, k), F.cos(a / 2))


def log(q: Quaternion) -> Vector:
    """The rotation vector, at most pi long, of a unit quaternion."""
    sign = F.when(q[3] < 0, -1.0).otherwise(1.0)
    s = norm(q[:3])
    return scaled(q[:3], F.when(s > 1e-12, 2 * F.atan2(s, sign * q[3]) / s * sign).otherwise(2.0))


def skew(w: Vector) -> list[Column]:
    """The nine entries, row by row, of the matrix of the cross product with w."""
    o = F.lit(0.0)
    return [o, -w[2], w[1], w[2], o, -w[0], -w[1], w[0], o]


def exp_motion(w: Vector, v: Vector) -> Pose:
    """The motion with constant turn w and speed v over one unit of time."""
    a = norm(w)
    b = F.when(a > 1e-6, (1 - F.cos(a)) / (a * a)).otherwise(0.5)
    c = F.when(a > 1e-6, (a - F.sin(a)) / (a * a * a)).otherwise(1.0 / 6)
    once = cross(w, v)
    return exp(w), add(v, add(scaled(once, b), scaled(cross(w, once), c)))


def slerp(a: Quaternion, b: Quaternion, share: Column) -> Quaternion:
    """From a to b along the shorter arc."""
    near = dot(a, b)
    b = scaled(b, F.when(near < 0, -1.0).otherwise(1.0))
    angle = F.acos(F.least(F.abs(near), F.lit(1.0)))
    flat = angle < 1e-9
    k = F.when(flat, 1 - share).otherwise(F.sin((1 - share) * angle) / F.sin(angle))
    m = F.when(flat, share).otherwise(F.sin(share * angle) / F.sin(angle))
    return add(scaled(a, k), scaled(b, m))


def angle(a: Quaternion, b: Quaternion) -> Column:
    """Degrees between two rotations."""
    return F.degrees(2 * F.acos(F.least(F.abs(dot(a, b)), F.lit(1.0))))


def euler(q: Quaternion) -> tuple[Column, Column, Column]:
    """Yaw, pitch and roll in degrees (turns about z, then y, then x)."""
    m = to_matrix(q)
    return F.degrees(F.atan2(m[3], m[0])), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -m[6])))), F.degrees(F.atan2(m[7], m[8]))
