"""Convex clipping against a plain half-plane clip, and touching, disjoint and contained cases."""

import math
import random

from pyspark.sql import functions as F

from sightline.functions.polygons import CORNERS, clip_convex, polygon_area


def plain_area(p):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1], strict=True))) / 2


def plain_clip(p, c):
    if sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(c, c[1:] + c[:1], strict=True)) < 0:
        c = c[::-1]
    for a, b in zip(c, c[1:] + c[:1], strict=True):
        side = lambda q: (b[0] - a[0]) * (q[1] - a[1]) - (b[1] - a[1]) * (q[0] - a[0])  # noqa: B023, E731
        out = []
        for q, r in zip(p, p[1:] + p[:1], strict=True):
            s, t = side(q), side(r)
            if s >= 0:
                out.append(q)
            if s * t < 0:
                k = s / (s - t)
                out.append((q[0] + k * (r[0] - q[0]), q[1] + k * (r[1] - q[1])))
        p = out
    return p


def convex(r, n):
    angles = sorted(r.uniform(0, 2 * math.pi) for _ in range(n))
    x, y, size = r.uniform(-1, 1), r.uniform(-1, 1), r.uniform(0.2, 1.5)
    p = [(x + size * math.cos(a), y + size * math.sin(a)) for a in angles]
    return p if r.random() < 0.5 else p[::-1]


def test_clipping(spark):
    r = random.Random(1)
    square = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    moved = lambda x, y, k=1.0: [(x + k * a, y + k * b) for a, b in square]
    cases = [(convex(r, r.randint(3, 8)), convex(r, r.randint(3, 7))) for _ in range(300)]
    cases += [(square, moved(1, 0)), (square, moved(1, 1)), (square, moved(3, 3)), (square, moved(-1, -1, 5)), (moved(0.25, 0.25, 0.5), square), (square, square[::-1]), (square, square[:2]), ([], square)]
    rows = [(k, [tuple(x) for x in a], [tuple(x) for x in b]) for k, (a, b) in enumerate(cases)] + [(-1, None, square), (-2, square, None)]
    df = spark.createDataFrame(rows, f"id int, a {CORNERS}, b {CORNERS}")
    got = {x.id: x for x in df.select("id", clip_convex(F.col("a"), F.col("b")).alias("p"), polygon_area(clip_convex(F.col("a"), F.col("b"))).alias("area")).collect()}
    for k, (a, b) in enumerate(cases):
        want = plain_area(plain_clip(a, b)) if len(b) > 2 else 0.0
        assert abs(got[k].area - want) < 1e-9, (k, a, b)
    n = len(cases) - 8
    assert [round(got[n + k].area, 9) for k in range(8)] == [0.0, 0.0, 0.0, 1.0, 0.25, 1.0, 0.0, 0.0]
    assert len(got[n + 2].p) == 0 and got[-1].p is None and got[-2].area is None
