"""Raster operators against flood fills and plain loops."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from sightline.operators import raster as G

SCHEMA = "image int, x long, y long, v double"


def flood(pixels, ratio=None):
    """(x, y) -> (label, size) by a stack."""
    done = {}
    for start in sorted(pixels, key=lambda p: (p[1], p[0])):
        if start in done:
            continue
        seen, stack = {start}, [start]
        while stack:
            x, y = stack.pop()
            for n in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if n in pixels and n not in seen and (ratio is None or max(pixels[n] / pixels[x, y], pixels[x, y] / pixels[n]) < ratio):
                    seen.add(n)
                    stack.append(n)
        done |= {p: ((start[1], start[0]), len(seen)) for p in seen}
    return done


def spiral(n):
    out, x, y, dx, dy = {}, 0, 0, 1, 0
    lengths = [n - 1, n - 1, n - 1] + [k for k in range(n - 3, 0, -2) for _ in (0, 1)]
    out[0, 0] = 1.0
    for length in lengths:
        for _ in range(length):
            x, y = x + dx, y + dy
            out[x, y] = 1.0
        dx, dy = -dy, dx
    return out


def test_components_of_spirals_and_noise(spark):
    r = random.Random(1)
    images = {0: spiral(23), 1: {(x, y): r.choice([1.0, 3.0, 0.0]) for x in range(30) for y in range(20) if r.random() < 0.8}, 2: {(x - 5, y - 7): float(r.randint(1, 9)) for x in range(14) for y in range(14)}, 3: {(0, 0): 5.0}}
    rows = [(k, x, y, v) for k, p in images.items() for (x, y), v in p.items()] + [(1, 100, 100, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"label": F.lit(1), "size": F.lit(2), "tx": F.lit(3)})
    for ratio in (None, 2.0):
        got = {(r.image, r.x, r.y): ((r.label.y, r.label.x), r.size) for r in G.components(df, ratio=ratio, tile=6).collect()}
        want = {(k, *p): found for k, image in images.items() for p, found in flood({q: v for q, v in image.items() if v != 0.0}, ratio).items()}
        assert got == want
    assert max(n for (k, *_), (_, n) in got.items() if k == 0) == len(images[0]) > 200
    whole = {(r.image, r.x, r.y): r.v for r in G.without_small(df, 10, ratio=2.0, tile=6).collect()}
    assert whole[3, 0, 0] == 0.0 and whole[0, 0, 0] == 1.0 and whole[1, 100, 100] is None and len(whole) == len(rows)
    assert G.components(df.limit(0), tile=6).count() == 0


def test_joined_labels_of_long_paths():
    n = 5000
    order = np.random.default_rng(2).permutation(n)
    labels = G.joined_labels(n, order[:-1], order[1:])
    assert (labels == 0).all()
    assert G.joined_labels(3, np.zeros(0, int), np.zeros(0, int)).tolist() == [0, 1, 2]


def test_bilateral_and_median(spark):
    r = random.Random(3)
    p = {(x, y): r.choice([0.0, 1.5, 4.0, 9.0]) for x in range(25) for y in range(18) if r.random() < 0.9}
    df = spark.createDataFrame([(7, x, y, v) for (x, y), v in p.items()] + [(7, 50, 50, None)], SCHEMA)
    got = {(r.x, r.y): r.v for r in G.bilateral(df, 1.2, 3.0, radius_factor=2.5, tile=5).collect()}
    assert len(got) == len(p) + 1 and got[50, 50] is None
    for (x, y), v in p.items():
        if v == 0.0:
            assert got[x, y] == 0.0
            continue
        total = weight = 0.0
        for a in range(-3, 4):
            for b in range(-3, 4):
                s = p.get((x + a, y + b), 0.0)
                if a * a + b * b <= 9 and s != 0.0:
                    w = math.exp(-(a * a + b * b) / (2 * 1.44)) * math.exp(-((v - s) ** 2) / 18.0)
                    total, weight = total + w * s, weight + w
        assert abs(got[x, y] - total / weight) < 1e-9
    for ignore in (None, 0.0):
        got = {(r.x, r.y): r.v for r in G.median_scaled(df.where("v is not null"), (25, 18), (7, 4), ignore).collect()}
        want = {}
        for x in range(7):
            for y in range(4):
                vs = sorted(p[i, j] for i in range(25 * x // 7, 25 * (x + 1) // 7) for j in range(18 * y // 4, 18 * (y + 1) // 4) if (i, j) in p and p[i, j] != ignore)
                if vs:
                    low, high, mean = vs[(len(vs) - 1) // 2], vs[len(vs) // 2], sum(vs) / len(vs)
                    want[x, y] = low if abs(mean - low) < abs(mean - high) else high
        assert got == want


def test_cut_and_flip(spark):
    df = spark.createDataFrame([(0, 1, 2, 5.0), (0, 0, 0, 1.0)], SCHEMA)
    assert [r.v for r in df.select(G.cut_off(F.col("v"), 2.0, -1.0).alias("v")).collect()] == [-1.0, 1.0]
    assert sorted((r.x, r.y) for r in G.flipped(df, 3, 4).collect()) == [(1, 1), (2, 3)]
    assert sorted((r.x, r.y) for r in G.flipped(df, height=4).collect()) == [(0, 3), (1, 1)]
