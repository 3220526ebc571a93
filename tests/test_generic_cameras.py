"""Projection into generic cameras: spline derivatives, round trips at borders too, and points that no ray meets."""

import numpy as np
from pyspark.sql import functions as F

from sightline.operators.generic_cameras import Camera, project_generic, surface


def grids(h=7, w=9, seed=1):
    rng = np.random.default_rng(seed)
    x, y = np.meshgrid(np.linspace(-0.8, 0.8, w), np.linspace(-0.6, 0.6, h))
    d = np.stack((x + 0.02 * rng.normal(size=x.shape), y + 0.02 * rng.normal(size=x.shape), np.ones_like(x)), 2)
    return d / np.linalg.norm(d, axis=2, keepdims=True), 0.02 * rng.normal(size=(h, w, 3))


def test_spline_derivatives():
    grid, _ = grids()
    rng = np.random.default_rng(2)
    x, y = rng.uniform(1, 6.99, 50), rng.uniform(1, 4.99, 50)
    v, d = surface(grid, x, y)
    for k, (a, b) in enumerate(((1e-6, 0), (0, 1e-6))):
        assert np.abs((surface(grid, x + a, y + b)[0] - surface(grid, x - a, y - b)[0]) / 2e-6 - d[:, :, k]).max() < 1e-6
    assert np.allclose(surface(np.ones((5, 5, 2)), np.array([1.0, 2.0]), np.array([2.0, 1.5]))[0], 1.0)


def test_project_after_unproject():
    d, o = grids()
    rng = np.random.default_rng(3)
    pixel = np.concatenate((rng.uniform(0, 1, (300, 2)) * [640, 480], [[0, 0], [640, 480], [0, 480], [640, 0], [320, 0], [0, 200.5]]))
    for camera in (Camera(d, (640, 480)), Camera(d, (640, 480), o)):
        ray, _, origin, _ = camera.rays(pixel)
        got, found = camera.project(origin + ray * rng.uniform(1, 20, (len(pixel), 1)))
        assert found.all() and np.abs(got - pixel).max() < 1e-6
        wrong = np.array([[0, 0, -1.0], [5.0, 0, 0.1], [0, 0, 0], [np.inf, 0, 1]])
        assert not camera.project(wrong)[1].any()


def test_operator(spark):
    d, _ = grids()
    camera = Camera(d, (640, 480))
    ray = camera.rays(np.array([[100.0, 50.0]]))[0][0]
    df = spark.createDataFrame([(1, *map(float, ray)), (2, 0.0, 0.0, -1.0), (3, None, 0.0, 1.0)], "id long, x double, y double, z double").withColumn("px", F.lit("old"))
    got = {r.id: r for r in project_generic(df, ["x", "y", "z"], camera).collect()}
    assert got[1].converged and abs(got[1].px - 100) < 1e-6 and abs(got[1].py - 50) < 1e-6
    assert not got[2].converged and got[2].px is None and not got[3].converged
    assert project_generic(df.limit(0), ["x", "y", "z"], camera).count() == 0
