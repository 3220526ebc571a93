"""Kernels on groups of many rows."""

import numpy as np
from pyspark.sql import functions as F

from sightline.functions import kernels as K


def test_view_pose_of_many_pairs(spark):
    """Views of 100,000 different pairs, one in ten wrong, in blocks; one of a few pairs that occur often, and one of too few."""
    k = F.col("id")
    c = spark.range(100_000).select((k % 2).alias("view"), (k % 101 / 50.0 - 1).alias("x"), (F.floor(k / 101) % 97 / 50.0 - 0.9).alias("y"), (k % 89 / 40.0).alias("z"), k)
    c = c.unionByName(spark.range(600).select(F.lit(2).cast("long").alias("view"), (k % 3 / 2.0).alias("x"), (F.floor(k / 3) % 2 / 2.0).alias("y"), (F.floor(k / 6) % 2 / 3.0 + k % 3 / 7.0).alias("z"), F.lit(1).alias("id")))
    c = c.unionByName(spark.range(5).select(F.lit(3).cast("long").alias("view"), (k / 2.0).alias("x"), (k / 3.0).alias("y"), (k / 5.0).alias("z"), k))
    depth = F.col("z") + 4 + F.col("view")
    wrong = F.when(k % 10 == 0, 0.3).otherwise(0.0)
    c = c.withColumns({"u": (F.col("x") + 0.1) / depth + wrong, "v": (F.col("y") - 0.2) / depth})
    got = {r.view: r for r in K.view_pose(c, "view", ["x", "y", "z"], ["u", "v"]).collect()}
    assert set(got) == {0, 1, 2}
    for view, r in got.items():
        assert np.allclose(r.translation, [0.1, -0.2, 4 + view], atol=1e-7) and np.allclose(np.reshape(r.rotation, (3, 3)), np.eye(3), atol=1e-7)
        assert r.median_error < 1e-9
    assert got[1].inliers == 50_000 and got[0].inliers == 40_000 and got[2].inliers == 600
