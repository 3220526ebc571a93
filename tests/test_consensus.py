"""Votes that most others agree with, without the distances of all pairs put in order."""

import numpy as np

from sightline.operators import motion as M


def test_only_leading_votes_distances_are_ordered(spark, monkeypatch):
    rng = np.random.default_rng(4)
    d = rng.normal(size=(2, 150, 3))
    rows = [(f, 1 + g, g, *map(float, d[g, f]), 0.0, 0.0, 0.0, 1.0) for g in range(2) for f in range(150)]
    votes = spark.createDataFrame(rows, "frame long, target int, reference int, dx double, dy double, dz double, ex double, ey double, ez double, ew double")
    ordered = []

    def counted(rows, *more):
        ordered.append(rows.count())
        return quantiles(rows, *more)

    quantiles = M.grouped_quantiles
    monkeypatch.setattr(M, "grouped_quantiles", counted)
    got = {r.reference: r for r in M.relative_consensus(votes, 1.0, 180.0, least=2).collect()}
    leaders = 0
    for g in range(2):
        apart = np.linalg.norm(d[g][:, None] - d[g][None], axis=2)
        n = (apart <= 1.0).sum(1)
        middle = np.array([np.median(a[a <= 1.0]) for a in apart])
        best = min(range(150), key=lambda f: (-n[f], round(middle[f], 9), f))
        assert (got[g].frame, got[g].inliers) == (best, n[best]) and abs(got[g].middle - middle[best]) < 1e-9
        leaders += n[n == n.max()].sum()
    assert ordered == [leaders]
