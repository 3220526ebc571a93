"""Fusion of many points at once."""

import numpy as np

from sightline.operators import fusion as U


def test_points_that_lose_nothing_have_no_turn_of_their_own(monkeypatch):
    """20,000 places apart from each other, some missing in a dataset: kept where all have them, without a search for each point."""
    n = 20_000
    place = np.stack((np.arange(n) % 200 * 10.0, np.arange(n) // 200 * 10.0), 1)
    there = [np.arange(n) % 7 != d for d in range(3)]
    points = [(place[t] + 0.1 * d).astype(np.float32) for d, t in enumerate(there)]

    def searched(*_):
        raise AssertionError("a point was searched alone")

    monkeypatch.setattr(U._Grid, "nearest", searched)
    whole = there[0] & there[1] & there[2]
    for t, keep in zip(there, U.fuse(points, 3.0), strict=True):
        assert np.array_equal(np.flatnonzero(t)[keep], np.flatnonzero(whole))
