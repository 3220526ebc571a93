"""Fusion of detections of the same images by several datasets."""

from __future__ import annotations

from collections import defaultdict
from functools import cached_property
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.ship import ship


class _Grid:
    """One dataset's points of an image in cells of the radius; points may be taken out."""

    def __init__(self, xy: np.ndarray, radius: np.float32):
        self.xy, self.there, self.radius = xy, np.ones(len(xy), bool), float(radius)
        at = self._cell(xy)
        (self.rows, i), (self.columns, j) = (np.unique(at[:, k], return_inverse=True) for k in (0, 1))
        key = i * (len(self.columns) + 1) + j
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]

    def _cell(self, xy: np.ndarray) -> np.ndarray:
        return np.floor(xy.astype(np.float64) / max(self.radius, 1e-12)).astype(np.int64)

    @cached_property
    def cells(self) -> dict[tuple[int, int], list[int]]:
        cells = defaultdict(list)
        for k, (i, j) in enumerate(self._cell(self.xy).tolist()):
            cells[i, j].append(k)
        return cells

    def nearest(self, centre: np.ndarray) -> int:
        """The point within the radius that is nearest (of equal ones the last), or -1."""
        i, j = self._cell(centre).tolist()
        best, found = self.radius**2, -1
        near = sorted(k for a in (i - 1, i, i + 1) for b in (j - 1, j, j + 1) for k in self.cells.get((a, b), ()) if self.there[k])
        for k in near:
            d = self.xy[k] - centre
            square = float(d[0] * d[0] + d[1] * d[1])
            if square <= best:
                best, found = square, k
        return found

    def nearest_of_all(self, centres: np.ndarray) -> np.ndarray:
        """nearest of many centres at once, among all points, taken out or not."""
        out = np.full(len(centres), -1)
        if not len(self.xy) or not len(centres):
            return out
        at = self._cell(centres)
        low, high = np.searchsorted(self.columns, at[:, 1] - 1), np.searchsorted(self.columns, at[:, 1] + 1, "right")
        who, which = [], []
        for d in (-1, 0, 1):
            row = np.searchsorted(self.rows, at[:, 0] + d)
            row[row == len(self.rows)] = 0
            c = np.flatnonzero((self.rows[row] == at[:, 0] + d) & (low < high))
            start, end = (np.searchsorted(self.key, row[c] * (len(self.columns) + 1) + x[c]) for x in (low, high))
            n = end - start
            who.append(np.repeat(c, n))
            which.append(self.order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)])
        who, which = np.concatenate(who), np.concatenate(which)
        d = self.xy[which] - centres[who]
        square = d[:, 0] * d[:, 0] + d[:, 1] * d[:, 1]
        good = square.astype(np.float64) <= self.radius**2
        who, which, square = who[good], which[good], square[good]
        order = np.lexsort((-which, square, who))
        first, at = np.unique(who[order], return_index=True)
        out[first] = which[order][at]
        return out


def _mean(grids: list[_Grid], covered: np.ndarray) -> np.ndarray:
    """The mean of the covered points (rows of indices, one per dataset, -1 for none), added in the datasets' order."""
    total = np.zeros((len(covered), 2), np.float32)
    for g, k in zip(grids, covered.T, strict=True):
        if len(g.xy):
            total += np.where((k >= 0)[:, None], g.xy[k], np.float32(0))
    return total / (covered >= 0).sum(1, dtype=np.float32)[:, None]


def _settle(grids: list[_Grid], start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where centres from the starts end while all points are there: the covered points, the centres, and each (point, start) that was covered on the way, points numbered over all datasets."""
    offsets = np.cumsum([0, *(len(g.xy) for g in grids)])[:-1]
    covered, centres = np.full((len(start), len(grids)), -1), start.copy()
    active, ways, history = np.arange(len(start)), [], []
    while len(active):
        now = np.stack([g.nearest_of_all(centres[active]) for g in grids], 1)
        covered[active], centres[active] = now, _mean(grids, now)
        ways.append(np.stack(((now + offsets)[now >= 0], np.broadcast_to(active[:, None], now.shape)[now >= 0]), 1))
        going = np.ones(len(active), bool)
        for before in history:
            going &= (before != now).any(1)
        history = [before[going] for before in [*history, now]]
        active = active[going]
    ways = np.unique(np.concatenate(ways), axis=0) if ways else np.zeros((0, 2), np.int64)
    return covered, centres, ways


def fuse(points: list[np.ndarray], radius: float) -> list[np.ndarray]:
    """Which points (n x 2, float32) of each dataset are kept.

    Points of the first dataset are taken in order. A centre starts on the point and moves to the
    mean of the points nearest to it, one of each dataset within the radius, until these don't
    change. If every dataset has one, the centre is kept, else the covered points are taken out of further search. At the
    end those remain that are within the radius of a kept centre.

    All centres are moved at once as if no point was taken out. That holds for a centre unless a
    point that it covered on its way was taken out before its turn, so only centres that take
    points out, and those that covered such points, have a turn of their own.
    """
    radius = np.float32(radius)
    grids = [_Grid(xy.astype(np.float32), radius) for xy in points]
    offsets = np.cumsum([0, *(len(g.xy) for g in grids)])[:-1].tolist()
    settled, centres, ways = _settle(grids, grids[0].xy)
    kept = (settled >= 0).all(1)
    turns = np.flatnonzero(~kept).tolist()  # ascending, so a heap
    queued, stale = ~kept, np.zeros(len(kept), bool)
    while turns:
        f = heappop(turns)
        kept[f] = False
        while grids[0].there[f]:
            covered, centre = settled[f].tolist(), centres[f]
            if stale[f]:
                centre, seen = grids[0].xy[f], set()
                while True:
                    covered = tuple(g.nearest(centre) for g in grids)
                    centre = _mean(grids, np.array([covered]))[0]
                    if covered in seen:
                        break
                    seen.add(covered)
            if all(k >= 0 for k in covered):
                kept[f], centres[f] = True, centre
                break
            for n, (g, k) in enumerate(zip(grids, covered, strict=True)):
                if k < 0:
                    continue
                g.there[k] = False
                lo, hi = np.searchsorted(ways[:, 0], (offsets[n] + k, offsets[n] + k + 1))
                for other in {*ways[lo:hi, 1].tolist(), *([k] if n == 0 else [])}:
                    if other >= f:
                        stale[other] = True
                    if other > f and not queued[other]:
                        queued[other] = True
                        heappush(turns, other)
            if covered[0] >= 0:
                break  # else the centre has left the first dataset's points: once more without those taken out
    near = _Grid(centres[kept], radius)
    return [g.there & (near.nearest_of_all(g.xy) >= 0) for g in grids]


def intersect_datasets(features: DataFrame, imagesets: DataFrame, datasets: int, radius: float) -> DataFrame:
    """The features of images that all datasets have, kept where all datasets see the same point.

    features: dataset (from 0), filename, camera, feature_pos (order in the image), x, y and more
    columns, which stay; imagesets: dataset, filename. feature_pos is counted anew. The order of
    the first dataset's features decides. A group is one image of one camera. Features with null
    keys or coordinates are left out; an image that a dataset lists without features keeps none.
    """
    ship(features.sparkSession)
    everywhere = imagesets.where(F.col("dataset").between(0, datasets - 1)).select("dataset", "filename").distinct().groupBy("filename").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == datasets).select("filename")
    rows = features.dropna(subset=["dataset", "filename", "camera", "feature_pos", "x", "y"]).where(F.col("dataset").between(0, datasets - 1)).join(everywhere, "filename").select(*features.columns)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("dataset", "ascending"), ("feature_pos", "ascending")])
        of = np.asarray(table.column("dataset"))
        xy = np.stack((np.asarray(table.column("x"), np.float32), np.asarray(table.column("y"), np.float32)), 1)
        keep = np.concatenate(fuse([xy[of == d] for d in range(datasets)], radius))
        out = table.filter(pa.array(keep))
        left = of[keep]
        place = np.arange(len(left)) - np.searchsorted(left, left)
        at = out.schema.get_field_index("feature_pos")
        return out.set_column(at, "feature_pos", pa.array(place).cast(out.schema.field(at).type))

    return rows.groupBy("filename", "camera").applyInArrow(run, rows.schema)
