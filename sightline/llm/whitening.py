"""Whitening of vectors with the leading eigenvectors of their covariance, found by LOBPCG.

The covariance is never formed. Each step multiplies it with a small block of directions: every
partition centres its rows and adds up rows' outer products with their projections on the block, and
the partial blocks are added by Spark. The driver holds blocks of d x (a few dozen) numbers only:
the iterate, the residuals and the previous directions, which Rayleigh-Ritz combines. It stops when
the residuals of a fresh product are certified small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .cluster import bounded_batches, cut

#: x = floor(SCALE * c) + SHIFT; a scaled entry beyond +-LARGEST is taken as that.
SCALE, SHIFT, LARGEST = 64, 1_000_000, 2**62
_LOW = (1 << 31) - 1


@dataclass
class Fit:
    """The rows of a whitening and what their covariance is: n rows, the exact sums per dimension, the trace, components (d x k, unit columns) and eigenvalues, falling; residual is the certified one."""

    rows: DataFrame
    n: int
    sums: list[int]
    trace: float
    components: np.ndarray
    values: np.ndarray
    residual: float
    rounds: int

    @property
    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as a whole number and the rest, so that centring loses nothing to large entries."""
        whole = [s // self.n for s in self.sums] if self.n else []
        return np.array(whole, np.int64), np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)], np.float64)

    @property
    def scales(self) -> np.ndarray:
        """1 / sqrt(eigenvalue); nan where the rows have no variance to divide by."""
        some = self.values > 1e-13 * max(self.trace, 0.0)
        return np.where(some, 1 / np.sqrt(np.where(some, self.values, 1.0)), np.nan)


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """_id and x (array of long) of the rows whose vector is not null and has only finite entries."""
    c = F.col(vector_col)
    limit = F.lit(float("inf"))
    good = F.coalesce(F.forall(c, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < limit), F.lit(False))), F.lit(False))
    x = F.transform(c, lambda v: F.floor(F.least(F.greatest(v.cast("double") * SCALE, F.lit(float(-LARGEST))), F.lit(float(LARGEST)))).cast("long") + SHIFT)
    return vectors.where(good).select(F.col(id_col).alias("_id"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sums of the d dimensions, from partial sums per partition in two halves of the bits."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(0))
                n += len(x)
                total = [t + (int(h) << 31) + int(w) for t, h, w in zip(total, (x >> 31).sum(0), (x & _LOW).sum(0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(d)], pa.int32()), pa.array([n, *total], pa.decimal128(38, 0))], ["place", "s"])

    got = {r.place: int(r.s) for r in rows.select("x").mapInArrow(part, "place int, s decimal(38,0)").groupBy("place").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}
    return got.get(-1, 0), [got.get(k, 0) for k in range(d)]


def _summed(rows: DataFrame, shape: tuple[int, int], of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of of(batch of x), a block of the shape. Each partition gives one row per row of the block; those of one place are added in order of the partitions."""
    from pyspark import TaskContext

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            if b.num_rows:
                total += of(_matrix(b.column(0)))
        at = TaskContext.get().partitionId()
        flat = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), pa.array([at] * shape[0], pa.int32()), flat], ["place", "part", "v"])

    def added(table: pa.Table) -> pa.Table:
        table = table.sort_by("part").combine_chunks()
        return pa.table({"place": table.column("place").slice(0, 1), "v": pa.array([_matrix(table.column("v").chunk(0)).sum(0).tolist()], pa.list_(pa.float64()))})

    out = np.zeros(shape)
    for r in rows.select("x").mapInArrow(part, "place int, part int, v array<double>").groupBy("place").applyInArrow(added, "place int, v array<double>").collect():
        out[r.place] = r.v
    return out


def _product(rows: DataFrame, fit: Fit, block: np.ndarray) -> tuple[np.ndarray, float]:
    """Covariance times the block, and the trace."""
    whole, rest = fit.mean
    d, k = block.shape

    def of(x: np.ndarray) -> np.ndarray:
        y = (x - whole).astype(np.float64) - rest
        out = np.zeros((d + 1, k))
        out[:d] = y.T @ (y @ block)
        out[d, 0] = np.einsum("ij,ij->", y, y)
        return out

    total = _summed(rows, (d + 1, k), of) / fit.n
    return total[:d], float(total[d, 0])


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the block adds to the others; twice, so that rounding leaves nothing of them."""
    for _ in range(2):
        for a in against:
            block = block - a @ (a.T @ block)
        norm = np.linalg.norm(block, axis=0)
        block = block[:, norm > 1e-13 * max(norm.max(initial=0.0), 1e-300)]
        block = block / np.linalg.norm(block, axis=0)
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-8 * s.max(initial=0.0)]
    return block


def fit_whitening(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, guard: int = 16, tolerance: float = 1e-13, most: int = 500, seed: int = 5) -> Fit:
    """LOBPCG for the leading components of the covariance of x = floor(64 * c) + 1000000 over all usable rows.

    Rows with a null vector or a null or non-finite entry are left out, and so are rows whose vector
    is not of the most common length (of several, the greatest). guard further directions speed the
    convergence. A component is certified when a fresh product leaves a residual of at most tolerance
    times the greatest eigenvalue, or no smaller one can be reached in double precision (at most 1e-11
    of it; else an ArithmeticError). Fewer dimensions give fewer components; no rows give none.
    """
    bounded_batches(vectors.sparkSession)
    rows = whole_numbers(vectors, id_col, vector_col)
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0
    rows = cut(rows.where(F.size("x") == d))
    if not d:
        return Fit(rows.limit(0), 0, [], 0.0, np.zeros((0, 0)), np.zeros(0), 0.0, 0)
    n, sums = _sums(rows, d)
    fit = Fit(rows, n, sums, 0.0, np.zeros((d, 0)), np.zeros(0), 0.0, 0)
    want, m = min(components, d), min(d, components + guard)
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, m)))[0]
    ax, fit.trace = _product(rows, fit, x)
    p = ap = np.zeros((d, 0))
    # the first Rayleigh-Ritz step on the starting block alone
    theta, c = np.linalg.eigh(x.T @ ax)
    theta, x, ax = theta[::-1], x @ c[:, ::-1], ax @ c[:, ::-1]
    best, stale = np.inf, 0
    while True:
        residual = ax - x * theta
        worst = float(np.linalg.norm(residual[:, :want], axis=0).max()) / max(theta[0], 1e-300)
        best, stale = (worst, 0) if worst < 0.5 * best else (best, stale + 1)
        w = _orthonormal(residual, x, p) if x.shape[1] + p.shape[1] < d else np.zeros((d, 0))
        w = w[:, : d - x.shape[1] - p.shape[1]]
        if worst <= tolerance or not w.shape[1] or (stale > 20 and best < 1e-11) or theta[0] <= 0:
            # a fresh product: what the combinations have gathered of rounding goes, and the residual is certified
            ax, _ = _product(rows, fit, x)
            theta, c = np.linalg.eigh((x.T @ ax + ax.T @ x) / 2)
            theta, x, ax = theta[::-1], x @ c[:, ::-1], ax @ c[:, ::-1]
            worst = float(np.linalg.norm((ax - x * theta)[:, :want], axis=0).max()) / max(theta[0], 1e-300)
            if worst <= max(tolerance, 1e-11) or theta[0] <= 0:
                break
            p = ap = np.zeros((d, 0))
            residual = ax - x * theta
            w = _orthonormal(residual, x)[:, : d - x.shape[1]]
        if fit.rounds >= most:
            raise ArithmeticError(f"residual {worst:.2g} after {most} rounds")
        fit.rounds += 1
        aw, _ = _product(rows, fit, w)
        q, aq = np.hstack((x, p, w)), np.hstack((ax, ap, aw))
        g = q.T @ aq
        values, c = np.linalg.eigh((g + g.T) / 2)
        c = c[:, ::-1][:, :m]
        step = np.vstack((np.zeros((m, m)), c[m:]))
        step = _orthonormal(step, c)[:, : max(0, q.shape[1] - m)]
        theta, x, ax, p, ap = values[::-1][:m], q @ c, aq @ c, q @ step, aq @ step
    fit.components, fit.values, fit.residual = x[:, :want], np.maximum(theta[:want], 0.0), worst
    return fit


def whiten(fit: Fit, id_col: str = "vec_id") -> DataFrame:
    """One row per row of the fit: the id, deviation (sum over dimensions of (n * x - sum)**2, exact decimal, null beyond 38 digits) and whitened, an array of (x - mean) on each component over the root of its eigenvalue, null where that is 0 but for rounding."""
    (whole, rest), n = fit.mean, fit.n
    left = np.array([s - int(w) * n for s, w in zip(fit.sums, whole, strict=True)], dtype=object)
    turn, dead = fit.components * np.nan_to_num(fit.scales), np.isnan(fit.scales)

    def batch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            if not b.num_rows:
                continue
            y = _matrix(b.column(1)) - whole
            largest = int(np.abs(y).max(initial=0)) + 1
            if (n * largest) ** 2 * y.shape[1] < 2**63:  # exact in 64 bits
                total = ((n * y - left.astype(np.int64)) ** 2).sum(1).tolist()
            else:
                total = [sum((n * int(v) - r) ** 2 for v, r in zip(row, left, strict=True)) for row in y]
            z = (y.astype(np.float64) - rest) @ turn
            values = pa.array(z.ravel(), mask=np.tile(dead, len(z)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([t if t < 10**38 else None for t in total], pa.decimal128(38, 0)), pa.FixedSizeListArray.from_arrays(values, z.shape[1]).cast(pa.list_(pa.float64()))],
                ["_id", "deviation", "whitened"],
            )

    id_type = fit.rows.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, deviation {DecimalType(38, 0).simpleString()}, whitened array<double>"
    out = fit.rows.mapInArrow(batch, schema) if fit.n else fit.rows.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("_id", id_col)


def identity_error(fit: Fit) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, over the components with variance; 0 without any."""
    live = ~np.isnan(fit.scales)
    k = int(live.sum())
    if not k:
        return 0.0
    (whole, rest), turn = fit.mean, fit.components[:, live] * fit.scales[live]

    def of(x: np.ndarray) -> np.ndarray:
        z = ((x - whole).astype(np.float64) - rest) @ turn
        return np.vstack((z.T @ z, z.sum(0)))

    total = _summed(fit.rows, (k + 1, k), of) / fit.n
    # the rows are centred already: the mean that is left is rounding only
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())
