"""Local polynomials along a track, motion samples from poses, and least squares with many unknowns over tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions import poses as P
from sightline.functions.ship import ship
from sightline.operators.quantiles import table_quantile
from sightline.operators.relational import interpolated


def local_curvature(time: Column, values: list[Column], window: W, half_window: int, least: int = 5, least_span: float = 1e-3) -> list[Column]:
    """The second derivative of each value by time at each row: c of a + b s + c s**2 / 2 fitted to the rows up to half_window before and after (s: time from the row's).

    Null where fewer than least rows are there or they span less than least_span. The frame is at most
    2 half_window + 1 rows; times count from the row itself and in units of the frame's reach, so that sums of
    fourth powers stay exact enough, and the three equations are solved in closed form.
    """
    frame = window.rowsBetween(-half_window, half_window)
    t0 = time.cast("double")
    points = F.collect_list(F.struct(t0.alias("t"), F.array(*(v.cast("double") for v in values)).alias("v"))).over(frame)

    def sums(at: Column) -> Column:
        """n, the sums of powers 1 to 4 of the scaled times, and per value those of its products with powers 0 to 2."""
        s = F.transform(at["points"], lambda p: (p["t"] - at["t0"]) / at["reach"])
        total = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v)
        power = lambda k: total(F.transform(s, lambda x: F.pow(x, F.lit(float(k)))))
        moment = lambda j, k: total(F.zip_with(at["points"], s, lambda p, x: p["v"][j] * F.pow(x, F.lit(float(k)))))
        return F.struct(F.size(s).cast("double").alias("n"), *(power(k).alias(f"s{k}") for k in range(1, 5)), *(moment(j, k).alias(f"v{j}_{k}") for j in range(len(values)) for k in range(3)), at["reach"].alias("reach"))

    def solve(m: Column) -> Column:
        a, b, c, d, e = m["n"], m["s1"], m["s2"], m["s3"], m["s4"]
        det = a * (c * e - d * d) - b * (b * e - c * d) + c * (b * d - c * c)
        top = lambda j: a * (c * m[f"v{j}_2"] - m[f"v{j}_1"] * d) - b * (b * m[f"v{j}_2"] - m[f"v{j}_1"] * c) + m[f"v{j}_0"] * (b * d - c * c)
        return F.array(*(2 * top(j) / F.nullif(det, F.lit(0.0)) / (m["reach"] * m["reach"]) for j in range(len(values))))

    # bound once each, as elements of arrays of one, so that nothing is worked out again for every use of it
    once = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)
    span = lambda p: F.array_max(F.transform(p, lambda x: x["t"])) - F.array_min(F.transform(p, lambda x: x["t"]))
    reach = lambda p: F.array_max(F.transform(p, lambda x: F.abs(x["t"] - t0)))
    found = once(points, lambda p: F.when((F.size(p) >= least) & (span(p) >= least_span), once(F.struct(p.alias("points"), t0.alias("t0"), reach(p).alias("reach")), lambda at: once(sums(at), solve))))
    return [F.get(found, F.lit(j)) for j in range(len(values))]


def local_slope(time: Column, values: list[Column], keys: list[str], order: Column, reach: int, least: int = 5) -> list[Column]:
    """The slope of each value by time over the rows whose order is at most reach from the row's; null values don't count, and fewer than least rows give null."""
    w = W.partitionBy(*keys).orderBy(order).rangeBetween(-reach, reach)
    return [F.when(F.count(v).over(w) >= least, F.regr_slope(v, time).over(w)) for v in values]


def motion_samples(
    poses: DataFrame, imu: DataFrame, key: str, stamp: str, rotation_half_window: int = 2, position_half_window: int = 3, alpha_window_ns: int = 200_000_000, least_omega: float = 0.2, least_alpha: float = 0.5, sign: float = 1.0
) -> DataFrame:
    """Rows for the accelerometer system: poses with acceleration a*, turning rate o*, its change l* and the sensor's reading i*.

    poses: key, stamp (ns), qx..qw (world to camera), px, py, pz (the camera's place in the world). imu: key,
    stamp, ax, ay, az. The rate is taken between the poses rotation_half_window before and after, the
    acceleration from a quadratic over the poses around, the change from a line over alpha_window_ns,
    the reading by interpolation. Rows that lack any of these, or turn too little in both, are left out.
    """
    ship(poses.sparkSession)
    w = W.partitionBy(key).orderBy(stamp)
    first = F.min(stamp).over(W.partitionBy(key))
    rows = poses.withColumn("t_s", (F.col(stamp) - first) / 1e9)
    before, after = (lambda c: F.lag(c, rotation_half_window).over(w)), (lambda c: F.lead(c, rotation_half_window).over(w))
    rows = rows.withColumns({f"{side}{k}": f(k) for side, f in (("b_", before), ("f_", after)) for k in ("qx", "qy", "qz", "qw", "t_s")})
    rows = rows.withColumns(dict(zip(("ax", "ay", "az"), local_curvature(F.col("t_s"), [F.col(k) for k in ("px", "py", "pz")], w, position_half_window), strict=True)))
    q = lambda side: tuple(F.col(f"{side}{k}") for k in ("qx", "qy", "qz", "qw"))
    dt = F.col("f_t_s") - F.col("b_t_s")
    turn = P.multiply(q("b_"), P.conjugate(q("f_")))
    rows = rows.withColumns(dict(zip(("ux", "uy", "uz", "uw"), turn, strict=True))).withColumn("dt", dt)
    spin = P.log(tuple(F.col(k) for k in ("ux", "uy", "uz", "uw")))
    rows = rows.withColumns({f"o{k}": F.when(F.col("dt") > 1e-3, sign * s / F.col("dt")) for k, s in zip("xyz", spin, strict=True)})
    rows = rows.withColumns(dict(zip(("lx", "ly", "lz"), local_slope(F.col("t_s"), [F.col(f"o{k}") for k in "xyz"], [key], F.col(stamp), alpha_window_ns), strict=True)))
    for k in "xyz":
        rows = interpolated(rows, imu.select(key, stamp, F.col(f"a{k}").alias(f"i{k}")), [key], stamp, f"i{k}").withColumnRenamed("interpolated", f"i{k}")
    whole = [f"{a}{k}" for a in "aoli" for k in "xyz"]
    rows = rows.dropna(subset=whole)
    fast = (P.norm(tuple(F.col(f"o{k}") for k in "xyz")) >= least_omega) | (P.norm(tuple(F.col(f"l{k}") for k in "xyz")) >= least_alpha)
    return rows.where(fast).select(key, stamp, "qx", "qy", "qz", "qw", *whole)


@dataclass
class Solution:
    """x minimises the sum of squares; rank and condition come from the singular values; n rows of the matrix, and the root of the mean squared residual."""

    x: np.ndarray
    rank: int
    singular: np.ndarray
    n: int
    rms: float

    @property
    def condition(self) -> float | None:
        return float(self.singular[0] / self.singular[-1]) if len(self.singular) and self.singular[-1] > 0 else None


Build = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def least_squares(rows: DataFrame, build: Build, unknowns: int) -> Solution:
    """Least squares of the rows that build makes of each batch (a matrix of unknowns columns, and its right-hand side).

    Every partition reduces its rows to the triangle of a QR decomposition, at most unknowns + 1 rows
    of [matrix | right side]; triangles are joined and reduced again in groups, then on the driver.
    Singular values are those of the whole matrix, not the roots of those of its square. Without rows x is 0 and the rank 0.
    """
    ship(rows.sparkSession)
    m = unknowns + 1
    names = [f"c{k}" for k in range(m)]

    def triangle(stack: list[np.ndarray]) -> np.ndarray:
        a = np.concatenate(stack) if stack else np.zeros((0, m))
        return np.linalg.qr(a, mode="r") if len(a) > m else a

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kept, n = np.zeros((0, m)), 0
        for b in batches:
            if b.num_rows:
                a, y = build(b)
                n += len(a)
                kept = triangle([kept, np.column_stack((a, y))])
        at = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kept), at // 32, np.int32)), pa.array([n] + [0] * (len(kept) - 1) if len(kept) else [], pa.int64()), *(pa.array(c) for c in kept.T)], ["part", "n", *names])

    def joined(table: pa.Table) -> pa.Table:
        r = triangle([np.stack([np.asarray(table.column(k)) for k in names], 1)])
        n = int(np.asarray(table.column("n")).sum())
        return pa.table({"n": pa.array([n] + [0] * (len(r) - 1), pa.int64()), **dict(zip(names, map(pa.array, r.T), strict=True))})

    doubles = ", ".join(f"{k} double" for k in names)
    parts = rows.mapInArrow(part, f"part int, n long, {doubles}").groupBy("part").applyInArrow(joined, f"n long, {doubles}")
    got = parts.collect()  # at most unknowns + 1 rows for each 32 partitions
    r, n = triangle([np.array([tuple(x)[1:] for x in got]).reshape(-1, m)]), sum(x["n"] for x in got)
    if not n:
        return Solution(np.zeros(unknowns), 0, np.zeros(unknowns), 0, 0.0)
    x, _, rank, singular = np.linalg.lstsq(r[:, :-1], r[:, -1], rcond=max(n, unknowns) * np.finfo(float).eps)
    return Solution(x, int(rank), singular, n, float(np.sqrt(((r[:, :-1] @ x - r[:, -1]) ** 2).sum() / n)))


def trimmed_least_squares(rows: DataFrame, build: Build, unknowns: int, per_row: int, share: float) -> tuple[Solution, Solution, DataFrame]:
    """A fit of all rows, one of those whose residual (a row of the table is per_row rows of the matrix) is within the quantile share of all, and the rows with the first fit's residual and inlier."""

    def measured(batches: Iterator[pa.RecordBatch], x: np.ndarray) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, y = build(b)
            off = np.linalg.norm((a @ x - y).reshape(-1, per_row), axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(off)], [*b.schema.names, "residual"])

    first = least_squares(rows, build, unknowns)
    x = first.x
    told = rows.mapInArrow(lambda batches: measured(batches, x), ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "residual double"]))
    most = table_quantile(told, "residual", share)
    told = told.withColumn("inlier", F.col("residual") <= (most if most is not None else 0.0))
    return first, least_squares(told.where("inlier").drop("residual", "inlier"), build, unknowns), told


def accelerometer_rows(captures: dict[str, tuple[int, np.ndarray, np.ndarray]], key: str, count: int) -> Build:
    """The three rows per motion sample of the system for the sensor's place, and gravity and bias of each capture.

    captures: per key value its number (below count), the rotation (3 x 3) from sensor to camera, and
    the prior pose (4 x 4) that takes the first camera's frame to this one. Unknowns: the place in the first camera's frame (3), count
    gravities (3 each), count biases (3 each).
    """
    n = 3 + 6 * count

    def build(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        col = lambda names: np.stack([np.asarray(b.column(k), np.float64) for k in names], 1)
        three = lambda a: [f"{a}{k}" for k in "xyz"]
        keys = b.column(key).to_pylist()
        number = np.array([captures[k][0] for k in keys])
        r_ci, prior = np.array([captures[k][1] for k in keys]), np.array([captures[k][2] for k in keys])
        x, y, z, w = col(("qx", "qy", "qz", "qw")).T
        r_cw = np.stack((1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)), 1).reshape(-1, 3, 3)
        skew = lambda v: np.cross(np.broadcast_to(np.eye(3), (len(v), 3, 3)), v[:, None, :]).transpose(0, 2, 1) * -1
        omega, alpha = skew(col(three("o"))), skew(col(three("l")))
        turn = r_ci.transpose(0, 2, 1)
        a_c = turn @ (alpha + omega @ omega)
        r_iw = turn @ r_cw
        out = np.zeros((len(keys), 3, n))
        out[:, :, :3] = a_c @ prior[:, :3, :3]
        at = np.arange(len(keys))
        for k in range(3):
            out[at, :, 3 + 3 * number + k] = -r_iw[:, :, k]
            out[at, k, 3 + 3 * count + 3 * number + k] = 1.0
        rhs = col(three("i")) - (r_iw @ col(three("a"))[:, :, None])[..., 0] - (a_c @ prior[:, :3, 3:])[..., 0]
        return out.reshape(-1, n), rhs.reshape(-1)

    return build
