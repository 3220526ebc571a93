"""Numeric kernels per group. Sums of products are Spark aggregates, which merge map-side; only the small solve runs in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions.shared import checkpoint_dir


def _products(names: list[str], other: list[str] | None = None) -> list:
    other = other or names
    return [F.sum(F.col(x) * F.col(y)).alias(f"s_{i}_{j}") for i, x in enumerate(names) for j, y in enumerate(other)]


def _matrix(row: pd.Series, n: int, m: int) -> np.ndarray:
    return np.array([[row[f"s_{i}_{j}"] for j in range(m)] for i in range(n)])


def mean_rotation(df: DataFrame, key: str, quaternion: list[str]) -> DataFrame:
    """Mean rotation of quaternions (x, y, z, w) per group: main eigenvector of the sum of outer products, w >= 0."""
    norm = F.sqrt(sum((F.col(q) * F.col(q) for q in quaternion), F.lit(0.0)))
    unit = df.where(norm > 0).select(key, *((F.col(q) / norm).alias(f"q{k}") for k, q in enumerate(quaternion)))
    sums = unit.groupBy(key).agg(*_products([f"q{k}" for k in range(4)]))

    def solve(batches):
        for pdf in batches:
            out = []
            for _, row in pdf.iterrows():
                v = np.linalg.eigh(_matrix(row, 4, 4))[1][:, -1]
                v = v * (-1 if v[3] < 0 else 1)
                out.append((row[key], *np.round(v, 9)))
            yield pd.DataFrame(out, columns=[key, "qx", "qy", "qz", "qw"])

    return sums.mapInPandas(solve, f"{key} {df.schema[key].dataType.simpleString()}, qx double, qy double, qz double, qw double")


def plane_normal(df: DataFrame, key: str, point: list[str]) -> DataFrame:
    """Unit normal of the least-squares plane per group, largest component positive."""
    sums = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *(F.avg(p).alias(f"m{k}") for k, p in enumerate(point)), *_products(point))

    def solve(batches):
        for pdf in batches:
            out = []
            for _, row in pdf.iterrows():
                m = np.array([row[f"m{k}"] for k in range(3)])
                v = np.linalg.eigh(_matrix(row, 3, 3) / row["n"] - np.outer(m, m))[1][:, 0]
                v = v * np.sign(v[np.argmax(np.abs(v))])
                out.append((row[key], *np.round(v, 9)))
            yield pd.DataFrame(out, columns=[key, "nx", "ny", "nz"])

    return sums.mapInPandas(solve, f"{key} {df.schema[key].dataType.simpleString()}, nx double, ny double, nz double")


def umeyama(df: DataFrame, key: str, source: list[str], target: list[str]) -> DataFrame:
    """Scale, rotation (row-major) and translation that map source to target per group, in the least-squares sense."""
    sums = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(f"a{k}") for k, c in enumerate(source)), *(F.avg(c).alias(f"b{k}") for k, c in enumerate(target)), F.sum(sum((F.col(c) * F.col(c) for c in source), F.lit(0.0))).alias("ss"), *_products(target, source))

    def solve(batches):
        for pdf in batches:
            out = []
            for _, row in pdf.iterrows():
                a, b = (np.array([row[f"{s}{k}"] for k in range(3)]) for s in "ab")
                u, d, vt = np.linalg.svd(_matrix(row, 3, 3) / row["n"] - np.outer(b, a))
                sign = np.array([1, 1, np.sign(np.linalg.det(u) * np.linalg.det(vt)) or 1])
                r = u @ np.diag(sign) @ vt
                var = row["ss"] / row["n"] - a @ a
                s = float((d * sign).sum() / var) if var > 0 else 1.0
                out.append((row[key], round(s, 9), [float(x) for x in np.round(r.ravel(), 9)], [float(x) for x in np.round(b - s * r @ a, 9)]))
            yield pd.DataFrame(out, columns=[key, "scale", "rotation", "translation"])

    return sums.mapInPandas(solve, f"{key} {df.schema[key].dataType.simpleString()}, scale double, rotation array<double>, translation array<double>")


def mean_rotation_svd(df: DataFrame, key: str, quaternion: list[str]) -> DataFrame:
    """Per group the rotation (row-major) nearest to the sum of its rotations' matrices: the nine sums are Spark aggregates."""
    from sightline.functions import poses as P

    unit = P.unit(tuple(F.col(q) for q in quaternion))
    entries = df.select(key, *(c.alias(f"m{k}") for k, c in enumerate(P.to_matrix(unit))))
    sums = entries.groupBy(key).agg(*(F.sum(f"m{k}").alias(f"m{k}") for k in range(9)))

    def solve(batches):
        for pdf in batches:
            m = pdf[[f"m{k}" for k in range(9)]].to_numpy().reshape(-1, 3, 3)
            u, _, vt = np.linalg.svd(m)
            u[:, :, 2] *= np.sign(np.linalg.det(u) * np.linalg.det(vt))[:, None]
            yield pd.DataFrame({key: pdf[key], "rotation": [np.round(r.ravel(), 9) for r in u @ vt]})

    return sums.mapInPandas(solve, f"{key} {df.schema[key].dataType.simpleString()}, rotation array<double>")


def homography(df: DataFrame, key: str, source: list[str], target: list[str]) -> DataFrame:
    """Per group of at least four pairs the homography h (row-major, last entry 1) that maps source to target, by direct linear transform.

    The two equations of each pair enter a 9 x 9 matrix of products, which Spark sums; only its
    least eigenvector is Python's.
    """
    x, y, u, v = (F.col(c) for c in (*source, *target))
    one, o = F.lit(1.0), F.lit(0.0)
    rows = ((-x, -y, -one, o, o, o, u * x, u * y, u), (o, o, o, -x, -y, -one, v * x, v * y, v))
    sums = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *(F.sum(sum((r[i] * r[j] for r in rows), o)).alias(f"s_{i}_{j}") for i in range(9) for j in range(i, 9))).where("n >= 4")

    def solve(batches):
        for pdf in batches:
            m = np.zeros((len(pdf), 9, 9))
            for i in range(9):
                for j in range(i, 9):
                    m[:, i, j] = m[:, j, i] = pdf[f"s_{i}_{j}"]
            h = np.linalg.eigh(m)[1][:, :, 0]
            yield pd.DataFrame({key: pdf[key], "h": list(h / h[:, 8:])})

    return sums.mapInPandas(solve, f"{key} {df.schema[key].dataType.simpleString()}, h array<double>")


def _equations(x: np.ndarray, uv: np.ndarray, r: np.ndarray, tr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives (2n x 6) of the pixels by a turn and a way of the pose, and what the pixels are off."""
    p = x @ r.T + tr
    j = np.zeros((len(x), 2, 6))
    inv = 1 / p[:, 2]
    for k in (0, 1):
        g = np.zeros((len(x), 3))
        g[:, k], g[:, 2] = inv, -p[:, k] * inv * inv
        j[:, k, 3:], j[:, k, :3] = g, np.cross(x @ r.T, g)
    return j.reshape(-1, 6), (p[:, :2] / p[:, 2:] - uv).ravel()


def _stepped(step: np.ndarray, r: np.ndarray, tr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, angle = step[:3], np.linalg.norm(step[:3])
    k = np.array([[0, -w[2], w[1]], [w[2], 0, -w[0]], [-w[1], w[0], 0]])
    turn = np.eye(3) + (np.sin(angle) / angle * k + (1 - np.cos(angle)) / angle**2 * k @ k if angle > 1e-12 else k)
    return turn @ r, tr + step[3:]


def _pose_from(x: np.ndarray, uv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotation and translation of a few points seen at normalised pixels: direct linear transform, then Gauss-Newton."""
    a = np.zeros((2 * len(x), 12))
    hom = np.column_stack([x, np.ones(len(x))])
    a[0::2, :4], a[0::2, 8:] = -hom, uv[:, :1] * hom
    a[1::2, 4:8], a[1::2, 8:] = -hom, uv[:, 1:] * hom
    m = np.linalg.svd(a)[2][-1].reshape(3, 4)
    m = m * np.sign(np.mean(hom @ m[2]))
    u, d, vt = np.linalg.svd(m[:, :3])
    r, tr = u @ np.diag([1, 1, np.sign(np.linalg.det(u @ vt))]) @ vt, m[:, 3] / d.mean()
    for _ in range(15):
        j, e = _equations(x, uv, r, tr)
        step = np.linalg.lstsq(j, -e, rcond=None)[0]
        r, tr = _stepped(step, r, tr)
        if np.linalg.norm(step) < 1e-12:
            break
    return r, tr


def _errors(x: np.ndarray, uv: np.ndarray, r: np.ndarray, tr: np.ndarray) -> np.ndarray:
    """Distances of the points' pixels from the seen ones; infinite behind the camera."""
    p = x @ r.T + tr
    return np.where(p[:, 2] > 0, np.linalg.norm(p[:, :2] / np.where(p[:, 2:] > 0, p[:, 2:], 1) - uv, axis=1), np.inf)


#: Different pairs of a view, of which samples are drawn, and of one block of it, at most about.
_DRAWN, _BLOCK = 512, 20_000


def view_pose(df: DataFrame, key: str, point: list[str], pixel: list[str], least: int = 6, trials: int = 60, reach: float = 0.01) -> DataFrame:
    """Per view the pose that sees its points at its normalised pixels, robust to wrong pairs: rotation (row-major), translation, inliers, median_error.

    Samples of six pairs propose poses (seeded, so a view's result is the same in every run), drawn
    from up to _DRAWN of the view's different pairs, which are taken by weighted hashes; all pairs
    vote. The pose that most pairs agree with is refined on these by Gauss-Newton steps. Equal
    pairs are counted, a view is worked on in blocks, and only its sums are put together, so no
    task holds a view. Views with fewer than least pairs, or whose best sample has under six
    inliers, are left out; so are pairs with nulls, and rows without a view.
    """
    from sightline.operators.quantiles import counted_median

    checkpoint_dir(df.sparkSession)
    kind, columns = f"{key} {df.schema[key].dataType.simpleString()}", [*point, *pixel]
    pairs = df.select(key, *(F.col(c).cast("double").alias(c) for c in columns)).dropna().groupBy(key, *columns).agg(F.count(F.lit(1)).alias("_n"))
    size = pairs.groupBy(key).agg(F.sum("_n").alias("_all"), F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("_blocks")).where(F.col("_all") >= least)
    hashed = F.xxhash64(*columns, F.lit(7))
    pairs = pairs.join(size, key).withColumn("_block", F.pmod(hashed, "_blocks").cast("int")).drop("_all").checkpoint()
    # smallest first: an exponential number divided by the pair's count
    drawn = -F.log((F.pmod(F.xxhash64(*columns, F.lit(11)), F.lit(2**52)) + 1) / float(2**52)) / F.col("_n")
    few = pairs.withColumn("_at", F.row_number().over(W.partitionBy(key).orderBy(drawn, *columns))).where(F.col("_at") <= _DRAWN)

    def propose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(columns)
        x, uv, n = pdf[point].to_numpy(float), pdf[pixel].to_numpy(float), pdf["_n"].to_numpy(float)
        if pdf["_n"].sum() < 6:
            return pd.DataFrame({key: pdf[key].iloc[:0], "_blocks": pdf["_blocks"].iloc[:0], "_poses": pd.Series(dtype=object)})
        # where all pairs are here they are drawn by their counts, else the hashes have done that
        each = np.repeat(np.arange(len(x)), np.minimum(n, 6).astype(int)) if len(x) < 6 else np.arange(len(x))
        share = n[each] / n[each].sum() if 6 <= len(x) < _DRAWN else None
        rng, poses = np.random.default_rng(7), []
        for _ in range(trials):
            at = each[rng.choice(len(each), 6, replace=False, p=share)]
            try:
                r, tr = _pose_from(x[at], uv[at])
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(r).all() and np.isfinite(tr).all():
                poses.append([*r.ravel(), *tr])
        return pd.DataFrame({key: [pdf[key].iloc[0]], "_blocks": [pdf["_blocks"].iloc[0]], "_poses": [[float(v) for p in poses for v in p]]})

    proposed = few.select(key, *columns, "_n", "_blocks").groupBy(key).applyInPandas(propose, f"{kind}, _blocks int, _poses array<double>").checkpoint()

    def by_block(state: DataFrame, f: Callable[[pd.DataFrame, np.ndarray], list[tuple]], fields: str) -> DataFrame:
        """f of each block's pairs and the 12 numbers of each pose that the state has for the view."""
        names = [key, *(c.split()[0] for c in fields.split(", "))]

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame(columns=names)
            return pd.DataFrame([(left[key].iloc[0], *row) for row in f(left, np.asarray(right["_poses"].iloc[0], float).reshape(-1, 12))], columns=names)

        blocks = state.select(key, "_poses", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
        return pairs.groupBy(key, "_block").cogroup(blocks.groupBy(key, "_block")).applyInPandas(run, f"{kind}, {fields}")

    def place(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return pdf[point].to_numpy(float), pdf[pixel].to_numpy(float), pdf["_n"].to_numpy(np.int64)

    def vote(pdf: pd.DataFrame, poses: np.ndarray) -> list[tuple]:
        x, uv, n = place(pdf)
        return [(k, int(n[_errors(x, uv, p[:9].reshape(3, 3), p[9:]) <= reach].sum())) for k, p in enumerate(poses)]

    votes = by_block(proposed, vote, "_k int, _votes long").groupBy(key, "_k").agg(F.sum("_votes").alias("_votes"))
    best = votes.groupBy(key).agg(F.min_by(F.struct("_k", "_votes"), F.struct(-F.col("_votes"), "_k")).alias("_best")).where("_best._votes >= 6")
    first = proposed.join(best, key).select(key, "_blocks", F.slice("_poses", F.col("_best._k") * 12 + 1, 12).alias("_poses"), F.col("_best._votes").alias("inliers")).checkpoint()

    def agreed(pdf: pd.DataFrame, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that the view's first pose has as inliers."""
        x, uv, n = place(pdf)
        good = _errors(x, uv, chosen[:9].reshape(3, 3), chosen[9:]) <= reach
        return x[good], uv[good], n[good]

    def normal(pdf: pd.DataFrame, poses: np.ndarray) -> list[tuple]:
        x, uv, n = agreed(pdf, poses[0])
        if not len(x):
            return []
        j, e = _equations(x, uv, poses[1][:9].reshape(3, 3), poses[1][9:])
        w = np.repeat(n, 2)[:, None]
        return [(*((j * w).T @ j).ravel(), *((j * w).T @ e))]

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out, far = [], []
            for poses, row in zip(pdf["_poses"], pdf[[f"s{k}" for k in range(42)]].to_numpy(float), strict=True):
                p = np.asarray(poses, float)
                step = np.linalg.lstsq(row[:36].reshape(6, 6), -row[36:], rcond=None)[0]
                r, tr = _stepped(step, p[12:21].reshape(3, 3), p[21:])
                out.append([float(v) for v in (*p[:12], *r.ravel(), *tr)])
                far.append(float(np.linalg.norm(step)))
            yield pd.DataFrame({key: pdf[key], "_blocks": pdf["_blocks"], "inliers": pdf["inliers"], "_poses": out, "_step": far})

    sums, state = [f"s{k}" for k in range(42)], first.withColumn("_poses", F.concat("_poses", "_poses"))
    for _ in range(15):
        total = by_block(state, normal, ", ".join(f"{s} double" for s in sums)).groupBy(key).agg(*(F.sum(s).alias(s) for s in sums))
        state = state.select(key, "_blocks", "inliers", "_poses").join(total, key).mapInPandas(move, f"{kind}, _blocks int, inliers long, _poses array<double>, _step double").checkpoint()
        if not (state.agg(F.max("_step")).first()[0] or 0.0) > 1e-11:
            break

    def off(pdf: pd.DataFrame, poses: np.ndarray) -> list[tuple]:
        x, uv, n = agreed(pdf, poses[0])
        return list(zip(_errors(x, uv, poses[1][:9].reshape(3, 3), poses[1][9:]).tolist(), n.tolist(), strict=True))

    middle = counted_median(by_block(state, off, "_off double, _m long").groupBy(key, "_off").agg(F.sum("_m").alias("_m")), key, "_off", "_m")
    return state.join(middle, key).select(key, F.slice("_poses", 13, 9).alias("rotation"), F.slice("_poses", 22, 3).alias("translation"), F.col("inliers").cast("int").alias("inliers"), F.col("median").alias("median_error"))
