"""Grouped statistics, and joins that are bounded by a grid or a rig."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions import poses as P
from sightline.functions.shared import checkpoint_dir
from sightline.operators.quantiles import grouped_quantiles


def metric_scale(grid: DataFrame, gx: str, gy: str, point: list[str], cell: float) -> DataFrame:
    """pairs and factor: cell over the distance of grid neighbours to the right and above, as a geometric mean; 1 without pairs."""
    other = grid.select(F.col(gx).alias("_gx"), F.col(gy).alias("_gy"), *(F.col(p).alias(f"_{p}") for p in point))
    shifted = other.select(F.inline(F.array(*(F.struct((F.col("_gx") - dx).alias(gx), (F.col("_gy") - dy).alias(gy), *(F.col(f"_{p}") for p in point)) for dx, dy in ((1, 0), (0, 1))))))
    d = P.norm(tuple(F.col(p) - F.col(f"_{p}") for p in point))
    return grid.join(shifted, [gx, gy]).agg(F.count(F.lit(1)).alias("pairs"), F.coalesce(F.exp(F.avg(F.log(cell / d))), F.lit(1.0)).alias("factor"))


def adaptive_inliers(rows: DataFrame, key: str, value: str, most: float, least: int, floor: float = 2.0, factor: float = 4.0) -> DataFrame:
    """Per group: threshold min(most, max(floor, median + factor 1.4826 MAD)), inliers below it, and which limit holds.

    used is adaptive if at least least rows pass, fallback if so many pass most, else rejected.
    """
    mid = grouped_quantiles(rows, [key], {"_med": (value, 0.5)}).select(key, "_med")
    off = rows.join(mid, key).withColumn("_off", F.abs(F.col(value) - F.col("_med")))
    mad = grouped_quantiles(off, [key], {"_mad": ("_off", 0.5)}).select(key, "_mad")
    limit = mid.join(mad, key).select(key, F.least(F.lit(most), F.greatest(F.lit(floor), F.col("_med") + factor * 1.4826 * F.col("_mad"))).alias("threshold"))
    per = rows.join(limit, key).groupBy(key).agg(F.first("threshold").alias("threshold"), F.count_if(F.col(value) <= F.col("threshold")).alias("inliers"), F.count_if(F.col(value) <= most).alias("_all"))
    return per.select(key, "threshold", "inliers", F.when(F.col("inliers") >= least, "adaptive").when(F.col("_all") >= least, "fallback").otherwise("rejected").alias("used"))


def trimmed_line(rows: DataFrame, key: str, x: str, y: str, q: float) -> DataFrame:
    """Per group a least-squares line through the rows whose distance from a first such line is at most its q-quantile: kept, slope, intercept.

    The first lines are cut from their lineage: their last bits depend on the order in which parts
    of a sum arrive, and a row at the cut must have the same distance in both of its uses.
    """
    checkpoint_dir(rows.sparkSession)
    first = rows.groupBy(key).agg(F.regr_slope(y, x).alias("_s"), F.regr_intercept(y, x).alias("_i")).checkpoint()
    off = rows.join(first, key).withColumn("_off", F.abs(F.col(y) - F.col("_s") * F.col(x) - F.col("_i")))
    cut = grouped_quantiles(off, [key], {"_cut": ("_off", q)}).select(key, "_cut")
    return off.join(cut, key).where("_off <= _cut").groupBy(key).agg(F.count(F.lit(1)).alias("kept"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def pair_overlap(counts: DataFrame, camera: str, frame: str, n: str) -> DataFrame:
    """Camera pairs with a common frame: common frames, frames in which both have features, and the features of both. A frame's pairs are bounded by the cameras."""
    x, y = counts.alias("x"), counts.alias("y")
    both = x.join(y, (F.col(f"x.{frame}") == F.col(f"y.{frame}")) & (F.col(f"x.{camera}") < F.col(f"y.{camera}")))
    a, b = F.col(f"x.{n}"), F.col(f"y.{n}")
    return both.groupBy(F.col(f"x.{camera}").alias("camera_a"), F.col(f"y.{camera}").alias("camera_b")).agg(F.count(F.lit(1)).alias("common"), F.count_if((a > 0) & (b > 0)).alias("both_seen"), F.sum(a + b).alias("features"))


def close_poses(rows: DataFrame, key: str, group: str, point: list[str], turn: list[str] | None, radius: float, degrees: float | None, apart: float = 0.0, kept: list[str] | None = None) -> DataFrame:
    """Pairs (id_a, id_b) of a group from apart to radius from each other and, with turn, at most degrees apart in rotation. Rows meet only in the cells around them. kept: columns of the group to keep, and apart, the distance."""
    cells = rows.withColumns({f"_g{k}": F.floor(F.col(k) / radius) for k in point})
    near = cells
    for k in point:
        near = near.withColumn(f"_h{k}", F.explode(F.array(*(F.col(f"_g{k}") + d for d in (-1, 0, 1)))))
    x, y = near.alias("x"), cells.alias("y")
    on = (F.col(f"x.{group}") == F.col(f"y.{group}")) & (F.col(f"x.{key}") < F.col(f"y.{key}"))
    for k in point:
        on &= F.col(f"x._h{k}") == F.col(f"y._g{k}")
    distance = P.norm(tuple(F.col(f"x.{k}") - F.col(f"y.{k}") for k in point))
    on &= distance.between(apart, radius)
    if turn:
        unit = lambda s: P.unit(tuple(F.col(f"{s}.{k}") for k in turn))
        on &= P.angle(unit("x"), unit("y")) <= degrees
    more = [F.col(f"x.{k}").alias(k) for k in kept] + [distance.alias("apart")] if kept else []
    return x.join(y, on).select(F.col(f"x.{key}").alias("id_a"), F.col(f"y.{key}").alias("id_b"), *more)
