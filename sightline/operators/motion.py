"""Operators on tables of poses (columns qx, qy, qz, qw, tx, ty, tz)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions import poses as P
from sightline.functions.shared import checkpoint_dir
from sightline.operators.quantiles import grouped_quantiles
from sightline.operators.summary import close_poses

POSE = ("qx", "qy", "qz", "qw", "tx", "ty", "tz")
#: Cameras of a rig, at most; edges between them are collected to propagate poses.
MOST_CAMERAS = 256


def rotation(prefix: str = "") -> P.Quaternion:
    return tuple(F.col(f"{prefix}{k}") for k in POSE[:4])


def position(prefix: str = "") -> P.Vector:
    return tuple(F.col(f"{prefix}{k}") for k in POSE[4:])


def pose(prefix: str = "") -> P.Pose:
    return rotation(prefix), position(prefix)


def interpolated_poses(at: DataFrame, keys: DataFrame, by: list[str], time: str, most: int) -> DataFrame:
    """Each row of at with the pose at its time: turned by slerp, moved linearly between the key poses around it.

    Before the first and after the last key pose of its group the nearest one counts. Rows between
    key poses over most apart, and rows of groups without any, are left out. One sort of the union,
    no pairs.
    """
    held = F.struct(F.col(time).alias("time"), *POSE)
    both = at.withColumn("_key", F.lit(None).cast(keys.select(held.alias("k")).schema["k"].dataType)).unionByName(keys.select(*by, time, held.alias("_key")), allowMissingColumns=True)
    w = W.partitionBy(*by).orderBy(time)
    near = both.withColumns({"_b": F.last("_key", True).over(w.rangeBetween(W.unboundedPreceding, 0)), "_f": F.first("_key", True).over(w.rangeBetween(0, W.unboundedFollowing))}).where(F.col("_key").isNull())
    near = near.withColumns({"_b": F.coalesce("_b", "_f"), "_f": F.coalesce("_f", "_b")}).where(F.col("_f.time") - F.col("_b.time") <= most)
    gap = F.col("_f.time") - F.col("_b.time")
    share = F.when(gap == 0, 0.0).otherwise((F.col(time) - F.col("_b.time")) / gap)
    turned = P.slerp(rotation("_b."), rotation("_f."), share)
    moved = P.add(position("_b."), P.scaled(P.sub(position("_f."), position("_b.")), share))
    return near.withColumns(dict(zip(POSE, (*turned, *moved), strict=True))).drop("_key", "_b", "_f")


def _relative(a: str, b: str) -> P.Pose:
    """The pose of b as seen from a."""
    return P.compose(P.invert(pose(a)), pose(b))


def pair_edges(table: DataFrame, instant: str, camera: str) -> DataFrame:
    """For each ordered pair of cameras: shared_frames, the median relative position (mx, my, mz), the median distance to it (residual), and the relative rotation of the frame nearest to it.

    A frame holds a rig's cameras, so its pairs are bounded by the rig, not by the rows.
    """
    x, y = table.alias("a"), table.alias("b")
    both = x.join(y, (F.col(f"a.{instant}") == F.col(f"b.{instant}")) & (F.col(f"a.{camera}") != F.col(f"b.{camera}")))
    q, d = _relative("a.", "b.")
    rel = both.select(F.col(f"a.{camera}").alias("camera_a"), F.col(f"b.{camera}").alias("camera_b"), F.col(f"a.{instant}").alias("_at"), *(c.alias(f"d{k}") for k, c in zip("xyz", d, strict=True)), *(c.alias(f"e{k}") for k, c in zip("xyzw", q, strict=True)))
    pair = ["camera_a", "camera_b"]
    mid = rel.groupBy(*pair).agg(F.count(F.lit(1)).alias("shared_frames"), *(F.median(f"d{k}").alias(f"m{k}") for k in "xyz"))
    off = P.norm(tuple(F.col(f"d{k}") - F.col(f"m{k}") for k in "xyz"))
    spread = rel.join(mid, pair).withColumn("_off", off).groupBy(*pair).agg(F.median("_off").alias("residual"), F.min_by(F.struct(*(F.col(f"e{k}") for k in "xyzw")), F.struct("_off", "_at")).alias("turn"))
    return mid.join(spread, pair)


def relative_votes(table: DataFrame, pairs: DataFrame, instant: str, camera: str) -> DataFrame:
    """Per frame and configured pair (target, reference): the target's position (dx, dy, dz) and rotation as seen from the reference. pairs is a short configured list."""
    x = table.withColumnRenamed(camera, "target").join(F.broadcast(pairs), "target").alias("p")
    y = table.withColumnsRenamed({camera: "reference"}).alias("r")
    q, d = _relative("r.", "p.")
    both = x.join(y, (F.col("p.reference") == F.col("r.reference")) & (F.col(f"p.{instant}") == F.col(f"r.{instant}")))
    return both.select(F.col(f"p.{instant}").alias(instant), "p.target", "p.reference", *(c.alias(f"d{k}") for k, c in zip("xyz", d, strict=True)), *(c.alias(f"e{k}") for k, c in zip("xyzw", q, strict=True)))


def pose_clusters(votes: DataFrame, group: str, vote: str, reach: float, degrees: float, weight: float = 0.02) -> DataFrame:
    """Per group the seed vote with most votes within reach and degrees of it, then the least cost (distance + weight x degrees), then the smallest vote.

    Returns group, seed, kept and the largest distance and angle from the seed. A group is the
    votes of one frame, so its pairs are bounded by the cameras.
    """
    x, y = votes.alias("x"), votes.alias("y")
    apart, turned = P.norm(P.sub(position("x."), position("y."))), P.angle(rotation("x."), rotation("y."))
    near = x.join(y, (F.col(f"x.{group}") == F.col(f"y.{group}")) & (apart <= reach) & (turned <= degrees))
    each = near.groupBy(F.col(f"x.{group}").alias(group), F.col(f"x.{vote}").alias("seed")).agg(F.count(F.lit(1)).alias("kept"), F.round(F.sum(apart + weight * turned), 9).alias("cost"), F.max(apart).alias("centre_spread"), F.max(turned).alias("angle_spread"))
    best = F.min_by(F.struct("seed", "kept", "centre_spread", "angle_spread"), F.struct(-F.col("kept"), "cost", "seed")).alias("b")
    return each.groupBy(group).agg(best).select(group, "b.*")


def _then(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    (p, s), (q, r) = a, b
    u, v = p[:3], q[:3]
    turn = lambda x: x + 2 * np.cross(u, np.cross(u, x) + p[3] * x)
    return np.array([*(p[3] * v + q[3] * u + np.cross(u, v)), p[3] * q[3] - u @ v]), turn(r) + s


def rig_from_edges(edges: DataFrame, reference: int) -> DataFrame:
    """camera, reached, step and pose (as seen from the reference) of every camera of the edges of pair_edges.

    Edges are tried in order of falling shared_frames, then residual; one that leads from a camera
    with a pose to one without gives it a pose, and the search starts over until nothing changes.
    Each step depends on all before it, so it runs on the driver, over at most MOST_CAMERAS
    squared edges; a larger rig is an error.
    """
    rows = edges.orderBy(F.desc("shared_frames"), "residual", "camera_a", "camera_b").limit(MOST_CAMERAS**2 + 1).collect()
    if len(rows) > MOST_CAMERAS**2:
        raise ValueError(f"a rig has at most {MOST_CAMERAS} cameras")
    known = {reference: (np.array([0.0, 0, 0, 1]), np.zeros(3), 0)}
    step = 0
    while True:
        new = next((r for r in rows if r.camera_a in known and r.camera_b not in known), None)
        if new is None:
            break
        step += 1
        known[new.camera_b] = (*_then(known[new.camera_a][:2], (np.array(list(new.turn)), np.array([new.mx, new.my, new.mz]))), step)
    every = sorted({r.camera_a for r in rows} | {r.camera_b for r in rows} | {reference})
    out = [(int(c), c in known, known[c][2] if c in known else None, *([float(x) for x in (*known[c][0], *known[c][1])] if c in known else [None] * 7)) for c in every]
    return edges.sparkSession.createDataFrame(out, "camera int, reached boolean, step int, " + ", ".join(f"{k} double" for k in POSE))


def relative_consensus(votes: DataFrame, reach: float, degrees: float, least: int) -> DataFrame:
    """Per (target, reference) the vote (frame) that most votes agree with in position and rotation: frame, inliers, middle (their median distance).

    Ties go to the smaller median distance, then the earlier frame; pairs with fewer than least
    agreeing votes have no row. Votes meet in cells of one reach only. They are counted as they
    meet; distances are put in order only for the votes that most agree with, so what is written
    grows with the votes, not with their square.
    """
    checkpoint_dir(votes.sparkSession)
    keyed = votes.select(F.struct("target", "reference").alias("_pair"), "frame", *(f"d{k}" for k in "xyz"), *(f"e{k}" for k in "xyzw")).checkpoint()
    near = close_poses(keyed, "frame", "_pair", ["dx", "dy", "dz"], ["ex", "ey", "ez", "ew"], reach, degrees, kept=["_pair"])
    both = near.select("_pair", F.explode(F.array("id_a", "id_b")).alias("frame"), "apart")
    counts = both.groupBy("_pair", "frame").agg(F.count(F.lit(1)).alias("_n"))
    alone = keyed.groupBy("_pair", "frame").agg(F.count(F.lit(1)).alias("_n"))
    agreeing = counts.unionByName(alone).groupBy("_pair", "frame").agg(F.sum("_n").alias("_n")).where(F.col("_n") >= least).checkpoint()
    most = agreeing.groupBy("_pair").agg(F.max("_n").alias("_n"))
    leaders = agreeing.join(most, ["_pair", "_n"]).select("_pair", "frame").checkpoint()
    itself = keyed.select("_pair", "frame", F.lit(0.0).alias("apart"))
    each = grouped_quantiles(both.unionByName(itself).join(leaders, ["_pair", "frame"], "left_semi"), ["_pair", "frame"], {"middle": ("apart", 0.5)})
    best = F.min_by(F.struct("frame", F.col("n").alias("inliers"), "middle"), F.struct(F.round("middle", 9), "frame"))
    return each.groupBy("_pair").agg(best.alias("_b")).select("_pair.target", "_pair.reference", "_b.*")


def complete_in_order(known: DataFrame, relatives: DataFrame, order: list[tuple[int, int]], cameras: int) -> DataFrame:
    """camera, completed and pose of all cameras: known ones, and for each (target, reference) of the configured order the reference's pose times the relative one.

    A pair counts only if its reference is known or was completed by an earlier pair. The order is
    a configuration of at most MOST_CAMERAS pairs, and relatives has one row for each, so the fold
    runs on the driver.
    """
    if max(cameras, len(order)) > MOST_CAMERAS:
        raise ValueError(f"a rig has at most {MOST_CAMERAS} cameras")
    poses = {r.camera: (np.array([r.qx, r.qy, r.qz, r.qw]), np.array([r.tx, r.ty, r.tz])) for r in known.limit(MOST_CAMERAS).collect()}
    moves = {(r.target, r.reference): (np.array([r.ex, r.ey, r.ez, r.ew]), np.array([r.dx, r.dy, r.dz])) for r in relatives.limit(MOST_CAMERAS).collect()}
    for target, reference in order:
        if reference in poses and (target, reference) in moves:
            poses[target] = _then(poses[reference], moves[target, reference])
    rows = [(c, c in poses, *([float(x) for x in (*poses[c][0], *poses[c][1])] if c in poses else [None] * 7)) for c in range(cameras)]
    return known.sparkSession.createDataFrame(rows, "camera int, completed boolean, " + ", ".join(f"{k} double" for k in POSE))
