"""Rig poses voted by many frames, each aligned to known anchors by a similarity."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.shared import checkpoint_dir
from sightline.functions.ship import ship
from sightline.operators.quantiles import grouped_quantiles
from sightline.operators.refine import multiplied, turned

QUATERNION, CENTRE = ("qx", "qy", "qz", "qw"), ("cx", "cy", "cz")
MOST_ANCHORS = 256


@dataclass
class Voted:
    """frames: frame, status, missing (anchors), scale, rms. votes: frame, label, centre and rotation in the rig, tracks; robust_poses joins them."""

    frames: DataFrame
    votes: DataFrame


def _cut(frame: DataFrame) -> DataFrame:
    """From the shared folder: what follows reads it more than once."""
    checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def quaternions(m: np.ndarray) -> np.ndarray:
    """Unit quaternions (x, y, z, w) of rotation matrices (n x 3 x 3): eigenvectors of the largest eigenvalue."""
    k = np.zeros((len(m), 4, 4))
    xx, xy, xz, yx, yy, yz, zx, zy, zz = m.reshape(-1, 9).T
    k[:, 0, 0], k[:, 1, 1], k[:, 2, 2], k[:, 3, 3] = xx - yy - zz, yy - xx - zz, zz - xx - yy, xx + yy + zz
    k[:, 0, 1] = k[:, 1, 0] = xy + yx
    k[:, 0, 2] = k[:, 2, 0] = xz + zx
    k[:, 1, 2] = k[:, 2, 1] = yz + zy
    k[:, 0, 3] = k[:, 3, 0] = zy - yz
    k[:, 1, 3] = k[:, 3, 1] = xz - zx
    k[:, 2, 3] = k[:, 3, 2] = yx - xy
    q = np.linalg.eigh(k)[1][:, :, -1]
    return q * np.where(q[:, 3:] < 0, -1.0, 1.0)


def similarities(pairs: DataFrame, key: str) -> DataFrame:
    """Per key the similarity (scale, qx.., tx..) that takes points sx, sy, sz to points gx, gy, gz best; null for a key without spread.

    The moments are Spark sums about each key's means; all keys of a batch are solved at once.
    """
    ship(pairs.sparkSession)
    mean = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *(F.avg(f"{a}{k}").alias(f"m_{a}{k}") for a in "sg" for k in "xyz"))
    off = pairs.join(mean, key).withColumns({f"d_{a}{k}": F.col(f"{a}{k}") - F.col(f"m_{a}{k}") for a in "sg" for k in "xyz"})
    moments = off.groupBy(key).agg(*(F.avg(F.col(f"d_g{i}") * F.col(f"d_s{j}")).alias(f"c{i}{j}") for i in "xyz" for j in "xyz"), F.avg(sum((F.col(f"d_s{k}") ** 2 for k in "yz"), F.col("d_sx") ** 2)).alias("spread"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            col = lambda names: np.stack([np.asarray(b.column(k), np.float64) for k in names], 1)
            u, s, vt = np.linalg.svd(col([f"c{i}{j}" for i in "xyz" for j in "xyz"]).reshape(-1, 3, 3))
            sign = np.ones((len(s), 3))
            sign[:, 2] = np.where(np.linalg.det(u) * np.linalg.det(vt) < 0, -1, 1)
            rotation = quaternions((u * sign[:, None, :]) @ vt)
            spread = np.asarray(b.column("spread"), np.float64)
            fine = spread > 0
            scale = np.where(fine, (s * sign).sum(1) / np.where(fine, spread, 1), np.nan)
            shift = col([f"m_g{k}" for k in "xyz"]) - scale[:, None] * turned(rotation, col([f"m_s{k}" for k in "xyz"]))
            values = [scale, *rotation.T, *shift.T, *s.T]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, mask=~fine) for v in values)], names)

    names = [key, "scale", *(f"r_{k}" for k in QUATERNION), "tx", "ty", "tz", "sv0", "sv1", "sv2"]
    return moments.join(mean.drop("n"), key).select(key, *(f"c{i}{j}" for i in "xyz" for j in "xyz"), "spread", *(f"m_{a}{k}" for a in "sg" for k in "xyz")).mapInArrow(solve, f"{key} {pairs.schema[key].dataType.simpleString()}, " + ", ".join(f"{n} double" for n in names[1:]))


def _moved(rows: DataFrame) -> DataFrame:
    """rows with centre (cx, cy, cz) and rotation (qx..) taken through their frame's similarity; the rotation is from the camera to the rig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = lambda names: np.stack([np.asarray(b.column(k), np.float64) for k in names], 1)
            turn = col([f"r_{k}" for k in QUATERNION])
            centre = np.asarray(b.column("scale"), np.float64)[:, None] * turned(turn, col(CENTRE)) + col(("tx", "ty", "tz"))
            q = multiplied(turn, col(QUATERNION))
            new = dict(zip((*CENTRE, *QUATERNION), (*centre.T, *q.T), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(new[n]) if n in new else b.column(n) for n in b.schema.names], b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def robust_poses(votes: DataFrame, label: str, least: int, gate: float) -> DataFrame:
    """Per label the median centre of the votes within max(gate, median + 3 scaled deviations) of the median centre, their mean rotation, and how far they are from both.

    Labels with fewer than least votes, before or after the gate, have no row. Medians come from value
    counts, the rotation from sums of quaternion products; no label's votes are gathered.
    """
    ship(votes.sparkSession)
    middle = grouped_quantiles(votes, [label], {f"m{k}": (k, 0.5) for k in CENTRE}).where(F.col("n") >= least).withColumnRenamed("n", "raw_votes")
    far = lambda a: F.sqrt(sum((F.pow(F.col(k) - F.col(f"{a}{k}"), 2) for k in CENTRE[1:]), F.pow(F.col(CENTRE[0]) - F.col(f"{a}{CENTRE[0]}"), 2)))
    rows = _cut(votes.join(middle, label).withColumn("off", far("m")))
    med = grouped_quantiles(rows, [label], {"med": ("off", 0.5)}).select(label, "med")
    rows = rows.join(med, label).withColumn("dev", F.abs(F.col("off") - F.col("med")))
    mad = grouped_quantiles(rows, [label], {"mad": ("dev", 0.5)}).select(label, "mad")
    rows = _cut(rows.join(mad, label).where(F.col("off") <= F.greatest(F.lit(float(gate)), F.col("med") + 3.0 * 1.4826 * F.col("mad"))))
    inner = grouped_quantiles(rows, [label], {f"p{k}": (k, 0.5) for k in CENTRE} | {"track_median": ("tracks", 0.5)}).where(F.col("n") >= least).withColumnRenamed("n", "inlier_votes")
    sums = rows.groupBy(label).agg(*(F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for i, a in enumerate(QUATERNION) for b in QUATERNION[i:]))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, j = np.triu_indices(4)
        for b in batches:
            if b.num_rows:
                m = np.zeros((b.num_rows, 4, 4))
                m[:, i, j] = m[:, j, i] = np.stack([np.asarray(c, np.float64) for c in b.columns[1:]], 1)
                q = np.linalg.eigh(m)[1][:, :, -1]
                q *= np.where(q[:, 3:] < 0, -1.0, 1.0)
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in q.T)], [label, *(f"r_{k}" for k in QUATERNION)])

    mean = sums.mapInArrow(solve, f"{label} {votes.schema[label].dataType.simpleString()}, " + ", ".join(f"r_{k} double" for k in QUATERNION))
    near = F.abs(sum((F.col(k) * F.col(f"r_{k}") for k in QUATERNION[1:]), F.col(QUATERNION[0]) * F.col(f"r_{QUATERNION[0]}")))
    mean, inner = _cut(mean), _cut(inner)
    last = rows.join(inner, label).join(mean, label).withColumns({"c_off": far("p"), "r_off": F.degrees(2 * F.acos(F.least(near, F.lit(1.0))))}).select(label, "c_off", "r_off")
    told = grouped_quantiles(last, [label], {"center_median_residual_m": ("c_off", 0.5), "center_p90_residual_m": ("c_off", 0.9), "rotation_median_residual_deg": ("r_off", 0.5), "rotation_p90_residual_deg": ("r_off", 0.9)}).drop("n")
    return middle.select(label, "raw_votes").join(inner, label).join(mean, label).join(told, label).withColumnsRenamed({f"p{k}": k for k in CENTRE} | {f"r_{k}": k for k in QUATERNION})


def frame_votes(images: DataFrame, anchors: DataFrame, max_rms: float, max_norm: float, least_tracks: int) -> Voted:
    """Every frame's images taken to the rig by the frame's anchors.

    images: frame, label, cx, cy, cz (centre in the frame's own world), qx..qw (camera to that world), tracks. anchors: label, ax, ay, az (centres in
    the rig), a configured list of at most MOST_ANCHORS. A frame's status is missing_anchors (with
    the labels), bad_anchor_alignment (no positive scale, or a root mean square above max_rms) or
    accepted. Votes of accepted frames count within max_norm of the rig's origin and from least_tracks on.
    """
    spark = images.sparkSession
    known = anchors.select("label", "ax", "ay", "az").limit(MOST_ANCHORS + 1).collect()
    if len(known) > MOST_ANCHORS:
        raise ValueError(f"at most {MOST_ANCHORS} anchors")
    few = F.broadcast(spark.createDataFrame(known, anchors.select("label", "ax", "ay", "az").schema))
    pairs = images.join(few, "label").select("frame", "label", *(F.col(k).alias(f"s{k[1]}") for k in CENTRE), F.col("ax").alias("gx"), F.col("ay").alias("gy"), F.col("az").alias("gz"))
    listed = F.array_sort(F.array(*(F.lit(r["label"]) for r in known)).cast(f"array<{anchors.schema['label'].dataType.simpleString()}>"))
    # a frame's anchors are at most the configured ones, so this set is bounded
    seen = images.select("frame").distinct().join(pairs.groupBy("frame").agg(F.collect_set("label").alias("_seen")), "frame", "left")
    missing = F.array_except(listed, F.coalesce("_seen", F.array().cast(listed_type(anchors))))
    frames = seen.select("frame", F.array_sort(missing).alias("missing"))
    whole = pairs.join(frames.where(F.size("missing") == 0).select("frame"), "frame")
    fits = _cut(similarities(whole, "frame"))
    turned_pairs = _moved(whole.join(fits, "frame").select("frame", *(F.col(f"s{k[1]}").alias(k) for k in CENTRE), *(F.lit(1.0 if k == "qw" else 0.0).alias(k) for k in QUATERNION), "gx", "gy", "gz", "scale", *(f"r_{k}" for k in QUATERNION), "tx", "ty", "tz"))
    square = sum((F.pow(F.col(k) - F.col(f"g{k[1]}"), 2) for k in CENTRE[1:]), F.pow(F.col("cx") - F.col("gx"), 2))
    rms = turned_pairs.groupBy("frame").agg(F.sqrt(F.avg(square)).alias("rms"))
    frames = _cut(frames.join(fits.join(rms, "frame"), "frame", "left"))
    bad = F.col("scale").isNull() | F.isnan("scale") | (F.col("scale") <= 0) | ~F.coalesce(F.col("rms") <= max_rms, F.lit(False))
    frames = frames.withColumn("status", F.when(F.size("missing") > 0, "missing_anchors").when(bad, "bad_anchor_alignment").otherwise("accepted"))
    good = frames.where("status = 'accepted'").select("frame", "scale", *(f"r_{k}" for k in QUATERNION), "tx", "ty", "tz")
    votes = _moved(images.select("frame", "label", *CENTRE, *QUATERNION, "tracks").join(good, "frame")).select("frame", "label", *CENTRE, *QUATERNION, "tracks")
    norm = F.sqrt(sum((F.pow(F.col(k), 2) for k in CENTRE[1:]), F.pow(F.col("cx"), 2)))
    votes = _cut(votes.where((norm <= max_norm) & (F.col("tracks") >= least_tracks)))
    return Voted(frames.select("frame", "status", "missing", "scale", "rms", "sv0", "sv1", "sv2"), votes)


def listed_type(anchors: DataFrame) -> str:
    return f"array<{anchors.schema['label'].dataType.simpleString()}>"
