"""Queries on poses: matrices, composition, interpolation in time, pairwise edges, consensus. SQL states them by matrices where the library uses quaternions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions import poses as P
from sightline.operators import motion as M
from sightline.plans.catalog import n_rows, query, r6, t

# Every row of embeddings is a pose: eight cameras, and a frame for each eight rows.
_ENTRIES = {
    "r00": "1 - 2 * (qy * qy + qz * qz)", "r01": "2 * (qx * qy - qz * qw)", "r02": "2 * (qx * qz + qy * qw)",
    "r10": "2 * (qx * qy + qz * qw)", "r11": "1 - 2 * (qx * qx + qz * qz)", "r12": "2 * (qy * qz - qx * qw)",
    "r20": "2 * (qx * qz - qy * qw)", "r21": "2 * (qy * qz + qx * qw)", "r22": "1 - 2 * (qx * qx + qy * qy)",
}
_E = lambda k: f"CAST(embedding[{k}] AS DOUBLE)"
_N = f"sqrt({' + '.join(f'{_E(k)} * {_E(k)}' for k in range(1, 5))})"
POSES = f"""p0 AS (SELECT vec_id, CAST(vec_id % 8 AS INT) AS cam, vec_id // 8 AS frame, label, {', '.join(f'{_E(k)} / {_N} AS {n}' for k, n in enumerate(('qx', 'qy', 'qz', 'qw'), 1))}, {', '.join(f'10 * {_E(k)} AS {n}' for k, n in enumerate(('tx', 'ty', 'tz'), 5))}, {', '.join(f'3 * {_E(k)} AS {n}' for k, n in enumerate(('wx', 'wy', 'wz'), 8))} FROM embeddings),
p AS (SELECT *, {', '.join(f'{v} AS {k}' for k, v in _ENTRIES.items())} FROM p0)"""


def poses(spark, sf) -> DataFrame:
    e = t(spark, sf, "embeddings")
    v = lambda k: F.element_at("embedding", k).cast("double")
    q = P.unit(tuple(v(k) for k in range(1, 5)))
    named = {"qx": q[0], "qy": q[1], "qz": q[2], "qw": q[3], "tx": 10 * v(5), "ty": 10 * v(6), "tz": 10 * v(7), "wx": 3 * v(8), "wy": 3 * v(9), "wz": 3 * v(10)}
    return e.select("vec_id", (F.col("vec_id") % 8).cast("int").alias("cam"), F.floor(F.col("vec_id") / 8).alias("frame"), "label", *(c.alias(n) for n, c in named.items()))


def _r(prefix: str, p: tuple[str, str, str]) -> list[str]:
    """SQL of a rotated vector."""
    return [" + ".join(f"{prefix}r{i}{j} * ({p[j]})" for j in range(3)) for i in range(3)]


def _rt(prefix: str, p: tuple[str, str, str]) -> list[str]:
    return [" + ".join(f"{prefix}r{j}{i} * ({p[j]})" for j in range(3)) for i in range(3)]


def _minus(a: str, b: str) -> tuple[str, str, str]:
    return tuple(f"({a}t{k} - {b}t{k})" for k in "xyz")


@query(f"WITH {POSES} SELECT vec_id, {', '.join(f'round({k}, 6) AS {k}' for k in _ENTRIES)}, {', '.join(f'round(q{k} * CASE WHEN qw < 0 THEN -1 ELSE 1 END, 6) AS back_{k}' for k in 'xyzw')} FROM p")
def pose_matrices(spark, sf):
    """Quaternion to matrix and back."""
    p = poses(spark, sf)
    m = p.select("vec_id", *(c.alias(k) for k, c in zip(_ENTRIES, P.to_matrix(M.rotation()), strict=True)))
    back = P.from_matrix([F.col(k) for k in _ENTRIES])
    return m.select("vec_id", *(r6(F.col(k), k) for k in _ENTRIES), *(r6(c, f"back_{k}") for k, c in zip("xyzw", back, strict=True)))


_POINT = ("1.0", "2.0", "3.0")
_IN_B = [f"{x} + b.t{k}" for k, x in zip("xyz", _r("b.", _POINT), strict=True)]
_IN_A = _rt("a.", tuple(f"({x}) - a.t{k}" for k, x in zip("xyz", _IN_B, strict=True)))


@query(f"WITH {POSES} SELECT a.vec_id, {', '.join(f'round({x}, 6) AS {k}' for k, x in zip('xyz', _IN_A, strict=True))} FROM p a JOIN p b ON b.frame = a.frame AND b.cam = a.cam + 1")
def pose_chain(spark, sf):
    """A point of the next camera of the frame, seen from this one: invert, compose, transform."""
    p = poses(spark, sf)
    both = p.alias("a").join(p.withColumn("cam", F.col("cam") - 1).alias("b"), ["frame", "cam"])
    moved = P.transform(P.compose(P.invert(M.pose("a.")), M.pose("b.")), tuple(F.lit(float(x)) for x in _POINT))
    return both.select(F.col("a.vec_id").alias("vec_id"), *(r6(c, k) for k, c in zip("xyz", moved, strict=True)))


_W = "w AS (SELECT vec_id, wx, wy, wz, sqrt(wx * wx + wy * wy + wz * wz) AS a, tx, ty, tz FROM p)"
_ONE = "(SELECT *, sin(a) / a AS s, (1 - cos(a)) / (a * a) AS c, (a - sin(a)) / (a * a * a) AS d, wy * tz - wz * ty AS cx, wz * tx - wx * tz AS cy, wx * ty - wy * tx AS cz FROM w)"


@query(f"""WITH {POSES}, {_W} SELECT vec_id, round(1 - c * (wy * wy + wz * wz), 6) AS ex, round(s * wz + c * wx * wy, 6) AS ey, round(c * wx * wz - s * wy, 6) AS ez,
 round(wx, 6) AS lx, round(wy, 6) AS ly, round(wz, 6) AS lz, round(-wz, 6) AS s01, round(wy, 6) AS s02, round(-wx, 6) AS s12,
 round(tx + c * cx + d * (wy * cz - wz * cy), 6) AS vx, round(ty + c * cy + d * (wz * cx - wx * cz), 6) AS vy, round(tz + c * cz + d * (wx * cy - wy * cx), 6) AS vz FROM {_ONE}""")
def rotation_vectors(spark, sf):
    """exp of a rotation vector (as the turned x axis), log of that, skew, and the translation of a motion's exp."""
    p = poses(spark, sf)
    w, v = (tuple(F.col(f"{n}{k}") for k in "xyz") for n in "wt")
    q = P.exp(w)
    x, back, s, moved = P.rotate(q, (F.lit(1.0), F.lit(0.0), F.lit(0.0))), P.log(q), P.skew(w), P.exp_motion(w, v)[1]
    named = dict(zip(("ex", "ey", "ez", "lx", "ly", "lz", "s01", "s02", "s12", "vx", "vy", "vz"), (*x, *back, s[1], s[2], s[5], *moved), strict=True))
    return p.select("vec_id", *(r6(c, n) for n, c in named.items()))


_LERP = "CASE WHEN b.vec_id IS NULL THEN f.{0} WHEN f.vec_id IS NULL OR f.frame = b.frame THEN b.{0} ELSE b.{0} + (f.{0} - b.{0}) * u END"
_SLERP = "CASE WHEN b.vec_id IS NULL THEN f.{0} WHEN f.vec_id IS NULL OR f.frame = b.frame THEN b.{0} WHEN acos(least(abs(d), 1.0)) < 1e-9 THEN (1 - u) * b.{0} + u * f.{0} * CASE WHEN d < 0 THEN -1 ELSE 1 END ELSE (sin((1 - u) * acos(least(abs(d), 1.0))) * b.{0} + sin(u * acos(least(abs(d), 1.0))) * f.{0} * CASE WHEN d < 0 THEN -1 ELSE 1 END) / sin(acos(least(abs(d), 1.0))) END"


@query(f"""WITH {POSES}, k AS (SELECT * FROM p WHERE frame % 3 = 0 AND frame % 21 <> 0), n AS (SELECT q.vec_id, q.cam, q.frame AS fr, max(b.frame) FILTER (WHERE b.frame <= q.frame) AS lo, min(b.frame) FILTER (WHERE b.frame >= q.frame) AS hi FROM p q JOIN k b ON b.cam = q.cam GROUP BY ALL),
j AS (SELECT n.vec_id, n.fr, b, f, (fr - b.frame) / CAST(f.frame - b.frame AS DOUBLE) AS u, b.qx * f.qx + b.qy * f.qy + b.qz * f.qz + b.qw * f.qw AS d FROM n LEFT JOIN k b ON b.cam = n.cam AND b.frame = n.lo LEFT JOIN k f ON f.cam = n.cam AND f.frame = n.hi WHERE coalesce(f.frame, b.frame) - coalesce(b.frame, f.frame) <= 5)
SELECT vec_id, {', '.join(f'round({_LERP.format(f"t{k}")}, 5) AS t{k}' for k in 'xyz')}, {', '.join(f'round({_SLERP.format(f"q{k}")}, 5) AS q{k}' for k in 'xyzw')} FROM j""")
def pose_interpolation(spark, sf):
    """Each camera's pose at every frame, from key frames: slerp and linear, clamped at the ends, none across a gap of over five."""
    p = poses(spark, sf)
    keys = p.where("frame % 3 = 0 AND frame % 21 <> 0")
    out = M.interpolated_poses(p.select("vec_id", "cam", "frame"), keys, ["cam"], "frame", 5)
    return out.select("vec_id", *(F.round(F.col(c), 5).alias(c) for c in ("tx", "ty", "tz", "qx", "qy", "qz", "qw")))


_REL = _rt("a.", _minus("b.", "a."))
EDGES = f"""g AS (SELECT a.cam AS camera_a, b.cam AS camera_b, {', '.join(f'{x} AS d{k}' for k, x in zip('xyz', _REL, strict=True))} FROM p a JOIN p b ON a.frame = b.frame AND a.cam <> b.cam),
h AS (SELECT camera_a, camera_b, count(*) AS shared_frames, {', '.join(f'median(d{k}) AS m{k}' for k in 'xyz')} FROM g GROUP BY ALL),
e AS (SELECT camera_a, camera_b, shared_frames, round(any_value(mx), 5) AS mx, round(any_value(my), 5) AS my, round(any_value(mz), 5) AS mz, round(median(sqrt((dx - mx) * (dx - mx) + (dy - my) * (dy - my) + (dz - mz) * (dz - mz))), 5) AS residual FROM g JOIN h USING (camera_a, camera_b) GROUP BY ALL)"""


@query(f"WITH {POSES}, {EDGES} SELECT *, row_number() OVER (ORDER BY shared_frames DESC, residual, camera_a, camera_b) AS priority FROM e")
def pairwise_edges(spark, sf):
    """Relative poses of ordered camera pairs, their component-wise median, the median distance to it, and the edges' priority. Pairs are bounded by the cameras, not the rows."""
    e = M.pair_edges(poses(spark, sf), "frame", "cam")
    rank = F.row_number().over(W.orderBy(F.desc("shared_frames"), "residual", "camera_a", "camera_b"))
    return e.select("camera_a", "camera_b", "shared_frames", *(F.round(f"m{k}", 5).alias(f"m{k}") for k in "xyz"), F.round("residual", 5).alias("residual")).withColumn("priority", rank.cast("bigint"))


@query(f"WITH {POSES}, c(target, reference) AS (VALUES (1, 0), (2, 0), (5, 4), (3, 7)) SELECT p.frame, target, reference, {', '.join(f'round({x}, 5) AS d{k}' for k, x in zip('xyz', _rt('r.', _minus('p.', 'r.')), strict=True))} FROM c JOIN p ON p.cam = target JOIN p r ON r.cam = reference AND r.frame = p.frame")
def relative_votes(spark, sf):
    """Votes of each frame for the relative pose of the configured camera pairs."""
    pairs = spark.createDataFrame([(1, 0), (2, 0), (5, 4), (3, 7)], "target int, reference int")
    return M.relative_votes(poses(spark, sf), pairs, "frame", "cam").select("frame", "target", "reference", *(F.round(f"d{k}", 5).alias(f"d{k}") for k in "xyz"))


_ANGLE = "degrees(2 * acos(least(abs(x.qx * y.qx + x.qy * y.qy + x.qz * y.qz + x.qw * y.qw), 1.0)))"
_APART = "sqrt((x.tx - y.tx) * (x.tx - y.tx) + (x.ty - y.ty) * (x.ty - y.ty) + (x.tz - y.tz) * (x.tz - y.tz))"


@query(f"""WITH {POSES}, c AS (SELECT x.frame, x.vec_id AS seed, count(*) AS n, sum({_APART} + 0.02 * {_ANGLE}) AS cost FROM p x JOIN p y ON x.frame = y.frame AND {_APART} <= 2.2 AND {_ANGLE} <= 150 GROUP BY ALL),
b AS (SELECT frame, seed, n FROM c QUALIFY row_number() OVER (PARTITION BY frame ORDER BY n DESC, round(cost, 9), seed) = 1)
SELECT b.frame, seed, n AS kept, max(round({_APART}, 5)) AS centre_spread, max(round({_ANGLE}, 4)) AS angle_spread FROM b JOIN p x ON x.vec_id = seed JOIN p y ON y.frame = b.frame AND {_APART} <= 2.2 AND {_ANGLE} <= 150 GROUP BY b.frame, seed, n""")
def pose_clusters(spark, sf):
    """Per frame the vote with most votes within reach (distance and angle), then least cost, then the earliest; with the cluster's spread about it."""
    return M.pose_clusters(poses(spark, sf), "frame", "vec_id", 2.2, 150.0).select("frame", "seed", "kept", F.round("centre_spread", 5).alias("centre_spread"), F.round("angle_spread", 4).alias("angle_spread"))


@query(f"WITH {POSES} SELECT vec_id, round(degrees(atan2(r10, r00)), 4) AS yaw, round(degrees(asin(greatest(-1.0, least(1.0, -r20)))), 4) AS pitch, round(degrees(atan2(r21, r22)), 4) AS roll, round(tx, 6) AS x, round(-tz, 6) AS y, round(ty, 6) AS z FROM p")
def canonical_frame(spark, sf):
    """Yaw, pitch and roll, and the position with the vertical axis turned from y to z."""
    yaw, pitch, roll = P.euler(M.rotation())
    return poses(spark, sf).select("vec_id", F.round(yaw, 4).alias("yaw"), F.round(pitch, 4).alias("pitch"), F.round(roll, 4).alias("roll"), r6(F.col("tx"), "x"), r6(-F.col("tz"), "y"), r6(F.col("ty"), "z"))


@query(f"WITH {POSES}, w AS (SELECT *, 1 / pow(greatest(abs(wx), 0.05), 2) AS wt FROM p) SELECT cam, count(*) AS votes, {', '.join(f'round(sum(wt * t{k}) / sum(wt), 6) AS t{k}' for k in 'xyz')}, {', '.join(f'round(median(t{k}), 6) AS m{k}' for k in 'xyz')} FROM w GROUP BY cam")
def vote_average(spark, sf):
    """Initial rig positions: the votes' mean, weighted by inverse squared error with a floor, and their median."""
    w = 1 / F.pow(F.greatest(F.abs("wx"), F.lit(0.05)), 2)
    return poses(spark, sf).groupBy("cam").agg(n_rows("votes"), *(r6(F.sum(w * F.col(f"t{k}")) / F.sum(w), f"t{k}") for k in "xyz"), *(r6(F.median(f"t{k}"), f"m{k}") for k in "xyz"))


@query(f"WITH {POSES}, m AS (SELECT 24 + cam AS camera, frame, 'inner' AS source, tx FROM p WHERE cam < 4 UNION ALL SELECT cam, frame, 'outer', tx FROM p WHERE cam >= 4) SELECT camera, frame, source, round(tx, 6) AS tx FROM m")
def pose_sources(spark, sf):
    """Poses of two sources in one index space: outer cameras keep theirs, inner ones follow from 24."""
    p = poses(spark, sf)
    inner = p.where("cam < 4").select((F.lit(24) + F.col("cam")).alias("camera"), "frame", F.lit("inner").alias("source"), r6(F.col("tx"), "tx"))
    return inner.unionByName(p.where("cam >= 4").select(F.col("cam").alias("camera"), "frame", F.lit("outer").alias("source"), r6(F.col("tx"), "tx")))


@query()
def rig_propagation(spark, sf):
    """Camera poses in the frame of camera 0, by the edges in order of priority."""
    return M.rig_from_edges(M.pair_edges(poses(spark, sf), "frame", "cam"), reference=0)


_VOTE = f"v AS (SELECT a.frame, b.cam AS target, a.cam AS reference, {', '.join(f'{x} AS d{k}' for k, x in zip('xyz', _REL, strict=True))} FROM p a JOIN p b ON a.frame = b.frame AND b.cam = a.cam + 1)"
_NEAR = "sqrt((x.dx - y.dx) * (x.dx - y.dx) + (x.dy - y.dy) * (x.dy - y.dy) + (x.dz - y.dz) * (x.dz - y.dz))"


@query(f"""WITH {POSES}, {_VOTE}, s AS (SELECT x.target, x.reference, x.frame, count(*) AS inliers, round(median({_NEAR}), 9) AS middle FROM v x JOIN v y ON x.target = y.target AND x.reference = y.reference AND {_NEAR} <= 1.5 GROUP BY ALL)
SELECT target, reference, frame, inliers, round(middle, 6) AS middle FROM s WHERE inliers >= 2 QUALIFY row_number() OVER (PARTITION BY target, reference ORDER BY inliers DESC, middle, frame) = 1""")
def relative_consensus(spark, sf):
    """Per camera pair the frame whose relative position most votes agree with, then the least median distance, then the earliest."""
    pairs = spark.createDataFrame([(k + 1, k) for k in range(7)], "target int, reference int")
    votes = M.relative_votes(poses(spark, sf), pairs, "frame", "cam")
    return M.relative_consensus(votes, 1.5, 180.0, least=2).select("target", "reference", "frame", "inliers", r6(F.col("middle"), "middle"))


@query(f"""WITH {POSES}, e AS (SELECT cam, frame, {', '.join(f'q{k}' for k in 'xyzw')}, tx, ty, tz FROM p WHERE frame = 3), c AS (SELECT cam, tx, ty, tz FROM e)
SELECT CAST(cam AS INT) AS camera, cam < 6 AS completed, CASE WHEN cam < 6 THEN round(tx, 5) END AS tx, CASE WHEN cam < 6 THEN round(ty, 5) END AS ty, CASE WHEN cam < 6 THEN round(tz, 5) END AS tz FROM c""")
def ordered_completion(spark, sf):
    """Poses completed pair by pair from relative poses, each from poses that earlier pairs completed: camera 0 is known, 7's reference never is."""
    p = poses(spark, sf).where("frame = 3")
    order = [(1, 0), (2, 1), (6, 7), (3, 2), (4, 1), (5, 4)]
    votes = M.relative_votes(p, spark.createDataFrame(order, "target int, reference int"), "frame", "cam")
    out = M.complete_in_order(p.where("cam = 0").select(F.col("cam").alias("camera"), *M.POSE), votes, order, 8)
    return out.select("camera", "completed", *(F.round(c, 5).alias(c) for c in ("tx", "ty", "tz")))
