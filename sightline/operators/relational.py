"""Composable DataFrame operators of the measurement studio: quality gates, joins in time, coverage, robust statistics.

Every function takes and returns DataFrames; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sightline.functions.names import fresh
from sightline.functions.shared import checkpoint_dir
from sightline.operators.quantiles import counted_median, grouped_quantiles


_NONE = object()


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by order, which must be total for a stable choice."""
    nth = fresh("_nth", df.columns)
    return df.withColumn(nth, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(nth) == 1).drop(nth)


def frame_gate(best: DataFrame, cameras: DataFrame, camera: str, frame: str, passes: Column, least: int, require_all: bool = True) -> DataFrame:
    """Per frame: observed, passing and active cameras, and a status by precedence.

    The domain is frames x cameras, but absent pairs only count, so the camera count is a scalar
    and no cross product is built.
    """
    active = cameras.select(camera).distinct().agg(F.count(F.lit(1)).alias("active_cameras"))
    per = best.join(cameras.select(camera).distinct(), camera, "left_semi").groupBy(frame).agg(F.count(F.lit(1)).alias("observed_cameras"), F.count_if(passes).alias("passing_cameras"))
    out = per.crossJoin(F.broadcast(active))  # one row
    status = F.when(F.lit(require_all) & (F.col("observed_cameras") != F.col("active_cameras")), "missing_camera_metrics").when(F.col("passing_cameras") < least, "below_min_cameras_per_frame").otherwise("selected")
    return out.withColumn("status", status)


def stride_limit(df: DataFrame, order: list[Column], stride: int, most: int) -> DataFrame:
    """Every stride-th row in order, at most most of them, with out_index from 0."""
    n = fresh("_n", df.columns)
    kept = df.withColumn(n, F.row_number().over(W.orderBy(*order)) - 1).where(F.pmod(n, F.lit(stride)) == 0)
    return kept.withColumn("out_index", F.floor(F.col(n) / stride).cast("bigint")).where(F.col("out_index") < most).drop(n)


def dense_index(df: DataFrame, key: str, name: str, parts: int = 64) -> DataFrame:
    """Rank from 0 by a numeric key (unique), without sending all rows to one task.

    Rows fall into ranges between approximate quantiles; a row's rank is its rank in the range plus
    the sizes of the ranges before, of which there are at most parts.
    """
    bounds = sorted(set(df.approxQuantile(key, [k / parts for k in range(1, parts)], 0.002)))
    ranged = df.withColumn("_range", sum((F.when(F.col(key) > b, 1).otherwise(0) for b in bounds), F.lit(0)))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_size")
    rank = F.row_number().over(W.partitionBy("_range").orderBy(key)) - 1
    return ranged.withColumn("_rank", rank).join(F.broadcast(before), "_range").withColumn(name, (F.col("_rank") + F.col("_before")).cast("bigint")).drop("_range", "_rank", "_before")


def runs(df: DataFrame, keys: list[str], order: Column, positive: Column) -> DataFrame:
    """Per key: number of maximal runs of positive rows, and the longest."""
    p, run = fresh("_p", df.columns), fresh("_run", df.columns)
    w = W.partitionBy(*keys).orderBy(order)
    marked = df.withColumn(p, positive).withColumn(run, F.row_number().over(w) - F.row_number().over(W.partitionBy(*keys, p).orderBy(order)))
    per = marked.where(F.col(p)).groupBy(*keys, run).agg(F.count(F.lit(1)).alias("_length"))
    return per.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_runs"), F.max("_length").alias("longest_run"))


def nearest_in_time(left: DataFrame, right: DataFrame, keys: list[str], t: str, right_id: str, tolerance: int | None = None) -> DataFrame:
    """Each left row with the nearest right row of its key, ties to the earlier one; one sort of the union, no pairs."""
    r, i, side, b_, f_, pick_ = (fresh(n, [*left.columns, *right.columns]) for n in ("_r", "_id", "_left", "_b", "_f", "_pick"))
    a = left.withColumns({r: F.lit(None).cast(right.schema[t].dataType), i: F.lit(None).cast(right.schema[right_id].dataType), side: F.lit(1)})
    b = right.select(*keys, t, F.col(t).alias(r), F.col(right_id).alias(i), F.lit(0).alias(side))
    both = a.unionByName(b, allowMissingColumns=True)
    hit = F.when(F.col(side) == 0, F.struct(F.col(r).alias("at"), F.col(i).alias("id")))
    back = W.partitionBy(*keys).orderBy(t, side, F.col(i).desc()).rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy(*keys).orderBy(F.col(t).desc(), side, F.col(i).desc()).rowsBetween(W.unboundedPreceding, 0)
    out = both.withColumns({b_: F.last(hit, True).over(back), f_: F.last(hit, True).over(ahead)}).where(F.col(side) == 1)
    before, after = F.col(t) - F.col(b_)["at"], F.col(f_)["at"] - F.col(t)
    pick = F.when(F.col(f_).isNull() | (before <= after), F.col(b_)).otherwise(F.col(f_))
    out = out.withColumn(pick_, pick).withColumns({"match_id": F.col(pick_)["id"], "delta": F.abs(F.col(t) - F.col(pick_)["at"])}).drop(r, i, side, b_, f_, pick_)
    return out.where(F.col("delta") <= tolerance) if tolerance is not None else out


def interpolated(left: DataFrame, right: DataFrame, keys: list[str], t: str, value: str) -> DataFrame:
    """Each left row with the right value interpolated linearly at its time; null outside the right range."""
    v, side, b_, f_ = (fresh(n, [*left.columns, *right.columns]) for n in ("_v", "_left", "_b", "_f"))
    a = left.withColumns({v: F.lit(None).cast("double"), side: F.lit(1)})
    b = right.select(*keys, t, F.col(value).cast("double").alias(v), F.lit(0).alias(side))
    both = a.unionByName(b, allowMissingColumns=True)
    hit = F.when(F.col(side) == 0, F.struct(F.col(t).alias("t"), F.col(v).alias("v")))
    back = W.partitionBy(*keys).orderBy(t, side, F.col(v)).rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy(*keys).orderBy(F.col(t).desc(), side, F.col(v).desc()).rowsBetween(W.unboundedPreceding, 0)
    out = both.withColumns({b_: F.last(hit, True).over(back), f_: F.last(hit, True).over(ahead)}).where(F.col(side) == 1)
    gap = (F.col(f_)["t"] - F.col(b_)["t"]).cast("double")
    share = F.when(gap == 0, 0.0).otherwise((F.col(t) - F.col(b_)["t"]).cast("double") / gap)
    return out.withColumn("interpolated", F.col(b_)["v"] + (F.col(f_)["v"] - F.col(b_)["v"]) * share).drop(v, side, b_, f_)


#: In covisible_pairs: views that a task pairs, and pairs that it holds unpacked, about.
_VIEWS, _PAIRS = 1_000_000, 4_000_000


def covisible_pairs(views: DataFrame, instant: str, camera: str, domain: DataFrame, later: int = 256, earlier: int = 32_768, tile: int = 1024) -> DataFrame:
    """Instants that each pair of cameras shares, pairs without any included. Pairs are made by instant, not of all rows.

    Cameras count by their rank in the domain, which is broadcast. Views are shuffled once, by instant;
    the pairs of a task are counted there and sent packed to their block of the square of ranks,
    which is so many earlier by so many later cameras. The pairs of the whole domain are made last,
    for a tile of a block's earlier cameras at a time, and stream to the result in an order that
    keeps files small: neighbouring rows have the same camera_a.
    """
    cameras = domain.agg(F.sort_array(F.collect_set(camera)).alias("_cameras"))
    ranks = cameras.select(F.posexplode("_cameras").alias("_rank", "_camera"))
    n = ranks.count()
    wide = -(-n // earlier) or 1
    blocks = views.sparkSession.range(-(-n // later) * wide).where(F.pmod("id", F.lit(wide)) * earlier < (F.floor(F.col("id") / wide) + 1) * later)
    tasks = max(int(views.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-views.count() // _VIEWS))
    seen = views.select(F.col(instant).alias("_instant"), F.col(camera).alias("_camera")).dropna().repartition(tasks, "_instant").join(F.broadcast(ranks), "_camera")
    met = seen.groupBy("_instant").agg(F.sort_array(F.collect_set("_rank")).alias("_ranks")).where(F.size("_ranks") > 1).select("_ranks")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for a, b in _pairs_within(batch.column(0)):
                held.append(((b // later * wide + a // earlier) * earlier + a % earlier) * later + b % later)
                if sum(map(len, held)) >= _PAIRS:
                    yield _packed_blocks(held, earlier * later)
                    held = []
        if held:
            yield _packed_blocks(held, earlier * later)

    kind = domain.schema[camera].dataType.simpleString()
    every = blocks.select(F.col("id").alias("_block"), F.lit(None).cast("binary").alias("_packed"))
    dealt = met.mapInArrow(pack, "_block long, _packed binary").unionByName(every).repartition(blocks.count() or 1, "_block")
    counts = dealt.groupBy("_block").agg(F.collect_list("_packed").alias("_packed"))
    part = lambda at, size: F.slice("_cameras", (at * size + 1).cast("int"), F.lit(size))
    at = {"_a": F.pmod("_block", F.lit(wide)), "_b": F.floor(F.col("_block") / wide)}
    laid = counts.crossJoin(F.broadcast(cameras)).select((at["_b"] * later - at["_a"] * earlier).alias("_ahead"), "_packed", part(at["_a"], earlier).alias("_earlier"), part(at["_b"], later).alias("_later"))
    return laid.mapInArrow(lambda batches: _tiles(batches, later, tile), f"camera_a {kind}, camera_b {kind}, shared bigint")


def _pairs_within(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of the entries of each list, the earlier entries and the later ones, about _PAIRS at a time."""
    values, sizes = lists.flatten().to_numpy().astype(np.int64), np.diff(lists.offsets.to_numpy())
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = np.arange(len(values)) - start
    upto = np.cumsum(before)
    i = 0
    while i < len(values):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] - before[i] + _PAIRS, "right")))
        k = before[i:j]
        first = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k - start[i:j], k)
        yield values[first], np.repeat(values[i:j], k)
        i = j


def _packed_blocks(held: list[np.ndarray], size: int) -> pa.RecordBatch:
    """Distinct cells of each block of so many, and how often they occur, as compressed byte planes of the cells' differences and the counts."""
    cells, counts = np.unique(np.concatenate(held), return_counts=True)
    blocks, at = np.unique(cells // size, return_index=True)
    packed = []
    for block, c, n in zip(blocks, np.split(cells, at[1:]), np.split(counts, at[1:])):
        planes = np.concatenate([np.diff(c, prepend=block * size), n]).astype("<i8").view(np.uint8).reshape(-1, 8).T
        packed.append(len(c).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes), "zstd", asbytes=True))
    return pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(packed, pa.binary())], ["_block", "_packed"])


def _counted_cells(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The cells of one block in order, with their counts added up; merged as they come, so copies of a cell don't pile up."""
    cells, counts, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
    for k, p in enumerate(packed, 1):
        data = p.as_buffer()
        n = int.from_bytes(data[:8].to_pybytes(), "little")
        planes = np.frombuffer(pa.decompress(data[8:], 16 * n, "zstd"), np.uint8).reshape(8, -1)
        both = np.ascontiguousarray(planes.T).view("<i8").ravel()
        held.append((np.cumsum(both[:n]), both[n:]))
        size += n
        if k == len(packed) or size >= _PAIRS:
            c, m = (np.concatenate(x) for x in zip((cells, counts), *held))
            order = np.argsort(c, kind="stable")
            c = c[order]
            at = np.flatnonzero(np.diff(c, prepend=-1))
            cells, counts, held, size = c[at], np.add.reduceat(m[order], at), [], 0
    return cells, counts


def _tiles(batches: Iterator[pa.RecordBatch], width: int, tile: int) -> Iterator[pa.RecordBatch]:
    """All pairs of each row's earlier and later cameras, some earlier ones at a time. _ahead: ranks from the first earlier camera to the first later one."""
    for batch in batches:
        for ahead, packed, earlier, later in zip(*(batch.column(c) for c in ("_ahead", "_packed", "_earlier", "_later"))):
            ahead, earlier, later = ahead.as_py(), earlier.values, later.values
            cells, counts = _counted_cells(packed.values)
            n, whole = len(later), None
            for at in range(0, min(len(earlier), ahead + n), tile):
                some = earlier.slice(at, tile)
                shared = np.zeros((len(some), width), np.int64)
                i, j = np.searchsorted(cells, (at * width, at * width + shared.size))
                shared.ravel()[cells[i:j] - at * width] = counts[i:j]
                shared = shared[:, :n].ravel()
                if at + len(some) <= ahead and len(some) == tile:
                    whole = whole or (pa.array(np.repeat(np.arange(tile), n)), later.take(pa.array(np.tile(np.arange(n), tile))))
                    a, b = some.take(whole[0]), whole[1]
                else:
                    pairs = np.flatnonzero(np.arange(at, at + len(some))[:, None] < np.arange(ahead, ahead + n))
                    a, b, shared = some.take(pa.array(pairs // n)), later.take(pa.array(pairs % n)), shared[pairs]
                yield pa.RecordBatch.from_arrays([a, b, pa.array(shared)], ["camera_a", "camera_b", "shared"])


def cascading_lookup(fact: DataFrame, lookup: DataFrame, levels: list[list[str]], payload: str) -> DataFrame:
    """payload by the first key list that hits; a key with several payloads is ambiguous and skipped. Adds matched_level (0 if none)."""
    out = fact
    for n, keys in enumerate(levels, 1):
        one = lookup.groupBy(*(F.col(k).alias(f"_k{k}") for k in keys)).agg(F.min(payload).alias(f"_p{n}"), F.max(payload).alias("_m")).where(f"_p{n} = _m").drop("_m")
        out = out.join(one, [out[k] == one[f"_k{k}"] for k in keys], "left").drop(*(f"_k{k}" for k in keys))
    cols = [F.col(f"_p{n}") for n in range(1, len(levels) + 1)]
    level = reduce(lambda acc, n: F.when(cols[n].isNotNull(), n + 1).otherwise(acc), reversed(range(len(cols))), F.lit(0))
    return out.withColumns({payload: F.coalesce(*cols), "matched_level": level}).drop(*(f"_p{n}" for n in range(1, len(levels) + 1)))


def rebase_merge(a: DataFrame, b: DataFrame, id_col: str, multiple: int = 1) -> DataFrame:
    """Union with b's ids moved past a's largest, to a multiple."""
    top = a.agg(F.coalesce(F.max(id_col) + 1, F.lit(0)).alias("_o"))
    offset = (F.ceil(F.col("_o") / multiple) * multiple).cast("bigint")
    moved = b.crossJoin(F.broadcast(top)).withColumn(id_col, F.col(id_col) + offset).drop("_o")
    return a.withColumn("source_index", F.lit(0)).unionByName(moved.withColumn("source_index", F.lit(1)))


def fenced(df: DataFrame, key: str, value: str, factor: float = 1.5, least: int = 8) -> DataFrame:
    """Rows inside [q1 - factor iqr, q3 + factor iqr] of their group; groups under least rows stay whole."""
    fence = grouped_quantiles(df, [key], {"q1": (value, 0.25, "fence"), "q3": (value, 0.75, "fence")}).select(F.col(key).alias("_key"), F.struct("n", "q1", "q3").alias("_fence"))
    fence = fence.withColumnsRenamed({n: fresh(n, df.columns) for n in ("_key", "_fence")})
    k, f = fence.columns
    spread = F.lit(factor) * (F.col(f)["q3"] - F.col(f)["q1"])
    keep = (F.col(f)["n"] < least) | F.col(value).between(F.col(f)["q1"] - spread, F.col(f)["q3"] + spread)
    return df.join(fence, F.col(key).eqNullSafe(F.col(k))).where(keep).select(*df.columns)


def mad_gate(df: DataFrame, key: str, value: str, factor: float = 3.0, floor: float = 0.0) -> DataFrame:
    """Per group: median, MAD, the gate max(floor, median + factor 1.4826 MAD), rows kept and their median.

    The rows are read and counted by (key, value) once; all medians come from these counts. Rows with a
    null key are left out, null values aren't kept.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_m"))
    med = counted_median(counts, "_k", "_v", "_m").select("_k", F.col("median").alias("med"))
    off = counts.join(med, "_k").groupBy("_k", F.abs(F.col("_v") - F.col("med")).alias("_d")).agg(F.sum("_m").alias("_m"))
    mad = counted_median(off, "_k", "_d", "_m").select("_k", F.col("median").alias("mad"))
    gate = med.join(mad, "_k").withColumn("gate", F.greatest(F.lit(floor), F.col("med") + factor * 1.4826 * F.col("mad")))
    kept = counted_median(counts.join(gate, "_k").where(F.col("_v") <= F.col("gate")).select("_k", "_v", "_m"), "_k", "_v", "_m")
    every = counts.select("_k").distinct().join(gate, "_k", "left").join(kept, "_k", "left")
    return every.select(F.col("_k").alias(key), "med", "mad", "gate", F.coalesce("n", F.lit(0)).alias("n_kept"), F.col("median").alias("kept_median"))


def greedy_selection(df: DataFrame, key: str, order: list[str], value: str, gap: float, most: int) -> DataFrame:
    """Per key, in order: a row is selected if its value is at least gap from the last selected one, until most are. Counts of selected, near_duplicate and max_selected rows.

    The state after each row depends on all earlier choices of the key. A key's rows lie sorted in one
    partition, and its state (the last selected value and the counts) passes from batch to batch, so memory
    doesn't grow with the key. A null value is selected and lets any next one follow.
    """
    kept = df.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_o{k}") for k, c in enumerate(order)), F.col(value).cast("double").alias("_value"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last, n, near, full = _NONE, None, 0, 0, 0
        for b in batches:
            done = []
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != now:
                    if now is not _NONE:
                        done.append((now, n, near, full))
                    now, last, n, near, full = k, None, 0, 0, 0
                if n >= most:
                    full += 1
                elif last is not None and v is not None and abs(v - last) < gap:
                    near += 1
                else:
                    last, n = v, n + 1
            if done:
                yield counted(done, b.schema.field(0).type)
            kind = b.schema.field(0).type
        if now is not _NONE:
            yield counted([(now, n, near, full)], kind)

    def counted(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        keys, *counts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(c, pa.int64()) for c in counts)], ["_key", "selected", "near_duplicate", "max_selected"])

    ordered = kept.repartition("_key").sortWithinPartitions("_key", *(f"_o{k}" for k in range(len(order)))).select("_key", "_value")
    out = ordered.mapInArrow(fold, f"_key {df.schema[key].dataType.simpleString()}, selected bigint, near_duplicate bigint, max_selected bigint")
    return out.withColumnRenamed("_key", key)


def gates(df: DataFrame, checks: list[tuple[str, Column, str, float]]) -> DataFrame:
    """Long form (name, value, op, threshold, passed) of one summary row; a null or non-finite value fails."""
    ops = {"<=": lambda v, t: v <= t, ">=": lambda v, t: v >= t, "<": lambda v, t: v < t, ">": lambda v, t: v > t, "==": lambda v, t: v == t}
    rows = F.array(*(F.struct(F.lit(n).alias("name"), v.cast("double").alias("value"), F.lit(op).alias("op"), F.lit(float(t)).alias("threshold"), F.coalesce(~F.isnan(v.cast("double")) & ops[op](v.cast("double"), t), F.lit(False)).alias("passed")) for n, v, op, t in checks))
    return df.select(F.inline(rows))


def component_labels(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of an undirected graph, component the smallest node: label spreading with pointer jumps."""
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).unionByName(edges.select(F.col(b).alias("a"), F.col(a).alias("b"))).distinct()
    spark = edges.sparkSession
    checkpoint_dir(spark)
    both = both.checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")).checkpoint()
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("component").alias("root"))
        after = spread.join(jump, "label", "left").select("node", "old", F.least("label", "root").alias("component")).checkpoint()
        labels = after.select("node", "component")
        if after.where("old <> component").isEmpty():
            return labels


def reachable(edges: DataFrame, starts: DataFrame, node: str = "node", a: str = "a", b: str = "b") -> DataFrame:
    """The nodes that directed edges lead to from the starts, these included; however long the paths are. Each round goes one edge on from the new nodes alone and ends in a checkpoint."""
    checkpoint_dir(edges.sparkSession)
    ways = edges.select(F.col(a).alias("_a"), F.col(b).alias("_b")).distinct().checkpoint()
    seen = new = starts.select(node).distinct().checkpoint()
    while not new.isEmpty():
        new = ways.join(new, F.col("_a") == F.col(node), "left_semi").select(F.col("_b").alias(node)).distinct().join(seen, node, "left_anti").checkpoint()
        seen = seen.unionByName(new).checkpoint()
    return seen


def quantiles_by(df: DataFrame, sets: list[list[str]], value: str, qs: list[float], others: list[Column]) -> DataFrame:
    """Grouping sets with exact linear quantiles (q0, q1, ...) and other aggregates.

    Ranks come from a sort that can spill, so no group is held as an array; the rows next to each
    quantile's place are then picked by ordinary aggregates.
    """
    keys = list(dict.fromkeys(k for g in sets for k in g))
    rows = F.array(*(F.struct(F.lit(n).alias("_set"), *((F.col(k) if k in g else F.lit(None).cast(df.schema[k].dataType)).alias(k) for k in keys)) for n, g in enumerate(sets)))
    long = df.select(F.col(value), F.explode(rows).alias("_g")).select(value, "_g.*")
    w = W.partitionBy("_set", *keys)
    ranked = long.withColumns({"_i": F.row_number().over(w.orderBy(value)) - 1, "_n": F.count(value).over(w)})
    aggs = list(others)
    for k, q in enumerate(qs):
        place = F.lit(q) * (F.col("_n") - 1)
        low = F.floor(place)
        a = F.max(F.when(F.col("_i") == low, F.col(value)))
        b = F.max(F.when(F.col("_i") == F.least(low + 1, F.col("_n") - 1), F.col(value)))
        aggs.append((a + (b - a) * F.max(place - low)).alias(f"q{k}"))
    return ranked.groupBy("_set", *keys).agg(*aggs).drop("_set")
