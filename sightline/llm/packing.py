"""Best-fit packing of texts into bins of fixed capacity, under conflicts.

A bin never holds two texts of one source, nor two of one duplicate cluster. Texts longer than a
bin are cut into full pieces, each a bin of its own, and a remainder. Pieces are dealt by hash into
shards of about SHARD_PIECES and each shard is packed by itself, so a bin never spans shards and a
hot source or cluster spreads evenly.

In a shard, pieces come by falling length. Bins stand in order of their residual capacity and carry
a bitmap of their sources and one of their clusters. The search starts at the tightest bin that has
room and goes on to its successors until one is free of conflicts; only then is a new bin opened.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM, SPACE_CUT, buffers, lowered, slabs, spans
from .cluster import bounded_batches, cut
from .near_dedup import counted_classes, text_keys

CAPACITY, SHARD_PIECES = 2048, 4000
_STEP = 512


class Bins:
    """Open bins: bitmaps of the slots that hold a source or cluster, and the slots' order by residual capacity."""

    def __init__(self, sources: int, clusters: int):
        self.source, self.cluster = np.zeros((sources, 64), bool), np.zeros((clusters, 64), bool)
        self.residual, self.slot, self.open, self.n = np.zeros(64, np.int64), np.zeros(64, np.int64), 0, 0

    def place(self, size: int, source: int, cluster: int, capacity: int) -> int:
        """The slot that takes the piece; -1 for a source or cluster means none."""
        residual, slots, free = self.residual, self.slot, None
        for k in range(int(residual[: self.open].searchsorted(size)), self.open, _STEP):
            there = slots[k : min(k + _STEP, self.open)]
            taken = self.source[source].take(there) if source >= 0 else None
            if cluster >= 0:
                held = self.cluster[cluster].take(there)
                taken = held if taken is None else taken | held
            first = 0 if taken is None else int(taken.argmin())
            if taken is None or not taken[first]:
                free = k + first
                break
        if free is None:
            slot, left, end = self.n, capacity - size, self.open
            self.n += 1
            if self.n > self.source.shape[1]:
                self.source, self.cluster = (np.concatenate([x, np.zeros_like(x)], axis=1) for x in (self.source, self.cluster))
            if self.open == len(residual):
                self.residual, self.slot = residual, slots = np.concatenate([residual, residual]), np.concatenate([slots, slots])
            self.open += 1
        else:
            slot, left, end = int(slots[free]), int(residual[free]) - size, free
        if source >= 0:
            self.source[source, slot] = True
        if cluster >= 0:
            self.cluster[cluster, slot] = True
        if left > 0 or size == 0:  # those with less room than the place that falls vacant are tighter than it
            put = int(residual[:end].searchsorted(left))
            residual[put + 1 : end + 1], slots[put + 1 : end + 1] = residual[put:end], slots[put:end]
            residual[put], slots[put] = left, slot
        else:
            self.open -= 1
            residual[end : self.open], slots[end : self.open] = residual[end + 1 : self.open + 1], slots[end + 1 : self.open + 1]
        return slot


def _codes(values: list) -> tuple[np.ndarray, int]:
    """A number for each value that several have, -1 for null and for a value of its own, which conflicts with none."""
    several = [v for v, n in Counter(values).items() if n > 1 and v is not None]
    known = {v: k for k, v in enumerate(several)}
    return np.array([known.get(v, -1) for v in values], np.int64), len(known)


def pack_shard(size: list[int], source: list, cluster: list, capacity: int) -> list[int]:
    """A bin number for each piece, in the order given (longest first)."""
    s, n_s = _codes(source)
    c, n_c = _codes(cluster)
    bins = Bins(n_s, n_c)
    return [bins.place(int(z), int(a), int(b), capacity) for z, a, b in zip(size, s, c, strict=True)]


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source, cluster (near_dedup's key of the text; null without words) and n_words of every row."""

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column("_text"))
            words = [np.diff(spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SPACE_CUT).first) for i, j in slabs(offsets)]
            data, offsets = buffers(lowered(batch.column("_text")))
            keys = [text_keys(spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ALNUM)) for i, j in slabs(offsets)]
            cluster = pa.array(np.concatenate([*keys, np.zeros(0, object)]), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_source"), cluster, pa.array(np.concatenate([*words, np.zeros(0, np.int64)]))], ["_id", "_source", "cluster", "n_words"])

    id_type, source_type = (docs.schema[c].dataType.simpleString() for c in (id_col, source_col))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"_id {id_type}, _source {source_type}, cluster binary, n_words long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", capacity: int = CAPACITY, near: bool = False) -> DataFrame:
    """One row per piece: bin_id, id, piece (from 0), start_word, n_words.

    Every word of every text is in exactly one piece, and a bin's pieces have at most capacity
    words. Words are cut at ASCII white space. A null, empty or wordless text is one piece of 0
    words; a null source conflicts with nothing; texts of equal words are one duplicate cluster
    (wordless ones are in none), with near all texts of one near-duplicate class are; repeated rows are copies of each other; ties in length go by id;
    other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    measured = counted_classes(docs, id_col, text_col, source_col).withColumnRenamed("_0", "_source") if near else _measured(docs, id_col, text_col, source_col)
    measured = cut(measured)
    last = F.greatest(F.lit(0), F.ceil(F.col("n_words") / capacity) - 1).cast("int")
    pieces = measured.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    pieces = pieces.withColumn("start_word", F.col("piece").cast("long") * capacity)
    pieces = pieces.withColumn("size", F.least(F.col("n_words") - F.col("start_word"), F.lit(capacity).cast("long")))
    n_pieces = measured.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("n_words") / capacity)))).first()[0] or 0
    shards = max(1, -(-int(n_pieces) // SHARD_PIECES))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("_id", "piece", "cluster"), F.lit(shards)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("_id", "ascending"), ("piece", "ascending"), ("_source", "ascending"), ("cluster", "ascending")])
        at = pack_shard(*(table.column(c).to_pylist() for c in ("size", "_source", "cluster")), capacity)
        shard = table.column("shard")[0].as_py()
        return pa.table({"bin_id": pa.array([f"{shard}-{k}" for k in at], pa.string()), "_id": table.column("_id"), "piece": table.column("piece"), "start_word": table.column("start_word"), "n_words": table.column("size")})

    out = dealt.select("shard", "_id", "_source", "cluster", "piece", "start_word", "size").groupBy("shard").applyInArrow(run, f"bin_id string, _id {docs.schema[id_col].dataType.simpleString()}, piece int, start_word long, n_words long")
    return out.withColumnRenamed("_id", id_col)
