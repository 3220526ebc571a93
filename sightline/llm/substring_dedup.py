"""Substring dedup: words covered by a window of words that also starts anywhere else are removed.

Method: a count-min prefilter, then exact grouping of the windows it estimates as repeated.

1. Texts are dealt once into groups of a few MB (exchange "texts"; later steps reuse it).
2. Each group sketches its windows: for each of DEPTH hash rows the occupied counters, saturated
   at two. The sketch is as wide as the corpus needs, so it is split by counter range into shards;
   a shard adds up the sketches of all groups and answers each group with one bit per counter:
   does the merged count reach two? Count-min never underestimates, so no repeated window is lost.
3. Windows whose every counter reached two are asked again, now by their 128-bit fingerprints.
4. Each group maps the answers back to its windows and drops the covered words.

A group sends one row per shard whatever its texts repeat, so a passage that a third of all rows
share costs one counter per group. Nothing is collected by the driver or broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.functions.ship import ship

from .arrays import SPACE_CUT, U64, buffers, mix, slabs, span_hash, spans, windows
from .cluster import text_size

DEPTH = 2
#: Counters of a sketch row for each window of the corpus.
WIDTH_FACTOR = 3
#: Characters of a group of texts; counters, and fingerprints, of a shard.
GROUP_CHARS, SHARD_COUNTERS, SHARD_PRINTS = 2_500_000, 1 << 21, 1 << 19
GROUPS_PER_PARTITION = 2
#: Slots of the table in which a group looks up its counters.
MARKS = 1 << 23
ASK = "shard int, kind int, grp int, cells binary"


def _packed(values: np.ndarray) -> bytes:
    """Sorted integers as zstd-compressed byte planes of their differences."""
    steps = np.diff(values, prepend=values[:1] * 0).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64))


def _capped(ordered: np.ndarray) -> np.ndarray:
    """A sorted array with at most two copies of each value."""
    keep = np.ones(len(ordered), bool)
    keep[2:] = ordered[2:] != ordered[:-2]
    return ordered[keep]


class Group:
    """The texts of one group in a fixed order, and their windows' fingerprints."""

    def __init__(self, texts: pa.Table, size: int):
        self.column = texts.column("_text")
        data, offsets = buffers(self.column)
        self.parts, high, low = [], [], []
        for i, j in slabs(offsets):
            cut = spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SPACE_CUT)
            start, _ = windows(cut.first, size)
            first, second = cut.both()
            high.append(span_hash(first, start, start + size, 1))
            low.append(span_hash(second, start, start + size, 2))
            self.parts.append((cut, start))
        self.high = np.concatenate([*high, np.zeros(0, U64)])
        self.low = np.concatenate([*low, np.zeros(0, U64)])

    def counters(self, width: int) -> list[np.ndarray]:
        return [(mix(self.high, 11 + r) % U64(width)).astype(np.int64) + r * width for r in range(DEPTH)]


def _runs(shard: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values in a sorted array."""
    edges = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    return list(zip(edges, [*edges[1:], len(shard)], strict=True)) if edges else []


def _flags(shard: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """The answers' bits for values sorted by shard."""
    said = [np.unpackbits(np.frombuffer(answers[int(shard[a])], np.uint8), count=b - a) for a, b in _runs(shard)]
    return np.concatenate([*said, np.zeros(0, np.uint8)]).astype(bool)


def _ask_counters(group: Group, width: int) -> Iterator[tuple[int, bytes]]:
    """Shard and occupied counters of the group's sketch."""
    cells = _capped(np.sort(np.concatenate(group.counters(width))))
    shard = cells // SHARD_COUNTERS
    for a, b in _runs(shard):
        yield int(shard[a]), _packed(cells[a:b] - shard[a] * SHARD_COUNTERS)


def _estimated(group: Group, width: int, answers: dict[int, bytes]) -> np.ndarray:
    """Which windows the merged sketch counts at least twice, and a few more: the test is a table of MARKS slots."""
    rows = group.counters(width)
    known = np.sort(np.concatenate(rows))
    known = known[np.diff(known, prepend=-1) != 0]
    marks = np.zeros(MARKS, bool)
    marks[known[_flags(known // SHARD_COUNTERS, answers)] % MARKS] = True
    seen = np.ones(len(group.high), bool)
    for cells in rows:
        seen &= marks[cells % MARKS]
    return seen


PRINT = np.dtype([("high", "<u8"), ("low", "<u8")])


def _distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the fingerprints, and where a new one starts in it."""
    order = np.argsort(high)
    same = high[order][1:] == high[order][:-1]
    if (same & (low[order][1:] != low[order][:-1])).any():  # equal first halves
        order = np.lexsort((low, high))
        same = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
    return order, np.concatenate((np.ones(min(1, len(order)), bool), ~same))


def _ask_prints(group: Group, chosen: np.ndarray, shards: int) -> Iterator[tuple[int, bytes]]:
    """Shard, and the chosen windows' distinct fingerprints with a bit for those that the group itself repeats."""
    high, low = group.high[chosen], group.low[chosen]
    order, new = _distinct(high, low)
    again = np.diff(np.flatnonzero(np.append(new, True))) > 1
    prints = np.empty(len(again), PRINT)
    prints["high"], prints["low"] = high[order][new], low[order][new]
    for a, b in _runs(_print_shard(prints["high"], shards)):
        yield int(_print_shard(prints["high"][a : a + 1], shards)[0]), prints[a:b].tobytes() + np.packbits(again[a:b]).tobytes() + int(b - a).to_bytes(4, "little")


def _print_shard(high: np.ndarray, shards: int) -> np.ndarray:
    """Ascending with the fingerprint."""
    return (high // U64(-(-(2**64) // shards) if shards > 1 else 2**64 - 1)).astype(np.int64).clip(max=shards - 1)


def _repeated(group: Group, chosen: np.ndarray, shards: int, answers: dict[int, bytes]) -> np.ndarray:
    """Which windows start twice or more in the corpus, exactly."""
    out, at = np.zeros(len(chosen), bool), np.flatnonzero(chosen)
    order, new = _distinct(group.high[at], group.low[at])
    said = _flags(_print_shard(group.high[at][order][new], shards), answers)
    out[at[order]] = said[np.cumsum(new) - 1]
    return out


def _merge_counters(table: pa.Table) -> list[bytes]:
    total, asked = np.zeros(SHARD_COUNTERS, np.uint8), []
    for x in table.column("cells"):
        cells = _unpacked(x.as_py())
        again = np.diff(cells, prepend=-1) == 0
        asked.append(cells[~again])
        total[asked[-1]] = np.minimum(total[asked[-1]] + 1, 2)
        total[cells[again]] = 2
    return [np.packbits(total[cells] >= 2).tobytes() for cells in asked]


def _merge_prints(table: pa.Table) -> list[bytes]:
    prints, counts = [], []
    for x in table.column("cells"):
        raw = x.as_py()
        n = int.from_bytes(raw[-4:], "little")
        prints.append(np.frombuffer(raw, PRINT, n))
        counts.append(np.unpackbits(np.frombuffer(raw[16 * n : -4], np.uint8), count=n) + 1)
    every, n = np.concatenate(prints), np.concatenate(counts)
    order, new = _distinct(every["high"], every["low"])
    key = np.empty(len(every), np.int64)
    key[order] = np.cumsum(new) - 1
    twice = np.bincount(key, weights=n) >= 2 if len(every) else np.zeros(0, bool)
    edges = np.cumsum([0, *map(len, prints)])
    return [np.packbits(twice[key[a:b]]).tobytes() for a, b in zip(edges, edges[1:], strict=False)]


def _answers(asked: DataFrame, merge: Callable[[pa.Table], list[bytes]], parts: int) -> DataFrame:
    """One row for each row asked: what its shard says, dealt by group."""

    def answer(table: pa.Table) -> pa.Table:
        return table.set_column(3, "cells", pa.array(merge(table), pa.binary()))

    return asked.groupBy("shard", "kind").applyInArrow(answer, ASK).select("grp", "shard", "kind", "cells").repartition(parts, "grp")


def _rows(group: int, kind: int, asked: Iterator[tuple[int, bytes]]) -> pa.Table:
    asked = list(asked)
    return pa.table({"shard": pa.array([s for s, _ in asked], pa.int32()), "kind": pa.array([kind] * len(asked), pa.int32()), "grp": pa.array([group] * len(asked), pa.int32()), "cells": pa.array([c for _, c in asked], pa.binary())})


def _said(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {s: c for s, k, c in zip(*(table.column(x).to_pylist() for x in ("shard", "kind", "cells")), strict=True) if k == kind}


def _kept(group: Group, repeated: np.ndarray, size: int) -> tuple[list[int], list[int], list[str]]:
    n_words, n_removed, kept, at = [], [], [], 0
    for cut, start in group.parts:
        mine = start[repeated[at : at + len(start)]]
        at += len(start)
        cover = np.zeros(len(cut.start) + 1, np.int64)
        np.add.at(cover, mine, 1)
        np.add.at(cover, mine + size, -1)
        stay = np.cumsum(cover[:-1]) == 0
        total = np.concatenate(([0], np.cumsum(stay)))
        n_words += np.diff(cut.first).tolist()
        n_removed += (np.diff(cut.first) - np.diff(total[cut.first])).tolist()
        # each kept word and one space after it, in one buffer; the rows are cut from it
        begin, length = cut.start[stay], (cut.end - cut.start)[stay]
        put = np.concatenate(([0], np.cumsum(length + 1)))
        out = np.full(int(put[-1]), 0x20, np.uint8)
        spread = np.repeat(begin - put[:-1], length)
        where = np.arange(int(length.sum())) + np.repeat(np.arange(len(length)), length)
        out[where] = cut.data[where + spread]
        text = out.tobytes()
        edge = put[total[cut.first]]
        kept += [text[a : max(a, b - 1)].decode() for a, b in zip(edge, edge[1:], strict=False)]
    return n_words, n_removed, kept


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 35) -> DataFrame:
    """One row per row of docs: the id, n_words, n_removed and kept (the remaining words joined by one space).

    A word is a run of anything but the six ASCII white-space characters. A window is size
    consecutive words of one row; it counts as repeated if the same words start at any other
    place, in the same row or another. A null or empty text has no words and an empty kept; a row
    may repeat as a whole (each copy counts); a null id is kept as null; other columns are ignored.
    Equality of windows is equality of 128-bit fingerprints, whose halves come from two independent
    fingerprints of each word.
    """
    ship(docs.sparkSession)
    chars = text_size(docs, text_col)
    groups = max(8, -(-chars // GROUP_CHARS))
    parts = -(-groups // GROUPS_PER_PARTITION)
    n_windows = max(1, chars // 6)
    width = max(SHARD_COUNTERS // 64, WIDTH_FACTOR * n_windows)
    shards = max(1, -(-n_windows // SHARD_PRINTS))
    id_type = docs.schema[id_col].dataType
    dealt = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
        .withColumn("grp", F.pmod(F.xxhash64("_id", "_text"), F.lit(groups)).cast("int"))
        .repartition(parts, "grp")
    )

    def sketch(texts: pa.Table) -> pa.Table:
        return _rows(texts.column("grp")[0].as_py(), 0, _ask_counters(Group(texts, size), width))

    def survivors(texts: pa.Table, said: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _rows(0, 1, iter(()))
        group = Group(texts, size)
        return _rows(texts.column("grp")[0].as_py(), 1, _ask_prints(group, _estimated(group, width, _said(said, 0)), shards))

    def finish(texts: pa.Table, said: pa.Table) -> pa.Table:
        group = Group(texts, size)
        chosen = _estimated(group, width, _said(said, 0)) if len(group.high) else np.zeros(0, bool)
        n_words, n_removed, kept = _kept(group, _repeated(group, chosen, shards, _said(said, 1)), size)
        return pa.table({"_id": texts.column("_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    counted = _answers(dealt.groupBy("grp").applyInArrow(sketch, ASK), _merge_counters, parts)
    asked = dealt.groupBy("grp").cogroup(counted.groupBy("grp")).applyInArrow(survivors, ASK)
    exact = _answers(asked, _merge_prints, parts)
    out = dealt.groupBy("grp").cogroup(counted.unionByName(exact).groupBy("grp")).applyInArrow(finish, f"_id {id_type.simpleString()}, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("_id", id_col)
