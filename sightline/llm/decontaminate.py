"""Benchmark decontamination: passages of a text that repeat a benchmark item.

Method: texts are cut into windows as long as the items, and each window gets a SimHash of BITS
bits of its five-word shingles (every occurrence votes once). The items' SimHashes stand in a
multi-index of BLOCKS blocks, which lists for each block value the items that differ from it in at
most NEAR bits. Of two fingerprints within RADIUS bits, at most RADIUS // (NEAR + 1) blocks differ
in more, so the other AGREE blocks list the item: whoever is listed so often is a candidate, and no
item within the radius is missed. A random item is listed in 4.6 of 32 blocks, deviation 2.0, and
so is a candidate with a probability of 0.002. At a similarity of 0.8 a fingerprint differs by 39
bits on average (deviation 5.7); RADIUS is that plus four deviations. The exact weighted Jaccard
similarity of the shingle multisets decides.

Items of one to four words are one shingle of all their words and are looked up among the runs of
as many words, which are equal (similarity 1) or not.

Windows without any shingle of an item of their length have similarity 0 to all such items, so
only the others are fingerprinted. Words are runs of letters and digits in lower case. Items are
the stated query set: they are taken in blocks of about BLOCK_ITEMS, one pass over the texts each.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM, U64, Words, buffers, lowered, mix, slabs, span_hash, spans, windows
from .cluster import bounded_batches

SHINGLE, SIMILARITY = 5, 0.8
BITS, RADIUS, NEAR = 256, 62, 2
BLOCKS = BITS // 8
AGREE = BLOCKS - RADIUS // (NEAR + 1)
BLOCK_ITEMS = 4096
MARKS = 1 << 20
#: Windows whose fingerprints are held at once.
CHUNK = 2048

_BYTE = np.arange(256, dtype=np.uint8)
_NEAR = np.flatnonzero(np.unpackbits(_BYTE[:, None], axis=1).sum(1) <= NEAR).astype(np.uint8)


def _shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, first word and row bounds of the full shingles."""
    start, row = windows(words.first, size)
    return span_hash(words.hashes(), start, start + size, 1), start - words.first[:-1][row], np.searchsorted(row, np.arange(len(words.first)))


def _votes(hashes: np.ndarray) -> np.ndarray:
    """BITS bits of each shingle, as a running total."""
    bits = np.unpackbits(np.column_stack([mix(hashes, 3 + k) for k in range(BITS // 64)]).view(np.uint8), axis=1)
    total = np.zeros((len(bits) + 1, BITS), np.int32)
    np.cumsum(bits, axis=0, out=total[1:], dtype=np.int32)
    return total


def _simhash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """BLOCKS bytes each: the bits that more than half of the shingles set."""
    return np.packbits(2 * (total[end] - total[start]) > (end - start)[:, None], axis=1)


def _window_prints(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHashes of windows in order of their start; only shingles in some window vote."""
    low = start[0]
    cover = np.zeros(int(end.max() - low) + 1, np.int32)
    np.add.at(cover, start - low, 1)
    np.add.at(cover, end - low, -1)
    inside = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
    return _simhash(_votes(hashes[low + inside]), np.searchsorted(inside, start - low), np.searchsorted(inside, end - 1 - low) + 1)


def _listed(index: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Bitmaps of the items that at least AGREE blocks list, for each fingerprint: the blocks' bitmaps are added up bit by bit."""
    sums = [np.zeros((len(prints), index.shape[2]), U64) for _ in range(BLOCKS.bit_length())]
    for b in range(BLOCKS):
        carry = index[b, prints[:, b]]
        for k, x in enumerate(sums):
            sums[k], carry = x ^ carry, x & carry
    more, equal = np.zeros_like(sums[0]), ~np.zeros_like(sums[0])
    for k in reversed(range(len(sums))):
        if AGREE >> k & 1:
            equal &= sums[k]
        else:
            more |= equal & sums[k]
            equal &= ~sums[k]
    return more | equal


class Items:
    """A block of benchmark items, with a multi-index for each item length."""

    def __init__(self, rows: list[tuple]):
        self.rows = [r for r in rows if r[1]]
        words = spans(*buffers(lowered(pa.array([r[1] for r in self.rows], pa.string()))), ALNUM)
        hashes, _, first = _shingles(words)
        size = np.diff(first)
        # number of words -> fingerprint -> the items that are this one shingle
        self.short: dict[int, dict[int, list[int]]] = {}
        n_words = np.diff(words.first)
        for k in np.flatnonzero((n_words > 0) & (n_words < SHINGLE)).tolist():
            whole = span_hash(words.hashes(), words.first[k : k + 1], words.first[k + 1 : k + 2], 1)
            self.short.setdefault(int(n_words[k]), {}).setdefault(int(whole[0]), []).append(k)
        print_ = _simhash(_votes(hashes), first[:-1], first[1:])
        self.ids = [r[0] for r in self.rows]
        self.counts = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(first, first[1:], strict=False)]
        self.sizes = sorted({int(n) for n in size if n})
        self.known = np.unique(hashes)
        self.marks = np.zeros(MARKS, bool)
        self.marks[self.known & U64(MARKS - 1)] = True
        self.of_size, self.index, self.print, sizes_of = {}, {}, {}, defaultdict(set)
        for n in self.sizes:
            mine = np.flatnonzero(size == n)
            table = np.zeros((BLOCKS, 256, -(-len(mine) // 64)), U64)
            for k, item in enumerate(mine):
                for b in range(BLOCKS):
                    table[b, print_[item, b] ^ _NEAR, k // 64] |= U64(1 << (k % 64))
                for h in self.counts[item][0]:
                    sizes_of[int(h)].add(n)
            self.of_size[n], self.index[n], self.print[n] = mine, table, print_[mine]
        self.sizes_of = [sizes_of[int(h)] for h in self.known]

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of two shingle multisets."""
        known, n = self.counts[item]
        mine, m = np.unique(window, return_counts=True)
        at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
        both = np.where(known[at] == mine, np.minimum(n[at], m), 0).sum()
        return float(both / (n.sum() + m.sum() - both))

    def search(self, data: np.ndarray, offsets: np.ndarray, least: float) -> dict[tuple[int, int], tuple[float, int]]:
        """(row, item) -> best similarity and the first word of the first window that has it."""
        words = spans(data, offsets, ALNUM)
        return self._search_short(words) | self._search_long(words, least)

    def _search_short(self, words: Words) -> dict[tuple[int, int], tuple[float, int]]:
        found: dict[tuple[int, int], tuple[float, int]] = {}
        for n, items in self.short.items():
            hashes, word, first = _shingles(words, n)
            at = np.flatnonzero(np.isin(hashes, np.array(list(items), U64)))
            row = np.searchsorted(first, at, "right") - 1
            for k, w in zip(at.tolist(), row.tolist(), strict=True):
                for item in items[int(hashes[k])]:
                    found.setdefault((w, item), (1.0, int(word[k])))
        return found

    def _search_long(self, words: Words, least: float) -> dict[tuple[int, int], tuple[float, int]]:
        if not len(self.known):
            return {}
        hashes, word, first = _shingles(words)
        near = np.flatnonzero(self.marks[hashes & U64(MARKS - 1)])
        at = np.minimum(np.searchsorted(self.known, hashes[near]), len(self.known) - 1)
        near, at = near[self.known[at] == hashes[near]], at[self.known[at] == hashes[near]]
        if not len(near):
            return {}
        row = np.searchsorted(first, near, "right") - 1
        begins, ends = first[row], first[row + 1]
        by_size = defaultdict(list)
        for k, a in enumerate(at.tolist()):
            for n in self.sizes_of[a]:
                by_size[n].append(k)
        found: dict[tuple[int, int], tuple[float, int]] = {}
        for n, chosen in sorted(by_size.items()):
            k = np.array(chosen)
            opens = np.zeros(len(hashes) + 1, np.int32)
            low = np.maximum(near[k] - n + 1, begins[k])
            high = np.maximum(np.minimum(near[k], ends[k] - n), begins[k])  # a row shorter than the item is one window
            np.add.at(opens, low, 1)
            np.add.at(opens, high + 1, -1)
            start = np.flatnonzero(np.cumsum(opens[:-1]) > 0)
            w_row = np.searchsorted(first, start, "right") - 1
            end = np.minimum(start + n, first[w_row + 1])
            fit = end - start >= least * n
            start, end, w_row = start[fit], end[fit], w_row[fit]
            for c in range(0, len(start), CHUNK):
                s, e, r = start[c : c + CHUNK], end[c : c + CHUNK], w_row[c : c + CHUNK]
                print_ = _window_prints(hashes, s, e)
                # candidates as (window, item of this length) pairs, then the full distance
                window, item = np.nonzero(np.unpackbits(_listed(self.index[n], print_).view(np.uint8), axis=1, bitorder="little")[:, : len(self.of_size[n])])
                apart = np.unpackbits(print_[window] ^ self.print[n][item], axis=1).sum(1)
                for w, i in zip(window[apart <= RADIUS].tolist(), self.of_size[n][item[apart <= RADIUS]].tolist(), strict=True):
                    alike = self.similarity(hashes[s[w] : e[w]], i)
                    key = (int(r[w]), i)
                    if alike >= least and alike > found.get(key, (0.0, 0))[0]:
                        found[key] = (alike, int(word[s[w]]))
        return found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[Items]:
    items = benchmark.select(F.col(item_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    n = -(-items.count() // BLOCK_ITEMS)
    part = F.pmod(F.xxhash64("_id", "_text"), F.lit(max(1, n)))
    return [Items(sorted(map(tuple, items.where(part == k).collect()), key=lambda r: (r[0] is None, r[0], r[1] or ""))) for k in range(n)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per row of docs and item that a window of it repeats: id, item id, similarity and start_word (from 0).

    similarity is that of the best window, start_word the first such window's first word. An item
    of one to four words matches where all its words follow each other. Texts and items that are
    null or wordless match nothing; repeated rows and items each
    get their rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    id_type, item_type = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = f"_id {id_type.simpleString()}, _item {item_type.simpleString()}, similarity double, start_word long"

    def passes(block: Items):
        def run(batches):
            for batch in batches:
                data, offsets = buffers(lowered(batch.column("_text")))
                rows, items, alike, words = [], [], [], []
                for i, j in slabs(offsets):
                    for (row, item), (s, w) in sorted(block.search(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], least).items()):
                        rows.append(i + row)
                        items.append(block.ids[item])
                        alike.append(s)
                        words.append(w)
                ids = batch.column("_id").take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_pydict({"_id": ids, "_item": pa.array(items, item_arrow), "similarity": pa.array(alike, pa.float64()), "start_word": pa.array(words, pa.int64())})

        return run

    from pyspark.sql.pandas.types import to_arrow_type

    item_arrow = to_arrow_type(item_type)
    out = None
    for block in _blocks(benchmark, item_col, item_text_col):
        found = texts.mapInArrow(passes(block), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"_id": id_col, "_item": item_col})


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of docs in which no window repeats an item, with all their columns."""

    def passes(block: Items):
        def run(batches):
            for batch in batches:
                data, offsets = buffers(lowered(batch.column(text_col)))
                clean = np.ones(batch.num_rows, bool)
                for i, j in slabs(offsets):
                    clean[[i + row for row, _ in block.search(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], least)]] = False
                yield batch.filter(pa.array(clean))

        return run

    bounded_batches(docs.sparkSession)
    for block in _blocks(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(passes(block), docs.schema)
    return docs
