"""Maximal periodic runs of words by the runs theorem.

The texts of a slab are one sequence of word ranks, each text closed by a mark of its own that is
smaller than every word. A run's Lyndon root is the longest Lyndon word at its first place under
one of the two letter orders, and that word ends where the inverse suffix array next falls (for the
opposite order: next rises). Each such root is extended to both sides by longest common extensions,
which are range minima over LCP arrays of the sequence and of its reverse. So all runs come from
two candidates per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import SPACE_CUT, Words, buffers, joined, slabs, spans
from .cluster import bounded_batches

_BLOCK = 32
OUT = "_id {id}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Suffixes:
    """Suffix array (order), its inverse (rank) and, with deep, the LCP array of a sequence without repeated last letter.

    Prefix doubling: each round sorts only the places whose prefix isn't unique yet. With deep it keeps
    the ranks of every round, from which the common prefix of neighbours follows exactly; that takes
    four bytes a letter and round.
    """

    def __init__(self, letters: np.ndarray, deep: bool = False):
        n, width = len(letters), np.int32 if len(letters) < 2**31 else np.int64
        order = np.argsort(letters, kind="stable")
        fresh = np.ones(n, bool)
        fresh[1:] = letters[order[1:]] != letters[order[:-1]]
        rank = np.empty(n, width)
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        apart = np.where(fresh, 0, -1).astype(np.int8)  # round in which a suffix and the one before it differed
        rounds, step = [rank.copy()] if deep else [], 1
        same = np.concatenate((~fresh[1:], [False])) | ~fresh
        places, act = np.flatnonzero(same), order[same]
        while len(act):
            key = rank[act].astype(np.int64) * n + rank[act + step]
            by = np.argsort(key, kind="stable")
            act, key = act[by], key[by]
            order[places] = act
            old, at = key // n, np.arange(len(act))
            new_key, new_old = np.ones(len(act), bool), np.ones(len(act), bool)
            new_key[1:], new_old[1:] = key[1:] != key[:-1], old[1:] != old[:-1]
            rank[act] = old + np.maximum.accumulate(np.where(new_key, at, 0)) - np.maximum.accumulate(np.where(new_old, at, 0))
            if deep:
                rounds.append(rank.copy())
                apart[places[new_key & ~new_old]] = len(rounds) - 1
            same = np.concatenate((~new_key[1:], [False])) | ~new_key
            places, act, step = places[same], act[same], 2 * step
        self.order, self.rank = order, rank
        if deep:
            self._lcp(rounds, apart)

    def _lcp(self, rounds: list[np.ndarray], apart: np.ndarray) -> None:
        """lcp[k]: common prefix of the suffixes of ranks k - 1 and k. A pair apart in round r > 0 shares 2**(r-1) letters and less than 2**r."""
        shared = np.zeros(len(apart), np.int64)
        for r in range(len(rounds) - 1, 0, -1):
            first = apart == r
            shared[first] = 1 << (r - 1)
            on = np.flatnonzero((apart > r) & (apart > 0))
            if len(on):
                a, b = self.order[on] + shared[on], self.order[on - 1] + shared[on]
                on = on[rounds[r - 1][a] == rounds[r - 1][b]]
                shared[on] += 1 << (r - 1)
        self.lcp = shared

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b (a != b): a minimum of lcp between their ranks, by a sparse table built one level at a time."""
        low, high = np.minimum(self.rank[a], self.rank[b]).astype(np.int64) + 1, np.maximum(self.rank[a], self.rank[b]).astype(np.int64)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out, table = np.zeros(len(a), np.int64), self.lcp
        by = np.argsort(level, kind="stable")
        edges = np.searchsorted(level[by], np.arange(int(level.max(initial=-1)) + 2))
        for k in range(len(edges) - 1):
            q = by[edges[k] : edges[k + 1]]
            out[q] = np.minimum(table[low[q]], table[high[q] - (1 << k) + 1])
            if k + 2 < len(edges):
                table = np.minimum(table[: -(1 << k)], table[1 << k :])
        return out


def next_smaller(values: np.ndarray, where: np.ndarray) -> np.ndarray:
    """For each place in where the next place with a smaller value; there is one for each. Steps over _BLOCK places, then by a sparse table of block minima, then within the block."""
    n = len(values)
    out = np.full(n, n, np.int64)
    left = _scan(values, where, where + 1, out)
    if len(left):
        blocks = -(-n // _BLOCK)
        low = np.full(blocks * _BLOCK, np.iinfo(values.dtype).max, values.dtype)
        low[:n] = values
        table = [low.reshape(blocks, _BLOCK).min(1)]
        while 2 << (len(table) - 1) <= blocks:
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        at = left // _BLOCK + 1
        for k in range(len(table) - 1, -1, -1):
            inside = at + (1 << k) <= blocks
            at[inside] += (table[k][at[inside]] > values[left[inside]]).astype(np.int64) << k
        _scan(values, left, at * _BLOCK, out)
    return out[where]


def _scan(values: np.ndarray, act: np.ndarray, at: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Look at _BLOCK places from at on; those still without an answer."""
    last = len(values) - 1
    for d in range(_BLOCK):
        if not len(act):
            break
        j = np.minimum(at + d, last)
        hit = values[j] < values[act]
        out[act[hit]] = j[hit]
        act, at = act[~hit], at[~hit]
    return act


def runs_of(letters: np.ndarray, first: np.ndarray, min_exponent: int = 4, min_length: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start, length and period of each run of at least min_exponent (2 or more) periods and min_length letters.

    letters[first[d] : first[d + 1]] is row d. A run's leftmost Lyndon root begins within its first
    period, so the letters at whole periods from it are equal min_exponent times: other candidates are
    not extended.
    """
    row, at, period = _roots(letters, first, min_exponent)
    if not len(row):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    # the rows that have candidates, once more, with common extensions to both sides
    rows, row = np.unique(row, return_inverse=True)
    counts = np.diff(first)[rows]
    inner = np.concatenate(([0], np.cumsum(counts)))
    take = np.arange(inner[-1]) + np.repeat(first[rows] - inner[:-1], counts)
    text, ends = closed(letters[take], inner)
    a = at - first[rows][row] + inner[row] + row
    right = Suffixes(text, deep=True).common(a, a + period)
    # reversed, a row's closing mark must follow it again
    back = np.concatenate(([0], np.cumsum(counts[::-1])))
    turned, _ = closed(letters[take][::-1], back)
    mirror = ends[-1] - 1 - (a - 1)  # where the letter before a stands in the reverse, if rows kept their marks after them
    head = a == inner[row] + row
    left = np.zeros(len(a), np.int64)
    if (~head).any():
        x = mirror[~head] - 1
        left[~head] = Suffixes(turned, deep=True).common(x, x - period[~head])
    start, length = a - left, left + period + right
    keep = length >= np.maximum(min_length, min_exponent * period)
    found = np.unique(np.stack((row, start - inner[row] - row, period, length))[:, keep], axis=1)
    return rows[found[0]], found[1], found[3], found[2]


def closed(letters: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows one after the other, each followed by a mark smaller than all letters and all different; and the places after each mark."""
    n = len(first) - 1
    out = np.empty(len(letters) + n, np.int64)
    ends = first[1:] + np.arange(1, n + 1)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside], out[ends - 1] = letters + n, np.arange(n)
    return out, ends


def _roots(letters: np.ndarray, first: np.ndarray, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in letters and length of the longest Lyndon words, under both orders, that are repeated min_exponent times by their first letter."""
    text, ends = closed(letters, first)
    if not len(letters):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    rank = Suffixes(text).rank
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    where = np.flatnonzero(inside)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    close = ends[row] - 1
    found = []
    for values in (rank, np.where(inside, len(text) - rank, -1)):
        period = next_smaller(values, where) - where
        good = np.flatnonzero(where + (min_exponent - 1) * period < close)
        for k in range(1, min_exponent):
            good = good[text[where[good]] == text[where[good] + k * period[good]]]
        found.append((row[good], where[good] - row[good], period[good]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _ranks(words: Words) -> np.ndarray:
    return np.unique(words.hashes(), return_inverse=True)[1].astype(np.int64)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_exponent: int = 4, min_length: int = 6) -> DataFrame:
    """One row per row of docs: the id, n_words, runs (start, length, period by start, then period) and collapsed, the words that stay if each run keeps its first period only.

    A word is a run of anything but the six ASCII white-space characters; words are numbered from 0.
    A run is a stretch of words with smallest period p and at least min_exponent * p and min_length
    words that can't be extended keeping p. A word is dropped if any run has it after its first p
    words; the others are joined by one space. A null, empty or wordless text has no words, no runs and an
    empty collapsed; a null id is kept; repeated rows are each a row; other columns are ignored. No row
    leaves its partition. Memory grows with the longest text, by some 200 bytes a word. Words are
    equal if their 64-bit fingerprints are.
    """
    bounded_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, offsets = buffers(part.column(1))
            for i, j in slabs(offsets):
                words = spans(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SPACE_CUT)
                row, start, length, period = runs_of(_ranks(words), words.first, min_exponent, min_length)
                cover = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(cover, words.first[row] + start + period, 1)
                np.add.at(cover, words.first[row] + start + length, -1)
                runs = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row, np.arange(j - i + 1)), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"]),
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(i, j - i), pa.array(np.diff(words.first), pa.int64()), runs, pa.array(joined(words, np.cumsum(cover[:-1]) == 0), pa.string())],
                    ["_id", "n_words", "runs", "collapsed"],
                )

    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(batches, OUT.format(id=id_type))
    return out.withColumnRenamed("_id", id_col)


def with_periodic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the text, whose tail becomes periodic where crc32 of the decimal id is divisible by ten.

    With h that number, g = floor(h / 10) and n words, each word i >= a = g % n becomes word
    a + (i - a) % p for p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and those of null ids, stay.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def rewritten(words):
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        put = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
        return F.when(n > 0, F.array_join(put, " ")).otherwise("")

    words = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # the words are bound once, as an element of an array of one, so that they aren't cut anew for each word
    planted = F.element_at(F.transform(F.array(words), rewritten), 1)
    return docs.select(F.col(id_col), F.when(F.coalesce(h % 10 == 0, F.lit(False)), planted).otherwise(F.col(text_col)).alias(text_col))
