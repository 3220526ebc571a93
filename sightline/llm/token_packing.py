"""Token sequences of fixed length by first-fit decreasing, with a tournament tree of bin capacities.

Texts become token ids where they are read. Pieces of up to one sequence are dealt to randomised
groups, and each group is packed by itself: pieces by falling length, each into the first bin with
room, found by descending a tree whose nodes hold the larger capacity of their children. What the
rule leaves open at the end of the bins is filled by cutting the emptiest bins' pieces, and a
group's last bin is cut at powers of two, so that no sequence needs padding.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import buffers, byte_hashes, slabs
from .cluster import bounded_batches

#: Characters and rows that a group has on average; they bound the memory of its one task.
GROUP_CHARS = 4_000_000
GROUP_ROWS = 16_384
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = _PRINTED & ~_LETTER
_MARK[[*range(0x30, 0x3A)]] = False
_OPENS = _MARK.copy()
_OPENS[0x27] = False  # an apostrophe may belong to the letter after it
_known: dict[str, object] = {}
_memories: dict[str, Memory] = {}


def tokenizer(path: str):
    """The tokenizer of a vocabulary file, once per process; strings of special tokens are ordinary text."""
    if path not in _known:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        _known[path] = Tokenizer.from_file(path)
        _known[path].encode_special_tokens = True
    return _known[path]


def encoded(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all rows of UTF-8 data, one after the other, and each row's bounds among them.

    The file's splitting pattern never joins what these cuts part, all between ASCII characters: before
    a space or line feed that is alone between printed ones, after such a line feed, between a
    letter and a mark, and between a mark other than an apostrophe and a letter. So the segments
    encode as in the whole text, and equal segments are encoded once while a process remembers them.
    """
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if len(data) > 2:
        printed, letter = _PRINTED[data], _LETTER[data]
        alone = printed[:-2] & printed[2:]
        feed = alone & (data[1:-1] == 0x0A)
        edge[1:-2] |= feed | (alone & (data[1:-1] == 0x20))
        edge[2:-1] |= feed
        edge[1:-1] |= (letter[:-1] & _MARK[data[1:]]) | (_OPENS[data[:-1]] & letter[1:])
    bound = np.flatnonzero(edge)
    start, end = bound[:-1], bound[1:]
    if not len(start):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    one, two = byte_hashes(data, start, end, (3, 4))
    _, first, which = np.unique(one, return_index=True, return_inverse=True)
    if (two != two[first][which]).any():  # two segments of one fingerprint
        first = which = np.arange(len(start))
    flat, begin, size = _remembered(path, data, start[first], end[first], one[first], two[first])
    count = size[which]
    put = np.concatenate(([0], np.cumsum(count)))
    out = flat[np.arange(put[-1]) + np.repeat(begin[which] - put[:-1], count)]
    return out, put[np.searchsorted(bound, offsets)]


class Memory:
    """Ids of segments seen before by this process, by their 128-bit fingerprint: a table in which a new segment takes the old one's slot, emptied when its ids fill up."""

    slots, most = 1 << 21, 1 << 23

    def __init__(self):
        self.one, self.two = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.uint64)
        self.begin, self.size = np.zeros(self.slots, np.int32), np.full(self.slots, -1, np.int32)
        self.flat, self.used = np.zeros(self.most, np.uint32), 0

    def get(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which are known, and where their ids begin and how many they are."""
        slot = (one & np.uint64(self.slots - 1)).astype(np.int64)
        known = (self.one[slot] == one) & (self.two[slot] == two) & (self.size[slot] >= 0)
        return known, self.begin[slot].astype(np.int64), self.size[slot].astype(np.int64)

    def put(self, one: np.ndarray, two: np.ndarray, flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        if self.used + len(flat) > self.most:
            self.size[:], self.used = -1, 0
            if len(flat) > self.most:
                return
        slot = (one & np.uint64(self.slots - 1)).astype(np.int64)
        slot, last = np.unique(slot, return_index=True)
        self.one[slot], self.two[slot] = one[last], two[last]
        self.begin[slot], self.size[slot] = begin[last] + self.used, size[last]
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)


def _remembered(path: str, data: np.ndarray, start: np.ndarray, end: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As _each, but segments that the process remembers are not encoded again."""
    memory = _memories.setdefault(path, Memory())
    known, begin, size = memory.get(one, two)
    new = np.flatnonzero(~known)
    old = memory.flat[: memory.used].copy()
    if not len(new):
        return old, begin, size
    flat, at, n = _each(path, data, start[new], end[new])
    begin[new], size[new] = at + len(old), n
    memory.put(one[new], two[new], flat, at, n)
    return np.concatenate((old, flat)), begin, size


def _each(path: str, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of the segments one after the other, and where each begins and how many it has.

    A segment of one word or mark stays itself between two line feeds, so such ones are encoded many at
    a time, as lines of a text whose line feeds, one id each, part their ids again.
    """
    feeds = np.concatenate(([0], np.cumsum(data == 0x0A)))
    second = data[np.minimum(start + 1, len(data) - 1)]
    plain = _PRINTED[data[end - 1]] & (_PRINTED[data[start]] | ((data[start] == 0x20) & _PRINTED[second] & (end - start > 1))) & (feeds[start] == feeds[end])
    feed = tokenizer(path).encode("\n", add_special_tokens=False).ids
    line = np.flatnonzero(plain)
    length = (end - start)[line]
    put = np.concatenate(([0], np.cumsum(length + 1)))
    text = np.full(int(put[-1]), 0x0A, np.uint8)
    source = np.arange(int(length.sum())) + np.repeat(start[line] - (np.cumsum(length) - length), length)
    text[np.arange(len(source)) + np.repeat(np.arange(len(line)), length)] = data[source]
    text = text.tobytes()
    cuts = [*put[np.unique(np.searchsorted(put, np.arange(0, len(text), 1 << 16)))].tolist(), len(text)]
    flat = _ids(path, [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if b > a])
    at = np.flatnonzero(flat == feed[0]) if len(feed) == 1 else np.zeros(0, np.int64)
    if len(at) != len(line):  # a vocabulary without such line feeds: each by itself
        line, flat, at = line[:0], flat[:0], np.zeros(0, np.int64)
    begin, size = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    begin[line] = np.concatenate(([0], at[:-1] + 1))[: len(at)]
    size[line] = at - begin[line]
    rest = np.ones(len(start), bool)
    rest[line] = False
    rest = np.flatnonzero(rest)
    ids = [tokenizer(path).encode_batch_fast([data[a:b].tobytes().decode(errors="replace")], add_special_tokens=False)[0].ids for a, b in zip(start[rest], end[rest], strict=True)]
    size[rest] = [len(x) for x in ids]
    begin[rest] = len(flat) + np.cumsum(size[rest]) - size[rest]
    return np.concatenate((flat, np.array([t for x in ids for t in x], np.uint32))), begin, size


def _ids(path: str, texts: list[bytes]) -> np.ndarray:
    found = tokenizer(path).encode_batch_fast([t.decode(errors="replace") for t in texts], add_special_tokens=False)
    return np.concatenate([np.array(e.ids, np.uint32) for e in found]) if found else np.zeros(0, np.uint32)


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each length: the first one with room. A tournament tree over the bins' capacities finds it in log n steps."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    out = []
    for n in lengths:
        k = 1
        while k < leaves:
            k *= 2
            if room[k] < n:
                k += 1
        out.append(k - leaves)
        room[k] -= n
        while k > 1:
            k //= 2
            a, b = room[2 * k], room[2 * k + 1]
            larger = a if a > b else b
            if room[k] == larger:
                break
            room[k] = larger
    return out


def _padded(n: int, capacity: int) -> bool:
    return n != capacity and n & (n - 1) != 0


def filled(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """The bins of (piece, from, to) without any that need padding: the fuller ones take what they lack from the emptiest, the last is cut at powers of two."""
    size = [sum(b - a for _, a, b in x) for x in bins]
    open_ = sorted((k for k in range(len(bins)) if _padded(size[k], capacity)), key=lambda k: (-size[k], k))
    i, j = 0, len(open_) - 1
    while i < j:
        to, lack = bins[open_[i]], capacity - size[open_[i]]
        giver = bins[open_[j]]
        piece, a, b = giver.pop()
        if b - a > lack:
            giver.append((piece, a + lack, b))
            b = a + lack
        to.append((piece, a, b))
        size[open_[i]] += b - a
        size[open_[j]] -= b - a
        i += size[open_[i]] == capacity
        j -= not giver
    out = [x for x in bins if x]
    if i == j and _padded(size[open_[i]], capacity):
        last, rest = out.pop(out.index(bins[open_[i]])), size[open_[i]]
        while rest:
            part = 1 << (rest.bit_length() - 1)
            rest -= part
            out.append([])
            while part:
                piece, a, b = last.pop(0)
                if b - a > part:
                    last.insert(0, (piece, a + part, b))
                    b = a + part
                out[-1].append((piece, a, b))
                part -= b - a
    return out


def pack_group(lengths: np.ndarray, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, from, to) for pieces sorted by falling length."""
    whole = int(np.searchsorted(-lengths, -capacity, "right"))
    bins = [[(k, 0, capacity)] for k in range(whole)]
    where = first_fit(lengths[whole:].tolist(), capacity)
    bins += [[] for _ in range(max(where, default=-1) + 1)]
    for k, at in enumerate(where, whole):
        bins[whole + at].append((k, 0, int(lengths[k])))
    return filled(bins, capacity)


def pack_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1, seed: int = 17, group_chars: int = GROUP_CHARS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """One row per piece: the id, start (its document's ids before it), length, doc_tokens, sequence_id, offset and ids (unsigned 32-bit, little-endian).

    vocabulary is the path of a tokenizer file that all executors have. A document's ids are those of its whole
    text and end_id. Every id is in one piece; a sequence is gapless, holds at most capacity (a power
    of two) ids, and fewer only if they are a power of two. A null or empty text is the one id
    end_id; a null id is kept; repeated rows are each a document; other columns are ignored; no rows give no
    rows. Groups are drawn by row, so copies spread; docs must come in the same order when read again,
    as tables do. A text in memory takes some 40 bytes a character.
    """
    bounded_batches(docs.sparkSession)
    chars, rows = docs.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)), F.count(F.lit(1))).first()
    n = max(chars // group_chars, rows // group_rows) + 1
    id_type = docs.schema[id_col].dataType.simpleString()

    def pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype("<u2" if tokenizer(vocabulary).get_vocab_size() <= 1 << 16 else "<u4")
        for part in parts:
            data, offsets = buffers(part.column(1))
            for i, j in slabs(offsets, 1 << 21):
                ids, bound = encoded(vocabulary, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                total = np.diff(bound) + 1
                ends = np.cumsum(total)
                flat = np.full(int(ends[-1]), end_id, width)
                inside = np.ones(len(flat), bool)
                inside[ends - 1] = False
                flat[inside] = ids
                count = -(-total // capacity)
                row = np.repeat(np.arange(j - i), count)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                length = np.minimum(total[row] - nth * capacity, capacity)
                cuts = np.concatenate(([0], np.cumsum(length))) * width.itemsize
                binary = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())
                grp = (np.asarray(part.column(2).slice(i, j - i))[row] + nth * 7919) % n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grp, pa.int32()), part.column(0).take(pa.array(row + i)), pa.array(nth * capacity, pa.int64()), pa.array(length, pa.int32()), pa.array(total[row], pa.int64()), binary],
                    ["grp", "_id", "start", "length", "doc_tokens", "ids"],
                )

    def packed(table: pa.Table) -> pa.Table:
        width = np.dtype("<u2" if tokenizer(vocabulary).get_vocab_size() <= 1 << 16 else "<u4")
        table = table.take(pc.sort_indices(table, sort_keys=[("length", "descending"), ("_id", "ascending"), ("start", "ascending")])).combine_chunks()
        bins = pack_group(np.asarray(table.column("length")), capacity)
        piece, begin, end = (np.array([x[k] for b in bins for x in b], np.int64) for k in range(3))
        size = np.array([len(b) for b in bins])
        length = end - begin
        seq = np.repeat(np.arange(len(bins)), size)
        before = np.cumsum(length) - length
        raw, bounds = buffers(table.column("ids"))
        flat = raw.view(width)
        put = np.concatenate(([0], np.cumsum(length)))
        ids = flat[np.arange(put[-1]) + np.repeat(bounds[piece] // width.itemsize + begin - put[:-1], length)].astype("<u4")
        at = pa.array(piece)
        return pa.table({
            "_id": table.column("_id").take(at),
            "start": pa.array(np.asarray(table.column("start"))[piece] + begin, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "doc_tokens": table.column("doc_tokens").take(at),
            "sequence_id": pa.array((table.column("grp")[0].as_py() << 32) + seq, pa.int64()),
            "offset": pa.array(before - before[np.cumsum(size) - size][seq], pa.int64()),
            "ids": pa.Array.from_buffers(pa.large_binary(), len(piece), [None, pa.py_buffer(put * 4), pa.py_buffer(ids)]).cast(pa.binary()),
        })

    dealt = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), F.floor(F.rand(seed) * n).cast("int").alias("grp")).mapInArrow(
        pieces, f"grp int, _id {id_type}, start long, length int, doc_tokens long, ids binary"
    )
    out = dealt.groupBy("grp").applyInArrow(packed, f"_id {id_type}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return out.withColumnRenamed("_id", id_col)
