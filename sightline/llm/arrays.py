"""Vectorised text primitives: whole Arrow batches of UTF-8 as numpy arrays.

A batch of texts is one byte buffer plus row offsets. Words, windows and their 64-bit
fingerprints come from sums over that buffer, so no Python code runs per word. A word's or line's
fingerprint adds a random number for each (place, byte), so no two words are equal by construction;
a window's is a polynomial of its words' fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = {0: 0x9E3779B97F4A7C15, 1: 0xD1342543DE82EF95, 2: 0xAF251AF3B0F025B5}
_powers: dict[tuple[int, bool], np.ndarray] = {}
_PLACES = 64
_places: dict[int, np.ndarray] = {}

#: Bytes that belong to words cut at the six ASCII white-space characters.
SPACE_CUT = np.ones(256, bool)
SPACE_CUT[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes that belong to words of letters and digits; every non-ASCII byte counts as a letter.
ALNUM = np.zeros(256, bool)
ALNUM[0x80:] = True
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    ALNUM[_c] = True


def powers(n: int, base: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or their inverses."""
    have = _powers.get((base, inverse))
    if have is None or len(have) < n:
        step = _BASE[base] if not inverse else pow(_BASE[base], -1, 2**64)
        with np.errstate(over="ignore"):
            have = np.full(max(n, 1 << 16), U64(step))
            have[0] = 1
            have = np.multiply.accumulate(have)
        _powers[base, inverse] = have
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


def span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of the fingerprints values[start:end] for each pair, independent of where the span lies."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * powers(len(values), base), out=sums[1:])
        out = (sums[end] - sums[start]) * powers(len(values) + 1, base, inverse=True)[start]
        out += (end - start).astype(U64) * U64(0xC2B2AE3D27D4EB4F)
    return mix(out)


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seeds: tuple[int, ...]) -> list[np.ndarray]:
    """For each seed a fingerprint of the bytes data[start:end] of each span; spans don't overlap. Seeds give independent ones."""
    for seed in seeds:
        if seed not in _places:
            _places[seed] = mix(np.arange(_PLACES * 256, dtype=U64), 100 + seed)
    length = end - start
    begin = np.cumsum(length) - length
    n, some = int(length.sum()), length > 0
    out = [np.zeros(len(start), U64) for _ in seeds]
    if n:
        place = np.arange(n, dtype=np.int32 if len(data) < 2**31 else np.int64)
        byte = data[place + np.repeat((start - begin).astype(place.dtype), length)]
        place -= np.repeat(begin.astype(place.dtype), length)
        far = np.flatnonzero(place >= _PLACES) if length.max() > _PLACES else None
        cell = (place & (_PLACES - 1)).astype(np.uint16) << np.uint16(8) | byte
        for k, seed in enumerate(seeds):
            value = _places[seed].take(cell)
            if far is not None:
                value[far] *= mix((place[far] // _PLACES).astype(U64), 200 + seed) | U64(1)
            out[k][some] = np.add.reduceat(value, begin[some])
    with np.errstate(over="ignore"):
        return [mix(x + length.astype(U64) * U64(0xC2B2AE3D27D4EB4F), seed) for x, seed in zip(out, seeds, strict=True)]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and the n+1 row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slabs(offsets: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of about limit bytes each; a longer row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


@dataclass
class Words:
    """start, end: byte spans; first[d]:first[d+1] are the words of row d; doc: each word's row."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    _known: dict[int, np.ndarray] = field(default_factory=dict)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A fingerprint of each word."""
        return self._both((seed,))[0]

    def both(self) -> list[np.ndarray]:
        """Two independent fingerprints of each word."""
        return self._both((0, 1))

    def _both(self, seeds: tuple[int, ...]) -> list[np.ndarray]:
        new = tuple(k for k in seeds if k not in self._known)
        if new:
            self._known |= dict(zip(new, byte_hashes(self.data, self.start, self.end, new), strict=True))
        return [self._known[k] for k in seeds]

    def keys(self) -> np.ndarray:
        """A 128-bit fingerprint of each row's word sequence, as two columns, each from word fingerprints of its own."""
        out = np.zeros((len(self.first) - 1, 2), U64)
        some = np.diff(self.first) > 0
        place = (np.arange(len(self.start)) - np.repeat(self.first[:-1], np.diff(self.first))).astype(U64)
        for k, word in enumerate(self.both()):
            if some.any():
                out[some, k] = np.add.reduceat(mix(word ^ place * U64(_BASE[k]), 60 + k), self.first[:-1][some])
        return mix(out, 70)


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """Maximal runs of the table's bytes; a run never crosses a row."""
    inside = table[data]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    after[edges[edges > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start index and row of each run of size consecutive words of one row."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][row] + at, row


def shingles(words: Words, size: int, base: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and row of every size-word shingle; a row of 1 to size-1 words is one shingle of all its words."""
    start, row = windows(words.first, size)
    end = start + size
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        start, end, row = (np.concatenate(x) for x in ((start, words.first[:-1][short]), (end, words.first[1:][short]), (row, short)))
        order = np.argsort(row, kind="stable")
        start, end, row = start[order], end[order], row[order]
    return span_hash(words.hashes(), start, end, base), row


def lowered(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The texts in lower case (Unicode rules), null kept."""
    import pyarrow.compute as pc

    return pc.utf8_lower(column)


def code_points(data: np.ndarray) -> np.ndarray:
    """Where a code point starts."""
    return (data & 0xC0) != 0x80


def joined(words: Words, stay: np.ndarray) -> list[str]:
    """Each row's words that stay, joined by one space."""
    # each word and one space after it, in one buffer; the rows are cut from it
    begin, length = words.start[stay], (words.end - words.start)[stay]
    put = np.concatenate(([0], np.cumsum(length + 1)))
    out = np.full(int(put[-1]), 0x20, np.uint8)
    source = np.arange(int(length.sum())) + np.repeat(begin - (np.cumsum(length) - length), length)
    out[np.arange(len(source)) + np.repeat(np.arange(len(length)), length)] = words.data[source]
    text = out.tobytes()
    edge = put[np.concatenate(([0], np.cumsum(stay)))[words.first]]
    return [text[a : max(a, b - 1)].decode() for a, b in zip(edge, edge[1:], strict=False)]
