"""Counts per line of a batch of texts, shared by the rule statistics and the line classifier."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .arrays import SPACE_CUT, Words, byte_hashes, code_points, spans


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SYMBOLS = _table(b"#*$%&|<>")
MARKS = _table(b"!?#*$%&|<>=+~^@_/\\[]{}")
UPPER = _table(bytes(range(65, 91)))
DIGITS = _table(b"0123456789")


@dataclass
class Lines:
    """Lines of a slab (cut at line feeds): byte bounds, the row of each, its words, and per-row bounds."""

    words: Words
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray
    first_word: np.ndarray


def lines_of(data: np.ndarray, offsets: np.ndarray) -> Lines:
    """Every row has one line more than it has line feeds; an empty row has one empty line."""
    feeds = np.flatnonzero(data == 0x0A)
    feed_row = np.searchsorted(offsets, feeds, "right") - 1
    n = len(offsets) - 1
    per_row = np.bincount(feed_row, minlength=n) + 1
    first = np.concatenate(([0], np.cumsum(per_row)))
    start, end = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    opens = np.ones(first[-1], bool)
    opens[first[:-1]] = False
    start[first[:-1]], start[opens] = offsets[:-1], feeds + 1
    closes = np.ones(first[-1], bool)
    closes[first[1:] - 1] = False
    end[first[1:] - 1], end[closes] = offsets[1:], feeds
    words = spans(data, offsets, SPACE_CUT)
    return Lines(words, start, end, np.repeat(np.arange(n), per_row), first, np.append(np.searchsorted(words.start, start), len(words.start)))


def sums(mask: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[end] - total[start]


def earlier_equal(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which entries equal an earlier one of the same row."""
    order = np.lexsort((key, row))
    same = np.zeros(len(key), bool)
    same[order[1:]] = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    return same


def repeated(key: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which entries equal another one of the same row."""
    order = np.lexsort((key, row))
    same = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    out = np.zeros(len(key), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def line_hashes(lines: Lines) -> np.ndarray:
    return byte_hashes(lines.words.data, lines.start, lines.end, (2,))[0]


def word_chars(words: Words) -> np.ndarray:
    """Code points of each word."""
    return sums(code_points(words.data), words.start, words.end)
