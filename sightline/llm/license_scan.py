"""License scans: which license notices a text holds.

Method: texts are cut into blocks of a quarter of a template's n shingles of five words. Each block
and template has REGISTERS min-hashes, and each is a band of its own; a block that shares a band
makes the whole text a candidate for the template; an index of each band's sorted values finds the
templates, however many there are. A text that holds at least 0.8 of a template,
in one stretch or with other words between its parts, has it in blocks whose Jaccard similarities
with the template add up to 0.8 / 1.25 = 0.64 or more, and a band is shared with a probability of
that sum, so one of them is with 1 - 0.36 ** 24 (less than 1e-10 is missed). The exact share of
the template's distinct shingles in the whole text then decides. Words are runs of letters and
digits in lower case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM, U64, buffers, lowered, slabs, span_hash, spans, windows
from .cluster import bounded_batches

SHINGLE, CONTAINMENT, REGISTERS = 5, 0.8, 24
#: Slots that tell which values may be in a band.
MARKS = 1 << 16

# Wording of public license notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-text": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-3-text": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "LGPL-text": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


def _shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = spans(data, offsets, ALNUM)
    start, row = windows(words.first, SHINGLE)
    return span_hash(words.hashes(), start, start + SHINGLE, 1), start - words.first[:-1][row], np.searchsorted(row, np.arange(len(offsets)))


def _register(hashes: np.ndarray, r: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = hashes * U64((0x9E3779B97F4A7C15 * (2 * r + 1)) % 2**64)
        x ^= x >> U64(29)
        return x * U64(0xBF58476D1CE4E5B9)


class Templates:
    def __init__(self, texts: dict[str, str]):
        names, data, offsets = list(texts), *buffers(lowered(pa.array(list(texts.values()), pa.string())))
        hashes, _, first = _shingles(data, offsets)
        self.by_size: dict[int, list[tuple[str, np.ndarray]]] = {}
        for name, a, b in zip(names, first, first[1:], strict=False):
            if b > a:
                self.by_size.setdefault(int(b - a), []).append((name, np.unique(hashes[a:b])))
        # the index: for each block size and register the templates' minima in order, and whose they are
        self.index: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        self.known = [(name, h) for group in self.by_size.values() for name, h in group]
        steps = np.array([max(1, n // 4) for n, group in self.by_size.items() for _ in group], np.int64)
        for step in np.unique(steps).tolist():
            mine = np.flatnonzero(steps == step)
            bands = [np.array([_register(self.known[k][1], r).min() for k in mine], U64) for r in range(REGISTERS)]
            self.index[step] = []
            for band in bands:
                order, marks = np.argsort(band), np.zeros(MARKS, bool)
                marks[band & U64(MARKS - 1)] = True
                self.index[step].append((marks, band[order], mine[order]))

    def search(self, data: np.ndarray, offsets: np.ndarray, least: float) -> dict[tuple[int, str], tuple[float, int]]:
        """(row, template) -> containment in the whole row and the first word of the shortest stretch that has all of it."""
        hashes, word, first = _shingles(data, offsets)
        if not len(hashes):
            return {}
        counts = np.diff(first)
        blocks = {}
        for step in self.index:
            per_row = -(-counts // step)
            row = np.repeat(np.arange(len(counts)), per_row)
            blocks[step] = (first[:-1][row] + step * (np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)), row)
        candidates = set()
        for r in range(REGISTERS):
            value = _register(hashes, r)
            for step, (start, row) in blocks.items():
                marks, band, whose = self.index[step][r]
                low = value if step == 1 else np.minimum.reduceat(value, start)
                maybe = np.flatnonzero(marks[low & U64(MARKS - 1)])
                begin, end = (np.searchsorted(band, low[maybe], side) for side in ("left", "right"))
                for a, b, w in zip(begin.tolist(), end.tolist(), row[maybe].tolist(), strict=True):
                    candidates.update((w, k) for k in whose[a:b].tolist())
        found: dict[tuple[int, str], tuple[float, int]] = {}
        for w, k in sorted(candidates):
            name, template = self.known[k]
            held = hashes[first[w] : first[w + 1]]
            which = np.minimum(np.searchsorted(template, held), len(template) - 1)
            at = np.flatnonzero(template[which] == held)
            which = which[at]
            share = float(len(np.unique(which)) / len(template))
            if share >= least:
                found[w, name] = (share, int(word[first[w] + _shortest(at, which)]))
        return found


def _shortest(at: np.ndarray, which: np.ndarray) -> int:
    """Where the shortest stretch of the rising positions at starts that has every kind in which; the first of equal ones."""
    at, which = at.tolist(), which.tolist()
    missing, inside = len(set(which)), {}
    best, begin, i = at[-1] - at[0] + 1, at[0], 0
    for p, k in zip(at, which, strict=True):
        inside[k] = inside.get(k, 0) + 1
        missing -= inside[k] == 1
        while inside[which[i]] > 1:
            inside[which[i]] -= 1
            i += 1
        if not missing and p - at[i] < best:
            best, begin = p - at[i], at[i]
    return begin


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, least: float = CONTAINMENT) -> DataFrame:
    """One row per row of docs and template that it holds: id, license, containment (share of the template's shingles) and start_word.

    The share is that of the whole text, so other words may stand between a notice's parts.
    start_word (from 0) is where the shortest stretch that holds all of those shingles starts, the
    first of equal ones. Texts that are null or have under five words match nothing; repeated rows each get their rows; other columns
    are ignored. Templates are a fixed, small set.
    """
    bounded_batches(docs.sparkSession)
    known = Templates(templates or TEMPLATES)

    def run(batches):
        for batch in batches:
            data, offsets = buffers(lowered(batch.column("_text")))
            rows, names, shares, words = [], [], [], []
            for i, j in slabs(offsets):
                for (row, name), (share, w) in sorted(known.search(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], least).items()):
                    rows.append(i + row)
                    names.append(name)
                    shares.append(share)
                    words.append(w)
            yield pa.RecordBatch.from_arrays([batch.column("_id").take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), pa.array(shares, pa.float64()), pa.array(words, pa.int64())], ["_id", "license", "containment", "start_word"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return texts.mapInArrow(run, f"_id {docs.schema[id_col].dataType.simpleString()}, license string, containment double, start_word long").withColumnRenamed("_id", id_col)
