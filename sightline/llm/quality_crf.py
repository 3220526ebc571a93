"""Quality classifier: a linear-chain conditional random field labels every line of a text good or bad.

A line's features are counts of its characters and words and those of the lines before and after
it. Forward-backward gives each line's marginal probability of being good; their mean, weighted by
line length, is the evidence for the document, and a logistic step fitted on the same sample turns
it into a score.

Training uses a bounded sample of labelled rows (SAMPLE rows, a parameter). Labels are of documents,
those of lines are latent: at first each line bears its document's label; then, EM times, the
expected line labels and neighbour pairs given the document's label (which shifts each line's
log-odds by FACTOR, no more) become the targets. So a good document may hold bad lines and the
other way round, and the transitions learn how long good and bad stretches are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linestats as ls
from .arrays import buffers, slabs
from .cluster import bounded_batches

SAMPLE, ROUNDS, L2 = 3000, 120, 1e-3
EM, FACTOR = 3, 1.5


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, weight (characters) and first line of each row, for the lines that have a word."""
    lines = ls.lines_of(data, offsets)
    words, hashes = lines.words, lines.words.hashes()
    chars = ls.word_chars(words)
    wsum = lambda mask: ls.sums(mask, lines.first_word[:-1], lines.first_word[1:])
    n = wsum(np.ones(len(hashes), bool))
    size = wsum(chars)
    keep = np.flatnonzero(n > 0)
    n1, size1 = np.maximum(n, 1), np.maximum(size, 1)
    raw = lambda table: ls.sums(table[data], lines.start, lines.end)
    same = lambda k: np.concatenate((np.zeros(min(k, len(hashes)), bool), hashes[k:] == hashes[:-k]))
    near = same(1) | same(2) | same(3)
    upper = ls.sums(ls.UPPER[data], words.start, words.end)
    word_line = np.repeat(np.arange(len(n)), n)
    own = np.column_stack(
        [
            np.log1p(n) / 3,
            np.minimum(size / n1, 20) / 8,
            np.sqrt(np.minimum(raw(ls.MARKS) / size1, 1)),
            np.sqrt(np.minimum(raw(ls.SYMBOLS) / size1, 1)),
            np.sqrt(raw(ls.DIGITS) / size1),
            raw(ls.UPPER) / size1,
            wsum((upper * 2 > chars) & (chars > 1)) / n1,
            wsum(chars <= 1) / n1,
            wsum(near) / n1,
            wsum(ls.repeated(hashes, word_line)) / n1 if len(hashes) else n * 0.0,
            raw(_ENDS) / n1,
        ]
    )[keep]
    row = lines.row[keep]
    first = np.searchsorted(row, np.arange(len(offsets)))
    hash_line = ls.line_hashes(lines)[keep]
    own = np.column_stack([own, ls.earlier_equal(hash_line, row)])
    before, after = np.zeros_like(own), np.zeros_like(own)
    joined = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
    before[1:][joined], after[:-1][joined] = own[:-1][joined], own[1:][joined]
    count = np.diff(first)[row]
    alone = np.column_stack([np.ones(len(row)), count == 1, np.log1p(count) / 4])
    return np.column_stack([own, own**2, before, after, alone]), size[keep].astype(float), first


_ENDS = ls._table(b".!?")


def _slab_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and first line of each row, made slab by slab and kept once."""
    parts, counts = [], [np.zeros(1, np.int64)]
    for i, j in slabs(offsets):
        x, _, first = line_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        parts.append(x)
        counts.append(np.diff(first))
    first = np.cumsum(np.concatenate(counts))
    out = np.empty((first[-1], parts[0].shape[1] if parts else 0))
    at = len(out)
    while parts:
        x = parts.pop()
        out[at - len(x) : at] = x
        at -= len(x)
    return out, first


def _chains(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with lines, longest first, and their lengths."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    return order, length[order]


def forward_backward(node: np.ndarray, trans: np.ndarray, first: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of each line, and the pair marginals of each two neighbours summed with the later line's weight.

    node: log potentials (lines, 2); trans: (2, 2). Chains run side by side, longest first, so
    each step handles the chains that are still running.
    """
    rows, length = _chains(first)
    begin = first[:-1][rows]
    steps = int(length[0]) if len(rows) else 0
    alpha, beta = np.zeros_like(node), np.zeros_like(node)
    alive = [int(np.searchsorted(-length, -t, "left")) for t in range(steps)]
    lse = lambda a, b: np.maximum(a, b) + np.log1p(np.exp(-np.abs(a - b)))
    for t in range(steps):
        at = begin[: alive[t]] + t
        if t == 0:
            alpha[at] = node[at]
        else:
            a = alpha[at - 1]
            alpha[at] = node[at] + np.column_stack([lse(a[:, 0] + trans[0, y], a[:, 1] + trans[1, y]) for y in (0, 1)])
    for t in range(steps - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        b = beta[at + 1] + node[at + 1]
        beta[at] = np.column_stack([lse(b[:, 0] + trans[y, 0], b[:, 1] + trans[y, 1]) for y in (0, 1)])
    ends = begin + length - 1
    z = lse(alpha[ends, 0], alpha[ends, 1]) if len(rows) else np.zeros(0)
    z_line = np.zeros(len(node))
    order = np.repeat(begin, length) + np.arange(len(node)) - np.repeat(np.cumsum(length) - length, length)
    z_line[order] = np.repeat(z, length)
    marginal = np.exp(np.minimum(alpha + beta - z_line[:, None], 0))
    pairs = np.zeros((2, 2))
    if weight is not None:
        later = np.setdiff1d(np.arange(len(node)), begin, assume_unique=True)
        for a in (0, 1):
            for b in (0, 1):
                p = alpha[later - 1, a] + trans[a, b] + node[later, b] + beta[later, b] - z_line[later]
                pairs[a, b] = (np.exp(np.minimum(p, 0)) * weight[later]).sum()
    return marginal, pairs


@dataclass
class Crf:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    trans: np.ndarray
    slope: float = 1.0
    bias: float = 0.0
    empty: float = 0.5

    def evidence(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Length-weighted mean marginal of each row (NaN without words), and each line's marginal with its row."""
        x, size, first = line_features(data, offsets)
        score = (x - self.mean) / self.scale @ self.weight
        marginal = forward_backward(np.column_stack([np.zeros(len(score)), score]), self.trans, first)[0][:, 1]
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        total = np.bincount(row, weights=size, minlength=len(first) - 1)
        good = np.bincount(row, weights=size * marginal, minlength=len(first) - 1)
        return np.where(total > 0, good / np.maximum(total, 1), np.nan), marginal, row

    def means(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The first of evidence(), slab by slab."""
        got = [self.evidence(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])[0] for i, j in slabs(offsets)]
        return np.concatenate([*got, np.zeros(0)])

    def score(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        mean = self.means(*buffers(column))
        return np.where(np.isnan(mean), self.empty, 1 / (1 + np.exp(-(self.slope * np.nan_to_num(mean) + self.bias))))


def _ascend(model: Crf, z: np.ndarray, first: np.ndarray, weight: np.ndarray, target: np.ndarray, pairs: np.ndarray, rounds: int) -> None:
    """Gradient ascent (Adam) on the expected likelihood of the lines' targets and neighbour pairs."""
    state = [np.zeros(z.shape[1] + 4), np.zeros(z.shape[1] + 4)]
    for step in range(1, rounds + 1):
        marginal, hoped = forward_backward(np.column_stack([np.zeros(len(z)), z @ model.weight]), model.trans, first, weight)
        g = z.T @ (weight * (target - marginal[:, 1])) - L2 * model.weight
        grad = np.concatenate([g, (pairs - hoped - L2 * model.trans).ravel()])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        model.weight = model.weight + move[:-4]
        model.trans = model.trans + move[-4:].reshape(2, 2)


def train(texts: list[str], good: np.ndarray, rounds: int = ROUNDS) -> Crf:
    """The chains with latent line labels, both document labels weighing alike; then the logistic step."""
    data, offsets = buffers(pa.array(texts, pa.string()))
    z, first = _slab_features(data, offsets)
    mean = np.array([c.mean() for c in z.T]) if len(z) else np.zeros(z.shape[1])
    scale = np.array([max(c.std(), 1e-6) for c in z.T]) if len(z) else np.ones(z.shape[1])
    mean[-3], scale[-3] = 0, 1  # the constant
    z -= mean
    z /= scale
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    y = good[row].astype(int)
    later = np.arange(len(row)) > first[:-1][row]
    share = {v: max(1, int((good == v).sum())) for v in (False, True)}
    weight = (np.where(good, 0.5 / share[True], 0.5 / share[False]) / np.maximum(np.diff(first), 1))[row]
    model = Crf(mean, scale, np.zeros(z.shape[1]), np.zeros((2, 2)))
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[later], y[later]), weight[later])
    _ascend(model, z, first, weight, y, seen, rounds)
    shift = FACTOR * (2 * y - 1)
    for _ in range(EM):
        hoped, seen = forward_backward(np.column_stack([np.zeros(len(z)), z @ model.weight + shift]), model.trans, first, weight)
        _ascend(model, z, first, weight, hoped[:, 1], seen, max(1, rounds // 4))
    del z
    seen_mean = model.means(data, offsets)
    full = ~np.isnan(seen_mean)
    t, target = seen_mean[full], good[full].astype(float)
    if target.any() and not target.all():
        # labels weigh alike; a score of 0.7 then stands where a label-1 row is clearly likelier
        w = np.where(target > 0, 0.5 / target.sum(), 0.5 / (1 - target).sum())
        a, b = 1.0, 0.0
        for _ in range(300):
            p = 1 / (1 + np.exp(-(a * (t - 0.5) + b)))
            h = w * p * (1 - p)
            da, db = (w * (target - p) * (t - 0.5)).sum() - 1e-4 * a, (w * (target - p)).sum() - 1e-4 * b
            haa, hab, hbb = (h * (t - 0.5) ** 2).sum() + 1e-4, (h * (t - 0.5)).sum(), h.sum() + 1e-4
            det = haa * hbb - hab * hab
            a, b = a + 0.5 * (hbb * da - hab * db) / det, b + 0.5 * (haa * db - hab * da) / det
        model.slope, model.bias = float(a), float(b - a / 2)
    blank = ~full
    model.empty = float(good[blank].mean()) if blank.any() else 0.0
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learn_from: Column | None = None, sample: int = SAMPLE) -> Crf:
    """Train on the sample labelled rows (of those where learn_from holds) whose ids have the smallest hashes.

    Conflicting labels of an id count as the larger; null ids and labels are left out; of rows with one id the
    least text counts. Without any
    labelled row the model scores everything 0.5.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.where(learn_from) if learn_from is not None else known
    known = known.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    # as many rows of each label as there are, up to half of the sample: the rarer label would else be thin
    chosen = known.groupBy("_id").agg(F.max("_y").alias("_y"))
    halves = [chosen.where(c).orderBy(F.xxhash64("_id"), "_id").limit(sample // 2) for c in (F.col("_y") == 1, F.col("_y") != 1)]
    chosen = halves[0].unionByName(halves[1])
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.coalesce(F.min("_text"), F.lit("")).alias("_text"))
    got = sorted((r["_text"], r["_y"]) for r in rows.collect())
    if not got:
        width = line_features(*buffers(pa.array(["a"])))[0].shape[1]
        return Crf(np.zeros(width), np.ones(width), np.zeros(width), np.zeros((2, 2)), 0.0, 0.0, 0.5)
    return train([t for t, _ in got], np.array([y == 1 for _, y in got]))


def score(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id and score, 0 to 1 (higher: label 1 likelier).

    Null, empty and wordless texts get the share of label 1 among such training rows (0 if none);
    whole texts of any length count; equal texts get equal scores; other columns are ignored.
    """

    bounded_batches(docs.sparkSession)
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(model.score(batch.column("_text")))], ["_id", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"_id {id_type}, score double").withColumnRenamed("_id", id_col)


def keep_good(docs: DataFrame, model: Crf, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of docs that score at least threshold, with all their columns."""

    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.score(batch.column(text_col)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
