"""Quality rules: exact rule statistics, and an isolation forest that finds documents whose statistics are anomalous.

The forest is grown from the label-1 rows of a bounded sample of labelled rows (SAMPLE rows, a
parameter) that pass the base rules; each tree
splits a random feature at a random value, so a row that ends after few splits is anomalous.
The verdict's threshold is calibrated on all labelled rows that pass: the cut of the anomaly score
with the best balanced accuracy for the labels. Every row is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import linestats as ls
from .arrays import buffers, slabs, span_hash, windows
from .cluster import bounded_batches
from .cluster import cut as checkpointed

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_marks")
TREES, SUBSAMPLE, SAMPLE = 200, 128, 4000
BINS = 1 << 14
SEED = 17


def rule_counts(column: pa.Array | pa.ChunkedArray) -> dict[str, np.ndarray]:
    """The counts of COUNTS and EXTRA for each text; null is an empty text."""
    data, offsets = buffers(column)
    found = {k: [np.zeros(0, np.int64)] for k in (*COUNTS, *EXTRA)}
    for i, j in slabs(offsets):
        raw, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        lines = ls.lines_of(raw, off)
        words, rows = lines.words, j - i
        per_row = lambda values, row, n=rows: np.bincount(row, weights=values, minlength=n).astype(np.int64)
        chars, hashes, doc = ls.word_chars(words), words.hashes(), words.doc
        filled = np.diff(lines.first_word) > 0
        with_word = np.flatnonzero(filled)
        dup = ls.earlier_equal(ls.line_hashes(lines)[with_word], lines.row[with_word])
        start, row = windows(words.first, 3)
        hit = start[ls.repeated(span_hash(hashes, start, start + 3, 1), row)]
        cover = np.zeros(len(words.start), bool)
        for k in range(3):
            cover[hit + k] = True
        found["n_words"].append(np.diff(words.first))
        found["word_chars"].append(per_row(chars, doc))
        found["n_symbols"].append(ls.sums(ls.SYMBOLS[raw], off[:-1], off[1:]))
        found["n_dup_lines"].append(per_row(dup, lines.row[with_word]))
        found["n_repeat_words"].append(per_row(cover, doc))
        for name, table in (("n_upper", ls.UPPER), ("n_marks", ls.MARKS)):
            found[name].append(ls.sums(table[raw], off[:-1], off[1:]))
    return {k: np.concatenate(v) for k, v in found.items()}


def statistics(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics as the forest sees them: rates, so that length alone is no anomaly."""
    words, chars = np.maximum(counts["n_words"], 1), np.maximum(counts["word_chars"], 1)
    return np.column_stack([counts["word_chars"] / words, counts["n_symbols"] / chars, counts["n_repeat_words"] / words, counts["n_upper"] / chars, counts["n_marks"] / chars])


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


def _expected(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Complete binary trees in arrays: the children of node k are 2k+1 and 2k+2; feature -1 marks a leaf, whose value is its path length."""

    feature: np.ndarray
    value: np.ndarray
    norm: float
    cut: float = 0.0

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected path length): near 1 for rows that are isolated early."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value in zip(self.feature, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                at = np.where(inner, 2 * at + 1 + (x[rows, np.maximum(f, 0)] >= value[at]), at)
            total += value[at]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def grow(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> Forest:
    rng = np.random.default_rng(seed)
    depth = max(1, int(np.ceil(np.log2(max(2, min(subsample, len(x)))))))
    size = 2 ** (depth + 1) - 1
    feature, value = np.full((trees, size), -1, np.int64), np.zeros((trees, size))

    def split(t: int, node: int, rows: np.ndarray, level: int) -> None:
        spread = np.flatnonzero(np.ptp(x[rows], axis=0) > 0) if len(rows) else []
        if level == depth or len(rows) <= 1 or not len(spread):
            value[t, node] = level + _expected(len(rows))
            return
        f = int(rng.choice(spread))
        v = rng.uniform(x[rows, f].min(), x[rows, f].max())
        v = v if v > x[rows, f].min() else x[rows, f].max()
        feature[t, node], value[t, node] = f, v
        right = x[rows, f] >= v
        split(t, 2 * node + 1, rows[~right], level + 1)
        split(t, 2 * node + 2, rows[right], level + 1)

    n = min(subsample, len(x))
    for t in range(trees):
        split(t, 0, rng.choice(len(x), n, replace=False), 0)
    return Forest(feature, value, float(max(_expected(n), 1e-9)))


def calibrate(scored: DataFrame) -> float:
    """The cut c for which "score < c means good" has the best balanced accuracy; above every score if one label is missing.

    scored has a row per labelled row: score (0 to 1) and good. The driver sees the label counts of
    BINS ranges of the score; those ranges that can hold the best cut are then searched score by score.
    """
    counts = (F.sum(F.when(c, 1).otherwise(0)).alias(n) for c, n in ((F.col("good"), "g"), (~F.col("good"), "b")))
    scores = checkpointed(scored.groupBy("score").agg(*counts).withColumn("bin", F.floor(F.col("score") * BINS)))
    bins = sorted(scores.groupBy("bin").agg(F.sum("g"), F.sum("b"), F.min("score")).collect())
    g, b = (np.array([r[k] for r in bins], np.int64) for k in (1, 2))
    if not g.sum() or not b.sum():
        return 2.0
    g_end, b_end, n_g, n_b = np.cumsum(g), np.cumsum(b), int(g.sum()), int(b.sum())
    most = g_end / n_g + 1 - (b_end - b) / n_b  # a bin's cuts are at most this good
    chosen = np.flatnonzero(most >= (g_end / n_g + 1 - b_end / n_b).max()).tolist()
    rows = [(bins[k][0], int(g_end[k] - g[k]), int(b_end[k] - b[k]), bins[k + 1][3] if k + 1 < len(bins) else None) for k in chosen]
    before = scored.sparkSession.createDataFrame(rows, "bin long, g_before long, b_before long, next_bin double")
    by_score = Window.partitionBy("bin").orderBy("score")
    good, bad = (F.col(f"{k}_before") + F.sum(k).over(by_score.rowsBetween(Window.unboundedPreceding, 0)) for k in ("g", "b"))
    right = good / F.lit(n_g) + 1 - bad / F.lit(n_b)
    found = scores.join(F.broadcast(before), "bin").select("score", right.alias("right"), F.coalesce(F.lead("score").over(by_score), "next_bin").alias("next"))
    best = found.orderBy(F.desc("right"), "score").first()
    return 2.0 if best["next"] is None else (best["score"] + best["next"]) / 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Forest | None:
    """Grow the forest on the sample rows whose ids have the smallest hashes and calibrate it on all; None without labelled rows in the sample that pass the base rules.

    Conflicting labels of an id count as the larger. Of rows with one id the least text grows the
    forest, and the least anomaly of those that pass counts for the cut.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    known = known.groupBy("_id").agg(F.max("_y").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text")).select("_y", "_text")

    def stats(batches):
        for batch in batches:
            counts = rule_counts(batch.column("_text"))
            passed = pa.array(~base_failed(counts))
            yield pa.RecordBatch.from_arrays([batch.column("_y"), pa.array(list(statistics(counts)), pa.list_(pa.float64()))], ["y", "x"]).filter(passed)

    got = rows.mapInArrow(stats, "y int, x array<double>").toArrow().to_pydict()
    if not got["y"]:
        return None
    order = sorted(range(len(got["y"])), key=lambda k: (got["x"][k], got["y"][k]))
    x, y = np.array([got["x"][k] for k in order]), np.array([got["y"][k] == 1 for k in order])
    forest = grow(x[y] if y.any() else x)
    passed = rate(docs, forest, id_col, text_col).where(~F.col("base_failed")).groupBy(F.col(id_col).alias("_id")).agg(F.min("anomaly").alias("score"))
    forest.cut = calibrate(passed.join(known, "_id").select("score", (F.col("_y") == 1).alias("good")))
    return forest


def rate(docs: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, the five counts, base_failed, anomaly (0 to 1) and kept.

    base_failed: under 50 words, or over half of the words in three-word windows that the text
    repeats. kept: false if base_failed, else whether the anomaly score is below the calibrated
    cut; without a forest the base rules alone decide. A null text counts as empty (and so fails);
    equal texts get equal results; other columns are ignored.
    """

    bounded_batches(docs.sparkSession)
    def run(batches):
        for batch in batches:
            counts = rule_counts(batch.column("_text"))
            failed = base_failed(counts)
            anomaly = forest.anomaly(statistics(counts)) if forest and len(failed) else np.zeros(len(failed))
            kept = ~failed & (anomaly < forest.cut if forest else True)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *(pa.array(counts[k]) for k in COUNTS), pa.array(failed), pa.array(anomaly), pa.array(kept)], ["_id", *COUNTS, "base_failed", "anomaly", "kept"])

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {id_type}, " + ", ".join(f"{k} long" for k in COUNTS) + ", base_failed boolean, anomaly double, kept boolean"
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema).withColumnRenamed("_id", id_col)
