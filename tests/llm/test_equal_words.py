"""Different words, lines and word sequences that a polynomial hash would take for equal ones."""

from collections import Counter

import numpy as np
import pyarrow as pa

from sightline.llm import near_dedup, packing, quality_rules, substring_dedup
from sightline.llm.arrays import SPACE_CUT, buffers, spans


def thue_morse(a, b, n=10, join=""):
    x = [a]
    for _ in range(n):
        x = x + [b if c == a else a for c in x]
    return join.join(x)


ONE, TWO = thue_morse("a", "b"), thue_morse("b", "a")
FILL = " ".join(f"w{k}" for k in range(34))


def two(spark, texts):
    return spark.createDataFrame([(k, t, f"s{k}") for k, t in enumerate(texts)], "doc_id long, text string, source string")


def test_hashes_differ():
    words = spans(*buffers(pa.array([f"{ONE} {TWO}", ONE, thue_morse("x", "y", join=" "), thue_morse("y", "x", join=" ")])), SPACE_CUT)
    for seed in (0, 1):
        h = words.hashes(seed)
        assert h[0] != h[1] and h[0] == h[2]
    keys = words.keys()
    assert (keys[2] != keys[3]).all() and len(np.unique(keys[:, 0])) == 4


def test_substring_dedup_keeps_different_windows(spark):
    got = substring_dedup.remove_repeated_windows(two(spark, [f"{FILL} {ONE}", f"{FILL} {TWO}"])).collect()
    assert [(r.n_words, r.n_removed) for r in got] == [(35, 0)] * 2


def test_near_dedup_and_packing_keep_different_texts(spark):
    for pair in ([ONE, TWO], [thue_morse("x", "y", join=" "), thue_morse("y", "x", join=" ") + " z"]):
        keys = [r.node for r in near_dedup.with_key(two(spark, pair), "text", "node").collect()]
        assert keys[0] != keys[1]
    classes = dict(near_dedup.near_duplicate_classes(two(spark, [ONE, TWO])).collect())
    assert classes == {0: 0, 1: 1}
    assert len({r.bin_id for r in packing.pack(two(spark, [ONE, TWO, ONE])).collect()}) == 2


def test_rules_count_equal_lines_only(spark):
    got = quality_rules.rate(two(spark, [f"{ONE}\n{TWO}", f"{ONE}\n{ONE}"]), None).collect()
    assert [r.n_dup_lines for r in sorted(got, key=lambda r: r.doc_id)] == [0, 1]


def test_common_counts():
    r = np.random.default_rng(4)
    texts = [" ".join(r.choice(["a", "b", "c"], int(n))) for n in (3, 8, 40, 400, 900, 0)] + ["a " * 300, "a " * 500, "b " * 9]
    both, size = near_dedup._common(pa.array(texts))

    def five(t):
        w = t.split()
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])

    sets = [five(t) for t in texts]
    assert size.tolist() == [sum(c.values()) for c in sets]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert both[i, j] == sum((a & b).values())
