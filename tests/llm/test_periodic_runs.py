"""Periodic runs against a search over all periods, and their edge cases."""

import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from sightline.llm.periodic_runs import Suffixes, find_runs, next_smaller, runs_of, with_periodic_tails


def brute(w, exponent=4, least=6):
    """(start, period, length) of each run: maximal stretches where words q apart are equal, if no smaller period fits."""
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, exponent * q) and not any(all(w[k] == w[k + r] for k in range(i, i + n - r)) for r in range(1, q)):
                out.append((i, q, n))
            i = j + 1
    return sorted(out)


def collapsed(w, runs):
    gone = {k for s, q, n in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def test_runs_of_random_rows():
    r = random.Random(1)
    for _ in range(600):
        rows = []
        for _ in range(r.randint(1, 5)):
            n, letters = r.randint(0, 40), r.choice([1, 2, 3])
            w = [r.randrange(letters) for _ in range(n)]
            if n and r.random() < 0.5:
                p = r.randint(1, min(n, 5))
                w = [w[i % p] for i in range(n)]
                w[r.randrange(n)] = r.randrange(letters + 1)
            rows.append(w)
        exponent, least = r.choice([2, 3, 4]), r.choice([2, 6])
        row, start, length, period = runs_of(np.array(sum(rows, []), np.int64), np.cumsum([0, *map(len, rows)]), exponent, least)
        got = list(zip(row.tolist(), start.tolist(), period.tolist(), length.tolist(), strict=True))
        assert got == [(d, *x) for d, w in enumerate(rows) for x in brute(w, exponent, least)]


def test_suffixes_and_next_smaller():
    r = random.Random(2)
    for n in (1, 2, 50, 3000):
        w = [r.randrange(1, 4) for _ in range(n)] + [0]
        s = Suffixes(np.array(w), deep=True)
        if n <= 50:
            assert s.order.tolist() == sorted(range(n + 1), key=lambda i: w[i:])
        for k in range(1, min(n, 200)):
            a, b = s.order[k - 1], s.order[k]
            assert w[a : a + s.lcp[k]] == w[b : b + s.lcp[k]] and w[a + s.lcp[k]] != w[b + s.lcp[k]]
        smaller = next_smaller(s.rank, np.arange(n))
        assert smaller.tolist() == [next(j for j in range(i + 1, n + 1) if s.rank[j] < s.rank[i]) for i in range(n)]
    rising = np.append(np.arange(1, 5000), 0)
    assert (next_smaller(rising, np.arange(4999)) == 4999).all()


def test_operator(spark):
    r = random.Random(3)
    texts = ["a b " * 30, "x\ty\nx y x y x y tail", "one " * 5, "one " * 6, "Å ß " * 4 + "₿", " ".join(r.choice("ab") for _ in range(3000)), "lead " + "k l m " * 4000 + "end"]
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "z " * 9), (4, texts[0]), (4, texts[0])] + [(10 + k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_id": F.lit(1), "runs": F.lit("x"), "n_words": F.lit(0)})
    got = find_runs(df).collect()
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = brute(w) if len(w) < 5000 else [(1, 3, 12000)]
        want.append((i, len(w), found, collapsed(w, found)))
    assert sorted(((x.doc_id, x.n_words, [(y.start, y.period, y.length) for y in x.runs], x.collapsed) for x in got), key=repr) == sorted(want, key=repr)
    assert find_runs(df.limit(0)).count() == 0


def test_periodic_tails(spark):
    texts = {k: " ".join(f"w{j}" for j in range(k % 37)) for k in range(300)}
    got = {x.doc_id: x.text for x in with_periodic_tails(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    changed = 0
    for k, t in texts.items():
        h, w = zlib.crc32(str(k).encode()), t.split()
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            changed += 1
        assert got[k] == " ".join(w)
    assert changed > 10
