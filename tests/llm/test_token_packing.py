"""Token packing: naive first fit, exact round trips of every id, and no padding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sightline.llm.token_packing import encoded, filled, first_fit, pack_group, pack_tokens, tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_first_fit_is_the_first_bin_with_room():
    r = random.Random(1)
    for _ in range(60):
        sizes = sorted((r.randint(1, 100) for _ in range(r.randint(1, 200))), reverse=True)
        left = []
        for n, got in zip(sizes, first_fit(sizes, 100), strict=True):
            want = next((k for k, x in enumerate(left) if x >= n), len(left))
            assert got == want
            if want == len(left):
                left.append(100)
            left[want] -= n


def test_groups_lose_nothing_and_need_no_padding():
    r = random.Random(2)
    for _ in range(200):
        lengths = np.array(sorted((r.choice([64, r.randint(1, 64)]) for _ in range(r.randint(0, 60))), reverse=True), np.int64)
        bins = pack_group(lengths, 64)
        seen = {}
        for x in bins:
            n = sum(b - a for _, a, b in x)
            assert 0 < n <= 64 and n & (n - 1) == 0
            for piece, a, b in x:
                assert b > a
                seen.setdefault(piece, []).append((a, b))
        for k, n in enumerate(lengths):
            spans = sorted(seen[k])
            assert spans[0][0] == 0 and spans[-1][1] == n and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
    assert filled([], 64) == []


TEXTS = ["", "one", " leading", "trailing ", "two  spaces and\n\nlines \n x", "it's we'll I'd don't 's", "a b c, d. e! f? (g) 12 3a 4 b", "Ünïcode wörds ₿ 中文 text nbsp 　 wide", "tab\t word\r\n next", "x" * 5000, "<|endoftext|> as text", "café olé z", "a\x00b \x01 c", "- b - c  - d"]


def test_segments_encode_as_whole_texts():
    r = random.Random(3)
    parts = ["word", "it's", " ", " ", "  ", "\n", "\n\n", ",", ".", "(", "'s", "-'", "\u3000", "\xa0", "\r", "9", "é", "中", "\t", "A", " ", "'", "-", "ll", "<|endoftext|>"]
    texts = TEXTS + ["".join(r.choice(parts) for _ in range(r.randint(0, 80))) for _ in range(4000)]
    raw = [t.encode() for t in texts]
    ids, bound = encoded(PATH, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    whole = tokenizer(PATH).encode_batch(texts, add_special_tokens=False)
    for k, e in enumerate(whole):
        assert ids[bound[k] : bound[k + 1]].tolist() == e.ids, texts[k]


@pytest.mark.parametrize("group_rows", [4, 16384])
def test_round_trip(spark, group_rows):
    r = random.Random(4)
    texts = [*TEXTS, None, " ".join(r.choice(["ta", "lemon", "Shi,", "9"]) for _ in range(30000))] + [" ".join(r.choice(["ka", "rim", "no."]) for _ in range(r.randint(0, 900))) for _ in range(80)]
    rows = [*enumerate(texts), (None, "no id"), (7, texts[7]), (7, texts[7])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_id": F.lit(1), "ids": F.lit(2), "grp": F.lit("x"), "start": F.lit(3)})
    out = pack_tokens(df, PATH, group_rows=group_rows).collect()
    sequences, docs = {}, {}
    for x in out:
        ids = np.frombuffer(x.ids, "<u4")
        assert len(ids) == x.length > 0
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
        docs.setdefault(x.doc_id, []).append((x.start, x.length, x.doc_tokens, ids.tolist()))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048 and at & (at - 1) == 0
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append([*tokenizer(PATH).encode(t or "", add_special_tokens=False).ids, 1])
    assert docs.keys() == want.keys()
    for i, pieces in docs.items():
        assert all(p[2] == len(want[i][0]) for p in pieces)
        assert sum(p[1] for p in pieces) == sum(map(len, want[i]))
        got = [None] * len(want[i][0])
        for start, _, _, ids in pieces:
            got[start : start + len(ids)] = ids
        assert got == want[i][0]
    assert pack_tokens(df.limit(0), PATH).count() == 0


def test_query_digests(spark, tmp_path):
    from sightline.llm import registry

    spark.createDataFrame([(1, "hello world"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in registry.queries()["op12_first_fit_packing"](spark, str(tmp_path)).collect() if x.start == 0 and x.length == x.doc_tokens}
    assert got[2].ids_crc32 == zlib.crc32(np.array([1], "<u4").tobytes())
