"""Pairs that stay bounded in what they shuffle."""

import random
from collections import Counter
from itertools import combinations

from sightline.operators import relational as R


def test_covisible_pairs_without_shuffle_of_all_pairs(spark):
    rng = random.Random(5)
    views = [(rng.randrange(200), rng.randrange(700)) for _ in range(3000)] + [(1, None), (None, 3), (None, 4)]
    seen: dict[int, set[int]] = {}
    for f, c in views:
        if f is not None and c is not None:
            seen.setdefault(f, set()).add(c)
    n = Counter(p for s in seen.values() for p in combinations(sorted(s), 2))
    domain = [(c,) for c in range(600)] + [(None,), (5,)]
    got = R.covisible_pairs(spark.createDataFrame(views, "f int, c int"), "f", "c", spark.createDataFrame(domain, "c int"))
    above = got._jdf.queryExecution().executedPlan().toString().split("NestedLoopJoin")[0]
    assert "Exchange" not in above and "SortMergeJoin" not in above
    assert {(r.camera_a, r.camera_b): r.shared for r in got.collect()} == {p: n[p] for p in combinations(range(600), 2)}


def test_covisible_pairs_over_many_blocks(spark):
    rng = random.Random(6)
    names = [f"c{k:02}" for k in range(37)]
    views = [(f, c) for f in range(300) for c in rng.sample(names, rng.randrange(5))] + [(7, c) for c in names] * 2 + [(8, "c99")]
    seen = {f: sorted({c for g, c in views if g == f}) for f in range(300)}
    n = Counter(p for s in seen.values() for p in combinations(s, 2))
    for domain in (names, names[:16], names[:1], []):
        got = R.covisible_pairs(spark.createDataFrame(views, "f int, c string"), "f", "c", spark.createDataFrame([(c,) for c in domain], "c string"), later=4, earlier=16, tile=8)
        assert got.dtypes == [("camera_a", "string"), ("camera_b", "string"), ("shared", "bigint")]
        assert sorted(map(tuple, got.collect())) == [(*p, n[p]) for p in combinations(domain, 2)]


def shuffled(spark) -> int:
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def test_covisible_pairs_leave_little_on_disk(spark, tmp_path):
    """Views are shuffled once and pairs packed (51 bytes a view before), and neighbouring rows are alike in the result's files."""
    rng = random.Random(7)
    spark.createDataFrame([(f, 9 * rng.randrange(1500)) for f in range(20000) for _ in range(4)], "f long, c long").write.parquet(str(tmp_path / "views"))
    spark.createDataFrame([(9 * c,) for c in range(1500)], "c long").write.parquet(str(tmp_path / "domain"))
    before = shuffled(spark)
    got = R.covisible_pairs(spark.read.parquet(str(tmp_path / "views")), "f", "c", spark.read.parquet(str(tmp_path / "domain")))
    got.write.parquet(str(tmp_path / "pairs"))
    a_view = (shuffled(spark) - before) / 80000
    files = sum(p.stat().st_size for p in (tmp_path / "pairs").glob("*.parquet"))
    assert spark.read.parquet(str(tmp_path / "pairs")).count() == 750 * 1499
    assert a_view < 20
    assert files / (750 * 1499) < 0.5
