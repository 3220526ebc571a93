"""Whitening against a dense eigensolver, exact integer deviations, and edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.llm import registry
from sightline.llm.whitening import fit_whitening, identity_error, whiten


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def brute(x):
    """Mean-free rows, eigenvalues and eigenvectors (falling) of whole numbers x."""
    y = x - x.mean(0)
    values, vectors = np.linalg.eigh(y.T @ y / len(y))
    return y, values[::-1], vectors[:, ::-1]


@pytest.mark.parametrize(("d", "n", "components", "guard"), [(64, 300, 32, 16), (90, 400, 4, 3), (90, 400, 1, 0), (5, 50, 32, 16), (120, 60, 8, 4)])
def test_against_a_dense_solver(spark, d, n, components, guard):
    rng = np.random.default_rng(d + components)
    v = rng.standard_normal((n, d)) * np.linspace(1.5, 0.4, d) + rng.standard_normal(d) * 30
    fit = fit_whitening(frame(spark, [(k, r.tolist()) for k, r in enumerate(v)], "double").repartition(5), components=components, guard=guard)
    y, values, vectors = brute(np.floor(64 * v) + 1_000_000)
    k = min(components, d)
    assert fit.n == n and fit.values.shape == (k,) and fit.residual <= 1e-11
    assert np.allclose(fit.values, values[:k], rtol=1e-10) and math.isclose(fit.trace, values.sum(), rel_tol=1e-12)
    signs = np.sign((fit.components * vectors[:, :k]).sum(0))
    assert np.abs(fit.components * signs - vectors[:, :k]).max() < 1e-7
    got = {r.vec_id: r.whitened for r in whiten(fit).collect()}
    want = y @ vectors[:, :k] / np.sqrt(values[:k]) * signs
    assert np.abs(np.array([got[j] for j in range(n)]) - want).max() < 1e-6
    assert identity_error(fit) < 1e-9
    if d == 90:
        assert fit.rounds > 1


EDGE = [(1, None), (2, [1.0, None, 2.0]), (3, [float("nan"), 0.0, 0.0]), (4, [float("inf"), 0.0, 0.0]), (5, []), (6, [1.0]), (None, [0.5, -0.25, 3.0])]


def test_unusable_rows_and_exact_deviations(spark):
    rng = np.random.default_rng(3)
    rows = EDGE + [(10 + k, r.tolist()) for k, r in enumerate(rng.standard_normal((40, 3)).astype(np.float32))] + [(10, [0.5, 0.5, 0.5])] * 3
    df = frame(spark, rows).withColumns({"_id": F.lit(1), "x": F.lit("y"), "n": F.lit(2), "place": F.lit(0)})
    fit = fit_whitening(df)
    used = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows[6:]]
    n, sums = len(used), [sum(v[k] for _, v in used) for k in range(3)]
    assert fit.n == n and fit.sums == sums
    got = sorted(((r.vec_id, int(r.deviation)) for r in whiten(fit).collect()), key=repr)
    assert got == sorted(((i, sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))) for i, v in used), key=repr)


def test_huge_entries_stay_exact(spark):
    rows = [(1, [1e300, 0.0]), (2, [-3e17, 1.0]), (3, [5.0, 2.0])]
    fit = fit_whitening(frame(spark, rows, "double"))
    x = [[min(max(math.floor(64 * c), -(2**62)), 2**62) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(v[k] for v in x) for k in range(2)]
    assert fit.sums == sums
    got = {r.vec_id: r.deviation for r in whiten(fit).collect()}
    for (i, _), v in zip(rows, x, strict=True):
        exact = sum((3 * c - s) ** 2 for c, s in zip(v, sums, strict=True))
        assert got[i] is None if exact >= 10**38 else int(got[i]) == exact


def test_no_variance_and_no_rows(spark):
    fit = fit_whitening(frame(spark, [(k, [1.0, float(k % 2), 2.0]) for k in range(10)]))
    rows = whiten(fit).collect()
    assert len(rows) == 10 and all(abs(abs(r.whitened[0]) - 1) < 1e-12 and r.whitened[1:] == [None, None] for r in rows)
    assert identity_error(fit) < 1e-9
    assert whiten(fit_whitening(frame(spark, [(1, [2.0, 2.0])] * 4))).count() == 4
    for rows in ([], [(1, None), (2, [])]):
        assert whiten(fit_whitening(frame(spark, rows))).count() == 0


def test_query(spark, tmp_path):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((200, 40)).astype(np.float32)
    frame(spark, [*((k, r.tolist()) for k, r in enumerate(v)), (900, None)]).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = registry.queries()["op13_embedding_whitening"](spark, str(tmp_path)).collect()
    y, values, vectors = brute(np.floor(64 * v.astype(float)) + 1_000_000)
    assert len(rows) == 200 * 32 and {r.component for r in rows} == set(range(1, 33)) and {r.n for r in rows} == {200}
    want = y @ vectors / np.sqrt(values)
    sign = {r.component: np.sign(r.whitened * want[0, r.component - 1]) for r in rows if r.vec_id == 0}
    for r in rows:
        assert abs(r.whitened * sign[r.component] - want[r.vec_id, r.component - 1]) < 1e-8
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-10 and r.identity_error < 1e-9
    frame(spark, []).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert registry.queries()["op13_embedding_whitening"](spark, f"{tmp_path}/none").count() == 0
