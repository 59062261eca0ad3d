"""Embedding whitening against numpy and exact integers."""

import math
import random

import numpy as np
import pytest

from gridlens.llm import whitening as WH

SCHEMA = "vec_id long, embedding array<float>, label int, n long, w string, component string"


def rows_of(spark, vectors, parts=3):
    rows = [(i, v, None, 7, "w", "c") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def brute(vectors):
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    z = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x])
    values, vecs = np.linalg.eigh(z.T @ z / n)
    return [i for i, _ in kept], n, deviation, z, values[::-1], vecs[:, ::-1]


def test_whitening_matches_numpy(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((700, 12)) @ np.diag([3, 3, 2, 1, 1, .5, .5, .4, .3, .2, .1, .05]) @ rng.standard_normal((12, 12))
    vectors = [(i, [float(np.float32(c)) for c in r]) for i, r in enumerate(base)]
    vectors += [(700, None), (701, [1.0, None] + [0.0] * 10), (702, [float("nan")] * 12), (703, [float("inf")] * 12),
                (704, [1.0] * 5), (705, []), vectors[3], (None, vectors[4][1])]
    got = WH.whiten(rows_of(spark, vectors)).collect()
    ids, n, deviation, z, values, vecs = brute([v for v in vectors if v[0] not in (704, 705)])
    assert n == 702 and len(got) == 8 * n
    assert sorted(str(r["vec_id"]) for r in got) == sorted(str(i) for i in ids for _ in range(8))
    by = {(r["vec_id"], r["component"]): r for r in got}
    sign = {c: 1 if by[ids[0], c]["whitened"] * (z[0] @ vecs[:, c - 1]) >= 0 else -1 for c in range(1, 9)}
    for k, i in enumerate(ids):
        for c in range(1, 9):
            r = by[i, c]
            assert r["n"] == n and r["deviation"] == deviation[k]
            assert r["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
            assert sign[c] * r["whitened"] == pytest.approx(z[k] @ vecs[:, c - 1] / math.sqrt(values[c - 1]), abs=1e-8)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_equal_eigenvalues_and_few_rows(spark):
    # +-unit vectors: all eigenvalues are equal; orthogonal components all the same
    vectors = [(2 * i + s, [float(s * 2 - 1) * (j == i) for j in range(6)]) for i in range(6) for s in (0, 1)]
    got = WH.whiten(rows_of(spark, vectors)).collect()
    assert len(got) == 12 * 6 and got[0]["identity_error"] < 1e-9
    one = WH.whiten(rows_of(spark, [(1, [0.5, 0.25])])).collect()  # no variance
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in one] == [
        (1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)]
    line = WH.whiten(rows_of(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])).collect()  # rank 1
    assert {r["component"]: r["whitened"] is None for r in line} == {1: False, 2: True, 3: True}
    assert WH.whiten(rows_of(spark, [])).collect() == [] and WH.whiten(rows_of(spark, [(1, None)])).collect() == []


def test_huge_entries_have_a_defined_result(spark):
    rng = random.Random(2)
    vectors = [(i, [rng.uniform(-1, 1) * 1e30, rng.uniform(-1, 1)]) for i in range(20)]
    got = WH.whiten(rows_of(spark, vectors)).collect()
    assert len(got) == 40 and all(r["deviation"] is None and r["deviation_approx"] > 2.0 ** 63 for r in got)
    assert WH.whiten(rows_of(spark, vectors, parts=7)).count() == 40


@pytest.mark.parametrize("d", [1, 2, 3, 40])
def test_eigenvectors(d):
    rng = np.random.default_rng(d)
    for spread in (1.0, 1e-9, 0.0):  # distinct, clustered and equal eigenvalues
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        want = 5 + spread * np.arange(d)[::-1]
        cov = q @ np.diag(want) @ q.T
        k = min(8, d)
        values, vectors = WH.leading_components((cov + cov.T) / 2, k)
        assert np.allclose(values, want[:k], rtol=1e-13)
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
        assert np.abs(cov @ vectors - vectors * values).max() < 1e-12
    blocks = np.diag([3.0, 3.0, 1.0, 1.0, 0.0])  # already tridiagonal, splits
    values, vectors = WH.leading_components(blocks, 5)
    assert np.allclose(values, [3, 3, 1, 1, 0], atol=1e-14) and np.abs(blocks @ vectors - vectors * values).max() < 1e-13
    assert np.abs(vectors.T @ vectors - np.eye(5)).max() < 1e-12
