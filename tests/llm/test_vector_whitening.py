"""Contour-integral whitening against a dense eigensolver, odd rows."""

import math

import numpy as np
import pytest

from faultline.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def spread(n, d, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) * np.linspace(1.0, 0.05, d)).astype(np.float32)


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in zip(ids, x)], VECTORS)


def brute(x):
    """Integer rows, distinct rows, sums, covariance."""
    rows = np.floor(256.0 * np.asarray(x, np.float64)).astype(np.int64)
    fit = np.unique(rows, axis=0)
    d = fit - fit.sum(axis=0) / len(fit)
    return rows, fit, fit.sum(axis=0), d.T @ d / len(fit)


def test_rows_equal_a_dense_solver(spark):
    x = spread(300, 12)
    x = np.r_[x, x[:40], np.repeat(x[:1], 150, axis=0)]
    rows, fit, total, v = brute(x)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    got = whitening.whiten(frame(spark, x)).collect()
    assert len(got) == 4 * len(x) and {r.n for r in got} == {len(fit)} == {300}
    w = np.zeros((len(x), 4))
    for r in got:
        w[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == sum((300 * int(a) - int(s)) ** 2 for a, s in zip(rows[r.vec_id], total))
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        assert r.identity_error < 1e-9
    want = (rows - total / len(fit)) @ vectors / np.sqrt(values)
    sign = np.sign((w * want).sum(axis=0))
    assert np.abs(w * sign - want).max() < 1e-8


def test_test_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    x = {r.vec_id: r.embedding for r in table.collect()}
    _, fit, _, v = brute(list(x.values()))
    values = np.linalg.eigvalsh(v)[::-1]
    got = whitening.whiten(table).collect()
    assert len(got) == 4 * len(x) and {r.n for r in got} == {len(fit)}
    for c in range(4):
        part = [r for r in got if r.component == c + 1]
        assert part[0].explained == pytest.approx(values[c] / values.sum(), rel=1e-10)
    assert got[0].identity_error < 1e-8


@pytest.mark.parametrize("d,k", [(1, 1), (2, 2), (3, 4), (40, 25), (64, 4)])
def test_intervals_hold_the_largest(d, k):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, d))
    v = a @ a.T
    want = np.linalg.eigvalsh(v)[::-1]
    k = min(k, d)
    fences = whitening.intervals(v, k, most=8)
    assert sum(n for *_, n in fences) >= k
    found, vectors = [], []
    for low, high, n in fences:
        assert n == ((want > low) & (want < high)).sum()
        values, turned = whitening.feast(v, low, high, n)
        found += values.tolist()
        vectors.append(turned)
    assert found == pytest.approx(want[: len(found)], rel=1e-10)
    q = np.concatenate(vectors, axis=1)
    assert np.abs(q.T @ q - np.eye(q.shape[1])).max() < 1e-9
    assert np.abs(v @ q - q * found).max() < 1e-10 * want[0] * d


def test_equal_and_nearly_equal_eigenvalues():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    for values in (np.ones(30), np.r_[np.full(20, 3.0), np.full(10, 1.0)], np.r_[5.0, 5.0 + 1e-9, np.ones(28)]):
        v = (q * values) @ q.T
        v = (v + v.T) / 2
        want = np.sort(values)[::-1]
        found = []
        for low, high, n in whitening.intervals(v, 4):
            got, vectors = whitening.feast(v, low, high, n)
            found += got.tolist()
            assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-9
        assert len(found) >= 4 and found == pytest.approx(want[: len(found)], rel=1e-9)


def test_inertia_counts():
    v = np.diag([3.0, 1.0, 0.0, -2.0])
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((4, 4)))
    diagonal, off = whitening.tridiagonal(q @ v @ q.T)
    got = [whitening.inertia(diagonal, off, s) for s in (-3, -1, 0.5, 2, 4)]
    assert got == [0, 1, 2, 3, 4]


def test_a_count_that_is_not_met_is_an_error():
    with pytest.raises(ArithmeticError, match="inertia says 3"):
        whitening.feast(np.diag([1.0, 2.0, 3.0, 4.0]), 2.5, 4.5, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(70)]
    rows = good + [
        (None, [1.0, 2.0, 1.0]),
        (2**62 + 1, [1.0, 2.0, 1.0]),
        (3, None),
        (3, []),
        (3, [1.0, None, 2.0]),
        (3, [1.0, nan, 2.0]),
        (3, [1.0, -inf, 2.0]),
        (3, [1.0, 2.0]),
        (3, [1.0, 3e38, 2.0]),
    ]
    odd = spark.createDataFrame(
        [(i, v, 7, 1) for i, v in rows], "vec_id long, embedding array<float>, n int, `whitened.x` int"
    )
    got = whitening.whiten(odd).collect()
    # the third component does not vary
    assert {r.component for r in got} == {1, 2} and len(got) == 2 * 72
    assert {r.n for r in got} == {35}
    ids = [r.vec_id for r in got]
    assert ids.count(None) == 2 and ids.count(2**62 + 1) == 2 and ids.count(3) == 2
    assert all(math.isfinite(r.whitened) for r in got) and got[0].identity_error < 1e-9


def test_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.whiten(empty).count() == 0
    same = frame(spark, np.ones((5, 3), np.float32))
    assert whitening.whiten(same).columns == whitening.whiten(empty).columns
    assert whitening.whiten(same).count() == 0


def test_deviations_beyond_64_bits():
    x = np.array([[2**40, 0], [1, 2]], np.int64)
    assert whitening.exact_deviations(x, 10, [5, 6]) == [None, 5 * 5 + 14 * 14]
