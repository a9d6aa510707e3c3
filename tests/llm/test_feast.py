"""Whitening against a plain eigendecomposition, and its numbers against plain integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from claimlode.llm import feast

ROWS = "vec_id long, embedding array<float>, label int, x string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], ROWS)


def spread(n=300, d=12, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.linspace(0.2, 2, d) + 0.3
    return [(i, [float(c) for c in np.float32(row)]) for i, row in enumerate(x)]


def checked(spark, rows, wanted=4):
    got = feast.whitened(frame(spark, rows), wanted).collect()
    whole = {i: [math.floor(256 * c) for c in v] for i, v in rows}
    once = sorted({tuple(x) for x in whole.values()})
    n, sums = len(once), [sum(column) for column in zip(*once)]
    fit = np.array(once, float)
    away = fit - fit.mean(0)
    v = away.T @ away / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    held = min(wanted, len(e))
    assert len(got) == held * len(rows)
    values = {(r.vec_id, r.component): r for r in got}
    for i, x in whole.items():
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k in range(held):
            r = values[i, k + 1]
            assert (r.n, r.deviation) == (n, deviation)
            assert r.explained == pytest.approx(e[k] / np.trace(v), rel=1e-9)
            assert r.identity_error < 1e-10
    for k in range(held):
        mine = np.array([values[i, k + 1].whitened for i in whole])
        plain = (np.array([whole[i] for i in whole]) - fit.mean(0)) @ u[:, k] / np.sqrt(e[k])
        assert np.abs(mine - math.copysign(1, mine @ plain) * plain).max() < 1e-8


def test_whitening_equals_a_plain_decomposition(spark):
    checked(spark, spread())


def test_repeated_rows_count_once_and_zero_vectors_do_count(spark):
    rows = spread(80, 6)
    rows += [(1000 + i, rows[3][1]) for i in range(500)] + [(2000, [0.0] * 6), (2001, [-0.0] * 6)]
    checked(spark, rows)


def test_fewer_dimensions_than_components(spark):
    checked(spark, spread(50, 2))


def test_rows_that_take_no_part(spark):
    rows = spread(60, 5)
    odd = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4), (104, [1.0]), (105, [])]
    want, got = (sorted(feast.whitened(frame(spark, data)).drop("identity_error").collect()) for data in (rows, rows + odd))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert [r.whitened for r in got] == pytest.approx([r.whitened for r in want], abs=1e-9)
    assert feast.whitened(frame(spark, [])).collect() == []
    assert feast.whitened(frame(spark, odd)).collect() == []
    assert feast.whitened(frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect() == []
    assert {r.component for r in feast.whitened(frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 2.0]), (None, [0.5, 3.0])])).collect()} == {1}


def test_deviations_are_exact_or_null():
    assert feast.exact_deviations(np.array([[3, -2]]), 5, [4, 4]) == [(15 - 4) ** 2 + (-10 - 4) ** 2]
    big = np.array([[1 << 40, 0], [5, 5]])
    assert feast.exact_deviations(big, 1 << 20, [7, 7]) == [None, 2 * (5 * (1 << 20) - 7) ** 2]
    assert feast.exact_deviations(np.array([[1 << 62, 1]]), 9, [0, 0]) == [None]


def matrices():
    rng = np.random.default_rng(3)
    yield "gaps", np.diag(10.0 ** -np.arange(30))
    yield "equal", np.diag(np.r_[np.full(7, 5.0), np.ones(20)])
    yield "close", np.diag(np.r_[9, 8, 7, 5, 5 - 1e-9, 1, 1])
    yield "closer", np.diag(np.r_[9, 8, 7, 5, 5 - 1e-13, 1, 1])
    yield "one", np.full((20, 20), 1.0)
    yield "single", np.array([[4.0]])
    yield "crowd", np.diag(np.r_[1, 1e-3 * (1 + 1e-4 * np.arange(50))])
    for d in (2, 5, 16, 64, 130):
        x = rng.normal(size=(200, d)) * np.linspace(1, 3, d)
        yield f"random{d}", np.cov(x.T, bias=True)
    for i in range(60):
        x = rng.integers(-3, 4, size=(int(rng.integers(2, 40)), int(rng.integers(1, 40)))).astype(float)
        yield f"whole{i}", np.cov(x.T, bias=True).reshape(x.shape[1], -1)


@pytest.mark.parametrize("name,v", list(matrices()))
def test_leading_eigenpairs(name, v):
    e, u = feast.leading(v, 4)
    plain = np.linalg.eigvalsh(v)[::-1]
    assert len(e) == min(4, (plain > 1e-9 * max(plain[0], 1e-300)).sum())
    if len(e):
        assert np.abs(e - plain[: len(e)]).max() < 1e-12 * plain[0]
        assert np.abs(v @ u - u * e).max() < 1e-12 * plain[0]
        assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(30, 30))
    v = v + v.T
    plain = np.linalg.eigvalsh(v)
    for at in (-5.0, -0.1, 0.0, 0.7, 9.0, 100.0):
        assert feast.above(*feast.tridiagonal(v), at) == (plain > at).sum()


def test_a_matrix_of_zeros_has_no_components():
    assert len(feast.leading(np.zeros((3, 3)), 4)[0]) == 0
