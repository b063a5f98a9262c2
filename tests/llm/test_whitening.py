"""Whitening against a dense eigendecomposition and exact integer sums."""

import math

import numpy as np
import pytest

from folioflow.llm import whitening

TYPES = "vec_id bigint, embedding array<float>, x int, id string"


def table_of(spark, vectors):
    return spark.createDataFrame([(i, v, 7, "clash") for i, v in enumerate(vectors)], TYPES)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def check(spark, vectors, most=4):
    found = whitening.whitened(table_of(spark, vectors), most).collect()
    rows = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in enumerate(vectors) if usable(v)}
    fit = np.array(sorted(set(map(tuple, rows.values()))), dtype=float)
    n, sums = len(fit), [sum(int(a) for a in column) for column in zip(*set(map(tuple, rows.values())))]
    centred = fit - fit.mean(axis=0)
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(most, int((values > values[0] * 1e-20).sum()), len(values))
    k = min(k, n - 1) if n - 1 < len(values) else k
    assert len(found) == k * len(rows)
    got = {}
    for r in found:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert got.keys() == rows.keys()
    signs = None
    for i, x in rows.items():
        ours = np.array([got[i][c]["whitened"] for c in range(1, k + 1)])
        theirs = (np.array(x) - np.array(sums) / n) @ basis[:, :k] / np.sqrt(values[:k])
        if signs is None:
            first = max(rows, key=lambda j: np.abs((np.array(rows[j]) - np.array(sums) / n) @ basis[:, :k] / np.sqrt(values[:k])).min())
            own = np.array([got[first][c]["whitened"] for c in range(1, k + 1)])
            signs = np.sign(own * ((np.array(rows[first]) - np.array(sums) / n) @ basis[:, :k]))
        assert np.allclose(ours, theirs * signs, atol=1e-6)
        for c in range(1, k + 1):
            r = got[i][c]
            assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums))
            assert abs(r["explained"] - values[c - 1] / values.sum()) <= 1e-9 and r["identity_error"] < 1e-9


def test_against_dense_solver(spark):
    draw = np.random.default_rng(1)
    base = draw.standard_normal((300, 9)) * [5, 3, 2, 1, 1, 0.5, 0.5, 0.1, 0.05] @ np.linalg.qr(draw.standard_normal((9, 9)))[0]
    vectors = [list(map(float, v)) for v in base]
    odd = [None, [1.0] * 8 + [None], [float("nan")] * 9, [float("inf")] + [0.0] * 8]
    check(spark, vectors + vectors[:50] + [vectors[0]] * 100 + odd)


def test_other_lengths_are_left_out(spark):
    draw = np.random.default_rng(2)
    vectors = [list(map(float, v)) for v in draw.standard_normal((20, 3))] + [[1.0], []]
    found = whitening.whitened(table_of(spark, vectors)).collect()
    assert {r["vec_id"] for r in found} == set(range(20)) and {r["component"] for r in found} == {1, 2, 3}


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[], []]])
def test_nothing_to_whiten(spark, vectors):
    assert whitening.whitened(table_of(spark, vectors)).collect() == []


def test_fewer_rows_than_dimensions(spark):
    draw = np.random.default_rng(3)
    check(spark, [list(map(float, v)) for v in draw.standard_normal((3, 6))])


def test_long_deviation_is_null(spark):
    vectors = [[2.0**20, 0.0], [0.0, 1.0]] + [[float(i), 1.0] for i in range(60)]
    found = whitening.whitened(table_of(spark, vectors)).collect()
    by_id = {r["vec_id"]: r["deviation"] for r in found}
    xs = [[math.floor(256 * c) for c in v] for v in vectors]
    n, sums = len(set(map(tuple, xs))), [sum(c) for c in zip(*set(map(tuple, xs)))]
    for i, x in enumerate(xs):
        exact = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert by_id[i] == (exact if exact < 2**63 else None)
    vectors[0][0] = 2.0**40
    assert {r["vec_id"]: r["deviation"] for r in whitening.whitened(table_of(spark, vectors)).collect()}[0] is None


def matrices():
    draw = np.random.default_rng(4)
    q = lambda d: np.linalg.qr(draw.standard_normal((d, d)))[0]
    yield draw.standard_normal((12, 12))
    yield np.diag([3.0, 3.0, 3.0, 1.0, 0.0])
    yield q(8) @ np.diag([4.0, 4.0, 4.0, 2.0, 2.0, 1.0, 1e-9, 0.0]) @ q(8)
    yield q(6) @ np.diag([1.0, 1 - 1e-9, 1 - 2e-9, 0.5, 1e-12, 1e-15]) @ q(6)
    yield np.diag(10.0 ** -np.arange(20.0)) @ np.triu(np.ones((20, 20)))
    yield np.diag(np.ones(64)) + np.diag(np.ones(63), 1)
    yield q(64) @ np.diag(np.linspace(1, 2, 64)) @ q(64)
    yield np.ones((5, 5))
    yield np.array([[2.0]])
    yield np.zeros((3, 3))


@pytest.mark.parametrize("number", range(10))
def test_directions(number):
    a = list(matrices())[number]
    d = a.shape[1]
    r = np.linalg.qr(a, mode="r")
    values, vectors = whitening.directions(r, 4)
    true = np.linalg.svd(a, compute_uv=False) ** 2
    assert len(values) <= 4 and np.allclose(values, true[: len(values)], rtol=1e-12, atol=0)
    assert all(v <= true[0] * 1e-24 for v in true[len(values) : 4])
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    residual = a.T @ (a @ vectors) - vectors * values
    assert np.abs(residual).max(initial=0) <= 1e-13 * max(true[0], 1e-300) * d


def test_small_singular_values_are_accurate():
    diagonal, above = np.array([1.0, 1e-8, 1e-16, 1e-4]), np.array([1e-3, 1e-9, 1e-20])
    from fractions import Fraction

    values = whitening.squared_singular_values(diagonal, above)
    product = math.prod(Fraction(x) ** 2 for x in diagonal)
    found = math.prod(Fraction(v) for v in values)
    assert abs(float(found / product) - 1) < 1e-12
