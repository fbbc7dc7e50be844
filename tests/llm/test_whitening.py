"""Whitening: exact polynomials and roots, components against numpy, rows against exact fractions."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from siftline.llm import whitening
from siftline.llm.whitening import Roots, characteristic_modulo

SF_DIR = "/root/testdata/sf0.01"


def faddeev(matrix):
    """det(x - matrix) in fractions, highest power first."""
    n, c, m = len(matrix), [Fraction(1)], [[Fraction(0)] * len(matrix) for _ in matrix]
    for k in range(1, n + 1):
        m = [[sum(matrix[i][t] * m[t][j] for t in range(n)) + (c[-1] if i == j else 0) for j in range(n)] for i in range(n)]
        trace = sum(sum(matrix[i][t] * m[t][i] for t in range(n)) for i in range(n))
        c.append(-Fraction(trace, k))
    return [int(x) for x in c]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6).flatmap(lambda n: st.lists(st.lists(st.integers(-9, 9), min_size=n, max_size=n), min_size=n, max_size=n)))
def test_polynomial_modulo_a_prime(rows):
    p = 2_147_483_647
    assert characteristic_modulo(np.array(rows, np.int64) % p, p).tolist() == [c % p for c in faddeev(rows)]


def test_polynomial_from_many_primes(spark):
    x = np.random.default_rng(1).integers(-10**9, 10**9, (7, 5)).astype(object)
    matrix = x.T @ x
    assert whitening.characteristic(spark, matrix) == faddeev(matrix.tolist())


@pytest.mark.parametrize("roots", [[5], [9, 4, 1, 0], [7, 7, 7, 2], [3, 3, 0, 0], [10**30, 10**30 - 1, 5], [0, 0]])
def test_roots(roots):
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([*poly, 0], [0, *poly], strict=True)]
    found = Roots(poly)
    for rank, r in enumerate(sorted(roots, reverse=True), 1):
        m, bits = found.root(rank)
        if r == 0:
            assert (m, bits) == (0, 0)
        else:
            assert m < r << bits <= m + 1 and m.bit_length() >= whitening.ROOT_BITS


def rows_of(df):
    return sorted(df.collect(), key=lambda r: (r.vec_id, r.component))


def test_query_matches_numpy(spark):
    found = rows_of(contract.queries()["op11_whitening"](spark, SF_DIR))
    given = sorted(spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    x = np.floor(256 * np.array([r.embedding for r in given], float)).astype(np.int64)
    unique = np.unique(x, axis=0)
    n, s = len(unique), unique.sum(0)
    values, vectors = np.linalg.eigh(np.cov(unique.T.astype(float), bias=True))
    assert len(found) == 4 * len(x)
    w = np.array([r.whitened for r in found]).reshape(-1, 4)
    for k in range(4):
        expected = (x - s / n) @ vectors[:, -1 - k] / math.sqrt(values[-1 - k])
        sign = np.sign(expected[0] * w[0, k])
        assert np.abs(sign * w[:, k] - expected).max() < 1e-9
    deviation = [int(d) for d in ((n * x.astype(object) - s) ** 2).sum(1)]
    assert [r.deviation for r in found[::4]] == deviation
    assert [r.component for r in found[:4]] == [1, 2, 3, 4] and {r.n for r in found} == {n}
    assert np.allclose([r.explained for r in found[:4]], values[::-1][:4] / values.sum(), rtol=1e-12)
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-12


def test_components_of_close_eigenvalues(spark):
    # Two eigenvalues that differ by one part in 10**12: doubles alone would mix their components.
    matrix = np.diag([10**15, 10**15 + 1000, 7, 3]).astype(object)
    matrix[0, 2] = matrix[2, 0] = 1
    values, vectors = whitening._eigen(spark, matrix, 3)
    assert np.allclose(np.abs(vectors[0]), [0, 1, 0, 0], atol=1e-15)
    assert np.allclose(np.abs(vectors[1]), [1, 0, 1e-15, 0], atol=1e-16)
    assert float(values[0]) == 10**15 + 1000


def test_repeated_eigenvalues(spark):
    rows = [(i, [float(a), float(b), float(c)]) for i, (a, b, c) in enumerate(np.vstack((np.eye(3), -np.eye(3))))]
    found = rows_of(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding"))
    assert len(found) == 18 and max(r.identity_error for r in found) < 1e-12
    assert [r.explained for r in found[:3]] == pytest.approx([1 / 3] * 3)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<float>, v int, n int, whitened string, component int"
    rows = [
        (1, [0.5, 1.0], 1, 1, "a", 1), (1, [0.5, 1.0], 1, 1, "a", 1), (None, [0.25], 1, 1, None, 1), (2, [0.0, -0.0], 1, 1, "b", 1),
        (3, None, 1, 1, "c", 1), (4, [nan, 1.0], 1, 1, "d", 1), (5, [inf, 1.0], 1, 1, "e", 1), (6, [None, 1.0], 1, 1, "f", 1), (7, [], 1, 1, "g", 1),
    ]
    df = spark.createDataFrame(rows, schema)
    found = whitening.whiten(df, "vec_id", "embedding").collect()
    # The fit list: (128, 256), (64, 0), (0, 0); two components.
    assert sorted((r.vec_id or -1, r.component) for r in found) == sorted([(i, c) for i in (1, 1, -1, 2, 7) for c in (1, 2)])
    assert {r.n for r in found} == {3} and {r.deviation for r in found if r.vec_id == 2} == {192**2 + 256**2}
    w = {(r.vec_id, r.component): r.whitened for r in found}
    assert w[2, 1] == w[7, 1] and w[2, 2] == w[7, 2]
    assert whitening.whiten(df.limit(0), "vec_id", "embedding").count() == 0
    assert whitening.whiten(df.where("vec_id = 1"), "vec_id", "embedding").count() == 0


def test_huge_entries(spark):
    rows = [(i, [1e17 * a, b]) for i, (a, b) in enumerate([(1.0, 2.0), (-1.0, 2.0), (0.5, 3.0), (1e30, 1.0)])]
    found = rows_of(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding"))
    x = [[min(max(math.floor(256 * v), -(2**63)), 2**63 - 1) for v in r[1]] for r in rows]
    s = [sum(c) for c in zip(*x, strict=True)]
    exact = [sum((4 * v - t) ** 2 for v, t in zip(r, s, strict=True)) for r in x]
    assert [r.deviation for r in found[::2]] == [d if d < 2**63 else None for d in exact]
    assert found[0].identity_error < 1e-4
