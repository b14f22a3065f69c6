import random
from fractions import Fraction
from math import prod

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilealg.llm import whitening

VEC = "vec_id long, embedding array<double>"


def brute(rows, count=4, scale=256):
    """(vec_id, deviation, whitened by component up to sign) with numpy's symmetric solver."""
    ok = [(i, np.floor(scale * np.array(v, float)).astype(np.int64)) for i, v in rows
          if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    fit = np.array(sorted({tuple(x) for _, x in ok}))
    n, s = len(fit), fit.sum(axis=0)
    e, u = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    e, u = e[::-1][:count], u[:, ::-1][:, :count]
    return n, [(i, int(((n * x - s) ** 2).sum()), (x - s / n) @ u / np.sqrt(e)) for i, x in ok], e / np.trace(
        np.cov(fit.T.astype(float), bias=True))


def compare(spark, df, rows, count=4):
    got = whitening.whiten(spark, df, count=count).orderBy("vec_id", "component").collect()
    n, want, shares = brute(rows, count)
    assert len(got) == len(want) * count
    assert {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    a = np.array([[r["whitened"] for r in by_id[i][:count]] for i, _, _ in want])
    b = np.array([w for _, _, w in want])
    signs = np.sign((a * b).sum(axis=0))
    np.testing.assert_allclose(a * signs, b, atol=1e-7)
    assert [by_id[i][0]["deviation"] for i, _, _ in want] == [d for _, d, _ in want]
    np.testing.assert_allclose([r["explained"] for r in got[:count]], shares, rtol=1e-9)


@pytest.mark.parametrize("dim,n", [(4, 9), (7, 300), (24, 120), (64, 200)])
def test_equals_a_symmetric_solver(spark, dim, n):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(n, dim)) * rng.uniform(0.2, 2, dim)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    compare(spark, spark.createDataFrame(rows, VEC).repartition(3), rows)


def test_dirty_rows_copies_and_extra_columns(spark, clashing):
    rng = np.random.default_rng(5)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(60, 6)))]
    rows += [(100 + k, rows[0][1]) for k in range(40)]  # copies do not weigh more
    dirty = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6),
             (203, [0.0, 0.0, float("inf"), 0.0, 0.0, 0.0]), (204, []), (205, [1.0, 2.0])]
    df = clashing(spark.createDataFrame(rows + dirty, VEC)).select("*", F.lit(1).alias("x"), F.lit(1).alias("component"))
    compare(spark, df, rows)


def test_large_entries_are_exact(spark):
    """Entries of up to 2^40: products go beyond 64 bits, a deviation may too."""
    rng = random.Random(3)
    rows = [(k, [rng.randint(-2**32, 2**32) + 0.0, rng.random(), -rng.random() * 2**20]) for k in range(40)]
    got = whitening.whiten(spark, spark.createDataFrame(rows, VEC), count=3).collect()
    fit = [[int(np.floor(256 * c)) for c in v] for _, v in rows]
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    want = {k: sum((n * c - t) ** 2 for c, t in zip(x, s)) for k, x in enumerate(fit)}
    assert {r["vec_id"]: r["deviation"] for r in got} == {k: v if v < 2**63 else None for k, v in want.items()}
    assert got[0]["identity_error"] < 1e-9


def test_directions_without_variance_and_equal_roots(spark):
    """Corners of a square: two equal roots, a third direction is constant."""
    rows = [(k, [float(k & 1), float(k >> 1), 7.0]) for k in range(4)] + [(9, [0.0, 0.0, 7.0])]
    got = whitening.whiten(spark, spark.createDataFrame(rows, VEC)).collect()
    assert sorted({r["component"] for r in got}) == [1, 2]
    assert all(abs(r["explained"] - 0.5) < 1e-12 and r["identity_error"] < 1e-12 for r in got)
    assert len(got) == 10


def test_tables_without_components(spark):
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark, spark.createDataFrame(rows, VEC)).collect() == []


@pytest.mark.parametrize("d", [1, 2, 3, 8])
def test_polynomial_is_exact(spark, d):
    """det(t I - C) at d + 1 points, with fractions."""
    rng = random.Random(d)
    b = [[rng.randint(-10**6, 10**6) for _ in range(d)] for _ in range(d + 1)]
    if d == 8:
        b = [r[:4] + r[:4] for r in b]  # rank 4: pivots vanish
    c = [[sum(r[i] * r[j] for r in b) for j in range(d)] for i in range(d)]
    poly = whitening.characteristic(spark, c)
    assert len(poly) == d + 1 and poly[-1] == 1

    def det(m):
        m, sign = [[Fraction(v) for v in row] for row in m], 1
        for k in range(len(m)):
            p = next((r for r in range(k, len(m)) if m[r][k]), None)
            if p is None:
                return 0
            if p != k:
                m[k], m[p], sign = m[p], m[k], -sign
            for r in range(k + 1, len(m)):
                f = m[r][k] / m[k][k]
                m[r] = [x - f * y for x, y in zip(m[r], m[k])]
        return sign * prod(m[k][k] for k in range(len(m)))
    for t in range(-1, d):
        assert sum(a * t**k for k, a in enumerate(poly)) == det(
            [[(t if i == j else 0) - c[i][j] for j in range(d)] for i in range(d)])


def test_roots_are_counted_with_multiplicity():
    poly = [1]
    for root in (2, 2, 2, 5, 11, 11, 40):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    for num, count in ((0, 7), (1, 7), (2, 4), (4, 4), (5, 3), (10, 3), (11, 1), (39, 1), (40, 0)):
        assert whitening.roots_above(poly, num, 0) == count
    assert whitening.roots_above(poly, 23, 1) == 1  # 11.5
    found = whitening.largest_roots(poly, 73, 4)
    assert [t for _, t in found] == [1, 2, 1]
