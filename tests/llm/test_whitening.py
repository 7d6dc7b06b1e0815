"""Whitening against numpy's eigenvectors, exact fractions and small polynomials."""

import math
from fractions import Fraction

import numpy as np
import pytest

from ridestat.llm import whitening


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "s") for i, v in vectors], "vec_id long, embedding array<float>, y string")


def brute(vectors):
    """vec_id -> (deviation, whitened by numpy up to signs), explained."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in vectors], object)
    n, total = len(x), x.sum(0)
    away = n * x - total
    cov = (away.T @ away) / Fraction(n**3)
    e, u = np.linalg.eigh(cov.astype(float))
    e, u = e[::-1], u[:, ::-1]
    z = (away.astype(float) / n) @ u / np.sqrt(np.maximum(e, 1e-300))
    return [int((a * a).sum()) for a in away], z, e / e.sum()


def test_equals_numpy(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((400, 40)) * np.linspace(0.02, 0.4, 40) @ rng.standard_normal((40, 40)) / 6 + 3
    vectors = [(i % 390, [float(c) for c in v]) for i, v in enumerate(base)]
    odd = [(900, None), (901, [1.0, None] + [0.0] * 38), (902, [float("nan")] * 40), (903, [float("inf")] * 40), (904, [1.0]), (905, [])]
    got = whitening.whiten(frame(spark, vectors + odd)).collect()
    deviation, z, explained = brute(vectors)
    assert len(got) == 400 * 32 and {r["vec_id"] for r in got} == set(range(390))
    assert {r["n"] for r in got} == {400} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-9
    want = {}
    for (i, _), d in zip(vectors, deviation, strict=True):
        want.setdefault(i, set()).add(d)
    assert all(int(r["deviation"]) in want[r["vec_id"]] for r in got)
    first = {(r["vec_id"], r["component"]): r for r in got if 10 <= r["vec_id"] < 390}
    for c in range(32):
        mine = np.array([first[i, c + 1]["whitened"] for i in range(10, 390)])
        theirs = z[10:390, c]
        assert np.abs(mine - np.sign(mine @ theirs) * theirs).max() < 1e-8
        assert first[10, c + 1]["explained"] == pytest.approx(explained[c], rel=1e-9)


def test_low_rank_equal_roots_and_empty(spark):
    cross = [(i, [float(s * (k == j)) for k in range(5)] + [7.0]) for i, (j, s) in enumerate((j, s) for j in range(4) for s in (-1, 1))]
    got = whitening.whiten(frame(spark, cross)).collect()  # four equal roots, two zeros
    assert {r["component"] for r in got} == {1, 2, 3, 4}
    assert all(r["explained"] == pytest.approx(0.25) for r in got)
    z = np.zeros((8, 4))
    for r in got:
        z[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert np.abs(np.cov(z.T, bias=True) - np.eye(4)).max() < 1e-12
    assert whitening.whiten(frame(spark, cross[:1] * 3)).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_large_entries_and_sums():
    y = np.array([[2**55, -(2**54), 3], [-(2**55) + 1, 5, -1], [0, 0, 2**40]] * 5000, np.int64)
    want = np.zeros((4, 4), object)
    for row in y[:3]:
        v = np.array([1, *row.tolist()], object)
        want += np.outer(v, v) * 5000
    assert (whitening.product_sums(y) == want).all()


def test_polynomial_and_roots(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(-9, 9, (7, 7)).astype(object)
    a = a.T @ a
    got = whitening.characteristic_polynomial(spark, a)
    want = np.round(np.poly(a.astype(float))[::-1]).astype(np.int64)
    assert got[-3:] == [int(x) for x in want[-3:]]
    assert abs(got[0]) == pytest.approx(abs(np.linalg.det(a.astype(float))), rel=1e-9)
    p = whitening.primes(3)
    assert p == [1073741789, 1073741783, 1073741741]
    roots = [2, 3, 3, 3, 10, 1000]
    f = [1]
    for r in roots:
        f = [(f[k - 1] if k else 0) - r * (f[k] if k < len(f) else 0) for k in range(len(f) + 1)]
    for rank, r in enumerate(sorted(roots, reverse=True), 1):
        m, s = whitening.root(f, rank, sum(roots))
        assert abs(Fraction(m, 1 << s) - r) <= Fraction(1, 1 << 60)
    assert whitening.clusters([(1000, 0), (10, 0), (3, 0), (3, 0), (2, 0)]) == [[0], [1], [2, 3], [4]]
