import math
from fractions import Fraction

import numpy as np
import pytest

from gaugework.llm import whitening


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n", 0.5) for i, v in rows], "vec_id long, embedding array<float>, x int, component string, n double")


def by_hand(rows, k=4):
    """n, sums, covariance, eigenvalues and eigenvectors of the fit list by numpy."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in kept}), dtype=float)
    mean = x.mean(axis=0)
    values, vectors = np.linalg.eigh((x - mean).T @ (x - mean) / len(x))
    return kept, len(x), x.sum(axis=0), values[::-1][:k], vectors[:, ::-1][:, :k], values.sum()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(400, 9)) @ rng.normal(size=(9, 9)) / 3
    found = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    found += [(1000 + i, v) for i, v in found[:50]] + [(3, found[3][1]), (None, found[4][1])]  # copies and repeated rows
    return found + [(2000, None), (2001, []), (2002, [None] * 9), (2003, [1.0] * 8 + [float("nan")]), (2004, [float("inf")] + [0.0] * 8)]


def test_against_numpy(spark, rows):
    found = whitening.fit_and_whiten(table(spark, rows)).collect()
    kept, n, total, values, vectors, trace = by_hand(rows)
    assert len(found) == 4 * len(kept)
    of_id = {}
    for r in found:
        of_id.setdefault(r["id"], {})[r["component"]] = r
    white = {i: (np.array(v) - total / n) @ vectors / np.sqrt(values) for i, v in kept}
    signs = np.sign([of_id[0][c + 1]["whitened"] * white[0][c] for c in range(4)])
    for i, v in kept:
        for c in range(4):
            r = of_id[i][c + 1]
            assert r["n"] == n and r["deviation"] == sum((n * a - int(s)) ** 2 for a, s in zip(v, total))
            assert r["whitened"] == pytest.approx(signs[c] * white[i][c], abs=1e-8)
            assert r["explained"] == pytest.approx(values[c] / trace, rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_polynomial_is_exact(spark):
    rng = np.random.default_rng(0)
    a = rng.integers(-50, 50, (7, 5))
    matrix = [[int(v) for v in row] for row in a.T @ a]
    want = [0] * 5 + [1]  # Faddeev-LeVerrier in integers
    m = [[0] * 5 for _ in range(5)]
    for k in range(1, 6):
        m = [[sum(matrix[i][l] * m[l][j] for l in range(5)) + (want[6 - k] if i == j else 0) for j in range(5)] for i in range(5)]
        want[5 - k] = -sum(matrix[i][l] * m[l][i] for i in range(5) for l in range(5)) // k
    assert whitening.characteristic_polynomial(spark.range(1), matrix) == want
    for p in (2, 3, 2_147_483_647):
        assert whitening.polynomial_modulo(np.array(matrix), p).tolist() == [c % p for c in want]


def poly_of(roots):
    out = [1]
    for r in roots:
        out = [(out[i - 1] if i else 0) - r * (out[i] if i < len(out) else 0) for i in range(len(out) + 1)]
    return out


@pytest.mark.parametrize("roots", [[9, 5, 5, 5, 2, 0], [7, 7], [0, 0, 0], [10**30 + 1, 10**30, 3], [4, 3, 2, 1], [10**12] * 3 + [10**12 - 1]])
def test_roots(roots):
    found = whitening.largest_roots(poly_of(roots), 4)
    want = sorted((r for r in roots if r), reverse=True)
    got = [v for v, size in found for _ in range(size)]
    assert len(got) >= min(4, len(want))
    assert all(abs(a - b) <= Fraction(max(sum(roots), 1), 1 << 200) for a, b in zip(got, want))
    assert [size for _, size in found] == [want.count(r) for r in dict.fromkeys(want)][:len(found)]


def test_equal_eigenvalues_get_an_orthonormal_basis(spark):
    rows = [(i, [float(c) for c in s * np.eye(6)[k]]) for i, (k, s) in enumerate((k, s) for k in range(6) for s in (1, -1))]
    found = whitening.fit_and_whiten(table(spark, rows)).collect()
    assert len(found) == 4 * 12 and all(r["identity_error"] < 1e-12 and r["explained"] == pytest.approx(1 / 6) for r in found)


def test_few_or_no_vectors(spark):
    empty = whitening.fit_and_whiten(table(spark, []))
    assert empty.count() == 0 and {"id", "component", "n", "deviation", "whitened", "explained", "identity_error"} == set(empty.columns)
    assert whitening.fit_and_whiten(table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.fit_and_whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    two = whitening.fit_and_whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1.0]), (4, [5.0])])).collect()
    assert sorted((r["id"], r["component"], abs(r["whitened"])) for r in two) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_huge_coordinates(spark):
    big = [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1e9, 2.0]), (4, [0.0, -5e8])]
    found = whitening.fit_and_whiten(table(spark, big)).collect()
    assert {r["component"] for r in found} == {1, 2} and all(r["identity_error"] < 1e-4 and math.isfinite(r["whitened"]) for r in found)
    assert all(r["deviation"] is None for r in found)
