import math
import random
from fractions import Fraction

import numpy as np
import pytest

from jobloom.llm import whitening
from jobloom.llm.whitening import _gram, characteristic, null_vectors, principal, root, roots_above, squarefree

SCHEMA = "vec_id long, embedding array<double>, label int, v int, w string, n long"


def faddeev(matrix):
    """Coefficients of the characteristic polynomial by traces of powers, in fractions."""
    size, out = len(matrix), [Fraction(1)]
    power = [[Fraction(0)] * size for _ in range(size)]
    for k in range(1, size + 1):
        moved = [[x + (out[-1] if i == j else 0) for j, x in enumerate(row)] for i, row in enumerate(power)]
        power = [[sum(matrix[i][m] * moved[m][j] for m in range(size)) for j in range(size)] for i in range(size)]
        out.append(-sum(power[i][i] for i in range(size)) / k)
    return [int(c) for c in out[::-1]]


def scatter_of(draw, size, rows):
    x = [[draw.randint(-9, 9) for _ in range(size)] for _ in range(rows)]
    return [[sum(r[i] * r[j] for r in x) for j in range(size)] for i in range(size)]


def hadamard(power):
    h = [[1]]
    for _ in range(power):
        h = [row + row for row in h] + [row + [-x for x in row] for row in h]
    return h


def test_polynomial_against_traces_of_powers(spark):
    draw = random.Random(4)
    for size in (1, 2, 3, 6):
        for rows in (1, 2, 9):  # few rows: singular
            matrix = scatter_of(draw, size, rows)
            assert characteristic(spark, matrix) == faddeev(matrix)
    blocks = [[0, 0, 0, 2], [0, 0, 0, 0], [0, 0, 5, 0], [2, 0, 0, 7]]  # needs pivots
    shifted = [[x + 3 * (i == j) for j, x in enumerate(row)] for i, row in enumerate(blocks)]
    assert characteristic(spark, shifted) == faddeev(shifted)


def times(a, b):
    out = [0] * (len(a) + len(b) - 1)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            out[i + j] += x * y
    return out


def test_roots_are_counted_and_isolated():
    given = [0, 0, 3, 3, 3, 8, 1000, 1001]
    poly = [1]
    for value in given:
        poly = times(poly, [-value, 1])
    simple = squarefree(poly)
    assert len(simple) == 6 and simple[-1] == 1
    for at in (-1, 0, 2, 3, 7, 8, 1000, 2000):
        assert roots_above(poly, at * 4, 2) == sum(value > at for value in given)
    for k, value in enumerate(sorted(given, reverse=True), 1):
        place, bits, count, number = root(poly, simple, k, 5000, 40)
        assert abs(Fraction(place, 1 << bits) - value) <= Fraction(1, 1 << bits)
        assert count == given.count(value) and 1 <= number <= count
    irrational = times(times([-2, 0, 1], [-2, 0, 1]), [1, -3, 1])
    shifted = [0] * 7  # roots must not be negative: x + 5
    for i, c in enumerate(irrational):
        term = [c]
        for _ in range(i):
            term = times(term, [-5, 1])
        shifted = [a + b for a, b in zip(shifted, term + [0] * (7 - len(term)))]
    place, bits, count, _ = root(shifted, squarefree(shifted), 2, 50, 80)
    assert count == 2 and abs(place / (1 << bits) - 5 - math.sqrt(2)) < 1e-15


def test_components_of_all_but_equal_eigenvalues(spark):
    """Eigenvalues that agree to 15 digits: their eigenvectors are known, and found to double precision."""
    h = hadamard(3)
    values = [10**15 + 3, 10**15 + 2, 10**15, 10**15 - 1, 77, 76, 1, 0]
    matrix = [[sum(d * h[i][k] * h[j][k] for k, d in enumerate(values)) for j in range(8)] for i in range(8)]
    found, shares, vectors = principal(spark, matrix, 8)
    assert found == [8.0 * v for v in values]
    assert np.allclose(shares, np.array(values) / sum(values), rtol=1e-15, atol=0)
    for k in range(8):
        exact = np.array([h[i][k] for i in range(8)]) / math.sqrt(8)
        assert np.abs(np.abs(vectors[k]) - np.abs(exact)).max() < 1e-15 and abs(abs(vectors[k] @ exact) - 1) < 1e-15


def test_equal_eigenvalues_give_an_orthonormal_basis(spark):
    h = hadamard(2)
    matrix = [[sum(d * h[i][k] * h[j][k] for k, d in enumerate([5, 5, 5, 2])) for j in range(4)] for i in range(4)]
    values, _, vectors = principal(spark, matrix, 4)
    assert values == [20.0, 20.0, 20.0, 8.0]
    assert np.abs(vectors @ vectors.T - np.eye(4)).max() < 1e-15
    assert np.abs(np.array(matrix) @ vectors.T - vectors.T * values).max() < 1e-14
    assert null_vectors([[0, 0], [0, 0]], 0, 0, 2, 60) == [[1 << 60, 0], [0, 1 << 60]]


def test_products_are_exact():
    draw = np.random.default_rng(1)
    for most in (3, 1 << 20, 1 << 40, (1 << 62) - 1):
        y = draw.integers(-most, most, (50, 4))
        plain = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(4)] for i in range(4)]
        assert _gram(y).tolist() == plain and _gram(y.astype(object)).tolist() == plain


def exact(rows):
    """(n, {vec_id and vector: deviation}, x-vectors as fractions off their mean) of vectors of one length."""
    x = [[math.floor(Fraction(c) * 1024) + 100_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    return n, [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x], np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in x])


def check(spark, rows, bad=()):
    frame = spark.createDataFrame([(i, v, 1, 5, "own", 3) for i, v in [*rows, *bad]], SCHEMA).repartition(3)
    found = whitening.whiten(frame).collect()
    n, deviations, centred = exact(rows)
    wide = centred.shape[1]
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, most = values[::-1], min(8, wide)
    assert len(found) == n * most and {r["n"] for r in found} == {n}
    assert sorted((r["vec_id"] or -1, r["deviation"]) for r in found if r["component"] == 1) == sorted((i or -1, d) for (i, _), d in zip(rows, deviations))
    full = [k for k in range(most) if values[k] > 1e-9 * max(values[0], 1e-300)]
    for k in range(most):
        own = [r for r in found if r["component"] == k + 1]
        if k in full:
            assert all(abs(r["explained"] - values[k] / values.sum()) < 1e-9 for r in own)
            assert abs(np.var([r["whitened"] for r in own]) - 1) < 1e-9
        else:
            assert all(r["whitened"] is None and r["explained"] in (None, 0.0) for r in own)
    errors = {r["identity_error"] for r in found}
    assert len(errors) == 1 and (errors == {None} if not full else max(errors) < 1e-9)
    gaps = [k for k in full if all(abs(values[k] - values[j]) > 1e-3 * values[0] for j in range(wide) if j != k)]
    for k in gaps:
        plain = centred @ vectors[:, ::-1][:, k] / math.sqrt(values[k])
        got = sorted((r["vec_id"] or -1, r["whitened"]) for r in found if r["component"] == k + 1)
        assert any(np.allclose(sorted(((i or -1), s * w) for (i, _), w in zip(rows, plain)), got, atol=1e-8) for s in (1, -1))
    return found


def test_rows_against_a_plain_decomposition(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 1 + k) for k in range(11)]) for i in range(150)]
    check(spark, rows + [(3, rows[5][1])] * 30 + [(None, rows[7][1])])
    check(spark, [(i, [draw.gauss(0, 3), draw.gauss(5, 1)]) for i in range(40)])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, [1.0, None, 2.0]), (3, [nan, 0.0, 0.0]), (4, [0.0, -inf, 0.0]), (6, [])]
    draw = random.Random(7)
    # A component that never varies, and two that are the same.
    rows = [(i, [2.5, x := draw.gauss(0, 1), x]) for i in range(20, 50)]
    check(spark, rows, bad)
    check(spark, [(9, [1.5, 2.5, 0.0])], bad)
    check(spark, [(i, [1.0 * (i % 2), 1.0 * (i // 2 % 2), 1.0 * (i // 4)]) for i in range(8)])  # equal eigenvalues
    empty = spark.createDataFrame([(i, v, 1, 5, "own", 3) for i, v in bad], SCHEMA)
    assert whitening.whiten(empty).collect() == [] and whitening.whiten(empty.limit(0)).collect() == []


def test_large_components(spark):
    """Beyond what doubles can separate: deviations stay exact, and small components are still found."""
    rows = [(i, [2.0**40 * i, i * i / 7, 1e-300]) for i in range(12)]
    frame = lambda rows: spark.createDataFrame([(i, v, 1, 5, "own", 3) for i, v in rows], SCHEMA)
    found = whitening.whiten(frame(rows)).collect()
    _, deviations, _ = exact(rows)
    assert sorted({(r["vec_id"], r["deviation"]) for r in found}) == list(enumerate(deviations))
    assert {r["whitened"] is None for r in found if r["component"] == 3} == {True}
    assert max(r["identity_error"] for r in found) < 1e-4 and all(r["whitened"] is not None for r in found if r["component"] < 3)
    with pytest.raises(Exception, match="does not fit a long"):
        whitening.whiten(frame([(1, [2.0**60]), (2, [1.0])])).collect()


def test_lengths_are_fitted_on_their_own(spark):
    rows = [(i, [i / 3, -i * i / 7]) for i in range(9)]
    frame = spark.createDataFrame([(i, v, 1, 5, "own", 3) for i, v in [*rows, (50, [1.0]), (51, [2.0])]], SCHEMA)
    found = whitening.whiten(frame).collect()
    assert {(r["vec_id"] >= 50, r["n"]) for r in found} == {(False, 9), (True, 2)} and len(found) == 9 * 2 + 2
