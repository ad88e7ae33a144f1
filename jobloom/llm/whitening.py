"""Whitening of vectors along exact principal components (operator 13).

1. Components become whole numbers x; their count and sums give a whole-number centre, and the
   scatter n * sum((x - S/n)(x - S/n)') is a matrix of whole numbers without any rounding.
2. The scatter's characteristic polynomial is worked out exactly: modulo many primes by
   reduction to Hessenberg form, a Spark task per few primes, joined by Chinese remainders.
3. A symmetric matrix has real eigenvalues only, so the sign changes of the polynomial shifted
   to a place count the eigenvalues above it exactly. Bisection isolates the k-th largest one,
   until it is much narrower than the distance to its neighbours; multiplicities are exact.
4. A component is the null vector of (scatter - eigenvalue), by inverse iteration in fixed-point
   numbers of several hundred bits; its residual is checked before it is rounded to doubles.
   A Spark task finds a component.
5. Rows are centred, projected and scaled where they lie.

The rows are never brought together: tasks send sums whose size depends on the vector length
alone. The driver holds those sums, the polynomial and the components.

Defined cases: vectors that are null or hold a null or a non-finite component are dropped; repeated
rows and ids count each; vectors of each length are fitted on their own, empty vectors are dropped;
equal eigenvalues share one exact null space, of which any orthonormal basis will do (the same one
for all rows); along a component without variance nothing can be scaled, so `whitened` is null,
`explained` is 0 (null if no component has variance), and such components are left out of
`identity_error` (null if none is left); an empty table gives no rows; further columns are
ignored. A component whose whole number does not fit a long is an error.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.llm.exact import by_length, finite_vectors, floored, json_row, partial_sums, stored, totals

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
_CHUNK = 4096
_LONG = 1 << 63
_SURE = 64  # bits by which a component's error lies below its size


# ---- whole numbers of each row ---------------------------------------------------------------


def _chunks(batch: pa.RecordBatch, length: int, scale: int, shift: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of rows with their whole numbers as longs."""
    for at in range(0, len(batch), _CHUNK):
        part = batch.slice(at, _CHUNK)
        x = floored(part["v"], length, scale)
        if x.dtype == object:
            x = x + shift
            if max(map(abs, x.ravel())) >= _LONG:
                raise OverflowError("the whole number of a component does not fit a long")
            yield part, x.astype(np.int64)
        else:
            yield part, x.astype(np.int64) + shift


def _gram(y: np.ndarray) -> np.ndarray:
    """y'y in Python's whole numbers: products of doubles, split into digits so that no sum is rounded."""
    largest = int(np.abs(y).max(initial=0)) if len(y) else 0
    if largest * largest * len(y) < 1 << 53:
        wide = y.astype(np.float64)
        return np.frompyfunc(int, 1, 1)(wide.T @ wide)
    bits = (53 - max(len(y), 2).bit_length()) // 2 - 1
    digits, rest, total = [], y.astype(object) if largest >= _LONG else y, 0
    while len(digits) * bits < largest.bit_length() + 1:
        digits.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    digits[-1] += rest.astype(np.float64) * float(1 << bits)  # -1 for negative numbers
    for i, a in enumerate(digits):
        for j, b in enumerate(digits):
            total = total + (np.frompyfunc(int, 1, 1)(a.T @ b) << (bits * (i + j)))
    return total


def _count_and_sums(length: int, scale: int, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
        total = np.zeros(1 + length, object)
        for batch in batches:
            for part, x in _chunks(batch, length, scale, shift):
                total[0] += len(part)
                low = x & ((1 << 31) - 1)  # halves, so that no sum of a slice leaves a long
                total[1:] += low.sum(0).astype(object) + ((x >> 31).sum(0).astype(object) << 31)
        yield json_row(0, total.tolist())

    return run


def _centred_products(length: int, scale: int, shift: int, centre: list[int]):
    """A JSON row per row of the upper triangle of sum((x - centre)(x - centre)')."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
        total, at = np.zeros((length, length), object), np.array(centre, np.int64)
        for batch in batches:
            for _, x in _chunks(batch, length, scale, shift):
                total = total + _gram(_minus(x, at))
        for i in range(length):
            yield json_row(i, total[i, i:].tolist())

    return run


def _minus(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    small = max(int(np.abs(centre).max()), max(abs(int(x.min())), abs(int(x.max())))) < 1 << 62 if x.size else True
    return x - centre if small else x.astype(object) - centre.astype(object)


def scatter(rows: DataFrame, length: int, scale: int = SCALE, shift: int = SHIFT) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums S, n * sum of centred products) of (v) rows of one length, exact."""
    n, *sums = totals(partial_sums(rows.select("v"), _count_and_sums(length, scale, shift)), 1)[0]
    centre = [total // n for total in sums]
    found = totals(partial_sums(rows.select("v"), _centred_products(length, scale, shift, centre)), length)
    rest = [total - n * c for total, c in zip(sums, centre, strict=True)]  # sums of x - centre
    upper = [[n * value - rest[i] * rest[i + j] for j, value in enumerate(found[i])] for i in range(length)]
    return n, sums, [[upper[min(i, j)][abs(i - j)] for j in range(length)] for i in range(length)]


# ---- characteristic polynomial ---------------------------------------------------------------


def primes(count: int) -> list[int]:
    """The largest primes below 2**31, in falling order."""
    sieve = np.ones(46_342, bool)
    sieve[:2] = False
    for i in range(2, 216):
        sieve[i * i :: i] &= not sieve[i]
    small, found, at = np.flatnonzero(sieve), [], (1 << 31) - 1
    while len(found) < count:
        if (at % small != 0).all():
            found.append(at)
        at -= 2
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients (constant first) of det(x - matrix) modulo a prime below 2**31, by Hessenberg form."""
    h, size = matrix.copy(), len(matrix)
    for m in range(1, size - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        share = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - share[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * share % p).sum(1)) % p
    parts = [np.ones(1, np.int64)]  # of the leading blocks
    for k in range(size):
        grown = np.zeros(k + 2, np.int64)
        grown[1:] = parts[k]
        grown[:-1] = (grown[:-1] - int(h[k, k]) * parts[k]) % p
        path = 1
        for i in range(k - 1, -1, -1):
            path = path * int(h[i + 1, i]) % p
            grown[: i + 1] = (grown[: i + 1] - int(h[i, k]) * path % p * parts[i]) % p
        parts.append(grown)
    return parts[-1].tolist()


def _spread(spark: SparkSession, count: int, work, schema: str) -> list:
    """`work(number)` for numbers below `count`, each in a task of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch["id"].to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([json.dumps(work(number))])], ["id", "found"])

    found = spark.range(0, count, 1, max(count, 1)).mapInArrow(run, schema).collect()
    return [json.loads(row["found"]) for row in sorted(found, key=lambda row: row["id"])]


_PRIMES_A_TASK = 16


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients (constant first) of det(x - matrix) of a symmetric matrix without negative eigenvalues."""
    size, trace = len(matrix), sum(row[i] for i, row in enumerate(matrix))
    # The coefficients together are at most (1 + trace / size) ** size.
    bits = size * (trace // size + 2).bit_length() + 2
    chosen = primes(bits // 30 + 1)

    def work(task: int) -> list[list[int]]:
        whole, out = np.array(matrix, object), []
        for p in chosen[task * _PRIMES_A_TASK : (task + 1) * _PRIMES_A_TASK]:
            out.append(polynomial_mod((whole % p).astype(np.int64), p))
        return out

    residues = [one for task in _spread(spark, -(-len(chosen) // _PRIMES_A_TASK), work, "id long, found string") for one in task]
    modulus = math.prod(chosen)
    weights = [modulus // p * pow(modulus // p % p, -1, p) for p in chosen]
    out = []
    for values in zip(*residues, strict=True):
        value = sum(w * r for w, r in zip(weights, values, strict=True)) % modulus
        out.append(value - modulus if 2 * value > modulus else value)
    return out


# ---- eigenvalues -----------------------------------------------------------------------------


def _content(poly: list[int]) -> list[int]:
    while len(poly) > 1 and not poly[-1]:
        poly = poly[:-1]
    shared = math.gcd(*poly) or 1
    return [c // (shared if poly[-1] > 0 else -shared) for c in poly]


def _remainder(a: list[int], b: list[int]) -> list[int]:
    """A multiple of the remainder of a by b, in whole numbers."""
    a = list(a)
    while len(a) >= len(b):
        lead, shift = a[-1], len(a) - len(b)
        a = [c * b[-1] for c in a]
        for i, c in enumerate(b):
            a[i + shift] -= lead * c
        a.pop()
        while len(a) > 1 and not a[-1]:
            a.pop()
        if len(a) == 1 and not a[0]:
            break
    return a


def _quotient(a: list[int], b: list[int]) -> list[int]:
    """a / b without remainder; b has no common factor in its coefficients."""
    a, out = list(a), []
    for shift in range(len(a) - len(b), -1, -1):
        factor = a[shift + len(b) - 1] // b[-1]
        out.append(factor)
        for i, c in enumerate(b):
            a[i + shift] -= factor * c
    return out[::-1]


def _distinct_modulo(poly: list[int], p: int) -> bool:
    """Whether the polynomial has no double root modulo p, which proves that it has none at all."""
    a, b = [c % p for c in poly], [i * c % p for i, c in enumerate(poly)][1:]
    while any(b):
        while not b[-1]:
            b.pop()
        back = pow(b[-1], -1, p)
        while len(a) >= len(b):
            lead, shift = a[-1] * back % p, len(a) - len(b)
            for i, c in enumerate(b):
                a[i + shift] = (a[i + shift] - lead * c) % p
            a.pop()
        a, b = b, a
    return len(a) == 1


def squarefree(poly: list[int]) -> list[int]:
    """The polynomial with each of its roots once."""
    if any(poly[-1] % p and _distinct_modulo(poly, p) for p in primes(4)):
        return poly
    a, b = _content(poly), _content([i * c for i, c in enumerate(poly)][1:] or [0])
    while any(b):
        a, b = b, _content(_remainder(a, b))
    return _quotient(_content(poly), a)


def roots_above(poly: list[int], place: int, bits: int) -> int:
    """How many roots of a polynomial with real roots only lie above place / 2**bits, repeats counted.

    The sign changes among the coefficients of the polynomial shifted to that place.
    """
    size = len(poly) - 1
    shifted = [c << (bits * (size - i)) for i, c in enumerate(poly)]
    for low in range(size):
        for i in range(size - 1, low - 1, -1):
            shifted[i] += place * shifted[i + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(poly: list[int], place: int, bits: int) -> int:
    value, size = 0, len(poly) - 1
    for i in range(size, -1, -1):
        value = value * place + (poly[i] << (bits * (size - i)))
    return (value > 0) - (value < 0)


def root(poly: list[int], simple: list[int], k: int, most: int, apart: int) -> tuple[int, int, int, int]:
    """The k-th largest root as (place, bits, multiplicity, number among its equals).

    The root lies within 2**-bits of place / 2**bits, and all others, and 0 if it is no root,
    at least 2**apart times as far away. `simple` is the polynomial with each root once; roots lie between 0 and `most`.
    """
    low, high, bits = -1, most, 0
    while roots_above(simple, low, bits) - roots_above(simple, high, bits) > 1:
        low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        if roots_above(poly, middle, bits) >= k:
            low = middle
        else:
            high = middle
    above = roots_above(poly, high, bits)
    count = roots_above(poly, low, bits) - above
    sign = _sign(simple, high, bits)
    while sign:  # until the place is exact, or known well enough
        for _ in range(apart):
            low, high, bits = 2 * low, 2 * high, bits + 1
            while high - low > 1:
                middle = (low + high) // 2
                found = _sign(simple, middle, bits)
                if not found:
                    return middle, bits, count, k - above
                low, high = (low, middle) if found == sign else (middle, high)
        far = 1 << apart
        if low > far and roots_above(simple, low - far, bits) - roots_above(simple, high + far, bits) == 1:
            break
    if not sign:
        # Exact; the bits only have to tell how far the others are.
        while roots_above(simple, (high << apart) - (1 << apart), bits + apart) - roots_above(simple, (high << apart) + (1 << apart), bits + apart) > 1:
            high, bits = high << apart, bits + apart
    return high, bits, count, k - above


# ---- components ------------------------------------------------------------------------------


def null_vectors(matrix: list[list[int]], place: int, bits: int, count: int, guard: int) -> list[list[int]]:
    """`count` orthonormal vectors v with (matrix - place / 2**bits) v near 0, in units of 2**-guard.

    Elimination with full pivoting leaves `count` pivots that are next to nothing; solving for
    the unit vectors of those pivots is inverse iteration from the start that suits them best.
    """
    size, one = len(matrix), 1 << guard
    work = np.array([[(x << bits) - (place if i == j else 0) for j, x in enumerate(row)] for i, row in enumerate(matrix)], object) * one
    order = list(range(size))
    for step in range(size - count):
        rest = np.abs(work[step:, step:])
        at = int(rest.argmax())
        r, c = step + at // (size - step), step + at % (size - step)
        work[[step, r]] = work[[r, step]]
        work[:, [step, c]] = work[:, [c, step]]
        order[step], order[c] = order[c], order[step]
        if not work[step, step]:
            break
        share = work[step + 1 :, step : step + 1] * work[step : step + 1, step:]
        work[step + 1 :, step:] -= share // work[step, step]
    basis: list[np.ndarray] = []
    for free in range(count):
        v = np.zeros(size, object)
        v[size - count + free] = one
        for i in range(size - count - 1, -1, -1):
            total = sum(work[i, i + 1 :] * v[i + 1 :])
            v[i] = -total // work[i, i] if work[i, i] else 0
        for _ in range(2):  # the second time for what rounding left
            for other in basis:
                v = v - other * (sum(v * other) >> guard) // one
        norm = math.isqrt(sum(v * v))
        basis.append(v * one // norm)
    out = []
    for v in basis:
        named = [0] * size
        for at, value in zip(order, v, strict=True):
            named[at] = int(value)
        out.append(named)
    return out


def _component(matrix: list[list[int]], poly: list[int], simple: list[int], k: int) -> dict:
    """The k-th component as {eigenvalue: [place, bits], vector: doubles}; its residual is checked."""
    trace = sum(row[i] for i, row in enumerate(matrix))
    apart, size = _SURE + 32, len(matrix)
    place, bits, count, number = root(poly, simple, k, trace, apart)
    guard = 4 * size + trace.bit_length() + bits + 2 * _SURE
    vector = np.array(null_vectors(matrix, place, bits, count, guard)[number - 1], object)
    whole = np.array(matrix, object)
    residual = max(abs(x) for x in whole.dot(vector) * (1 << bits) - place * vector)
    # |residual| <= 2**-_SURE times the distance to the other eigenvalues, 2**(apart - bits) at least.
    if residual > (size << (guard + apart - _SURE)):
        raise ArithmeticError(f"component {k} is not settled")
    chosen = 1 if vector[int(np.abs(vector).argmax())] > 0 else -1
    return {"place": place, "bits": bits, "vector": [chosen * int(x) / (1 << guard) for x in vector]}


def principal(spark: SparkSession, matrix: list[list[int]], components: int = COMPONENTS) -> tuple[list[float], list[float], np.ndarray]:
    """(eigenvalues, shares of the trace, unit eigenvectors as rows) of the largest eigenvalues, exact to double precision."""
    shared = math.gcd(*[x for row in matrix for x in row]) or 1
    small = [[x // shared for x in row] for row in matrix]
    poly = characteristic(spark, small)
    simple = squarefree(poly)
    count, trace = min(components, len(matrix)), sum(row[i] for i, row in enumerate(small))
    found = _spread(spark, count, lambda number: _component(small, poly, simple, number + 1), "id long, found string")
    values = [one["place"] * shared / (1 << one["bits"]) for one in found]
    shares = [one["place"] / (trace << one["bits"]) if trace else math.nan for one in found]
    return values, shares, np.array([one["vector"] for one in found])


# ---- rows ------------------------------------------------------------------------------------


def _whiten(length: int, scale: int, shift: int, n: int, sums: list[int], vectors: np.ndarray, spread: list[float]):
    """(vec_id, deviation in two longs, w): projections over the roots of the eigenvalues."""
    scaled = np.array([v / s if s else np.full(length, np.nan) for v, s in zip(vectors, spread, strict=True)]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _chunks(batch, length, scale, shift):
                most = n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in sums)
                if most * most * length < 1 << 62:
                    z = x * n - np.array(sums, np.int64)
                    low = (z * z).sum(1)
                    high = np.zeros(len(z), np.int64)
                else:
                    z = x.astype(object) * n - np.array(sums, object)
                    squares = (z * z).sum(1)
                    high, low = (squares >> 62).astype(np.int64), (squares & ((1 << 62) - 1)).astype(np.int64)
                w = (z.astype(np.float64) / n) @ scaled
                lists = pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [part["vec_id"], pa.array(high), pa.array(low), lists], ["vec_id", "high", "low", "w"]
                )

    return run


def whiten(
    vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error: a row per vector and component.

    `scale` is a power of two.
    """
    given = stored(finite_vectors(vectors, vector, vec_id=key), "vectors")
    spark, kind = given.sparkSession, given.schema["vec_id"].dataType.simpleString()
    out = spark.createDataFrame(
        [], f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    for length, rows in by_length(given).items():
        n, sums, matrix = scatter(rows, length, scale, shift)
        values, shares, found = principal(spark, matrix, components)
        spread = [math.sqrt(value) / n for value in values]
        work = _whiten(length, scale, shift, n, sums, found, spread)
        wide = stored(rows.mapInArrow(work, f"vec_id {kind}, high long, low long, w array<double>"), "whitened")
        error = identity_error(wide, [i for i, s in enumerate(spread) if s])
        share = F.array(*[F.lit(None if math.isnan(s) else s).cast("double") for s in shares])
        deviation = (F.col("high").cast("decimal(38,0)") * F.lit(1 << 62).cast("decimal(19,0)") + F.col("low")).cast("decimal(38,0)")
        whitened = F.col("value")
        long = wide.select("vec_id", deviation.alias("deviation"), F.posexplode("w").alias("place", "value")).select(
            "vec_id", (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
            F.when(~F.isnan(whitened), whitened).alias("whitened"), F.element_at(share, F.col("place") + 1).alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
        )
        out = out.unionByName(long)
    return out


def identity_error(wide: DataFrame, places: list[int]) -> float | None:
    """Largest absolute entry of the covariance of the `w` at the given places minus the identity.

    The values are centred to rounding when they are made; what is left of their mean goes here, before products are made.
    """
    if not places:
        return None
    mean = wide.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in places]).first()
    off = {i: F.col("w")[i] - F.lit(mean[f"m{i}"]) for i in places}
    pairs = [(i, j) for i in places for j in places if i <= j]
    cov = wide.agg(*[F.avg(off[i] * off[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
