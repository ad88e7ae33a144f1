import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from jobloom.llm import vector_search

SCHEMA = "vec_id long, embedding array<float>, label int, class string, rank int"


def brute(rows, k=5):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (query, q) in enumerate(usable):
        if query is None or query % 50:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(q, v, strict=True)), i is None, i or 0)
            for j, (i, v) in enumerate(usable) if j != at and len(v) == len(q)
        )
        out += [(query, rank, None if none else i, -score) for rank, (score, none, i) in enumerate(scores[:k], 1)]
    return collections.Counter(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 1, "own", 7) for i, v in rows], SCHEMA).repartition(3)
    return collections.Counter(tuple(r) for r in vector_search.top_k(frame, F.col("vec_id") % 50 == 0, **options).collect())


def test_random_vectors_with_copies_and_ties(spark):
    draw = random.Random(1)
    value = lambda: draw.randint(-64, 64) / 128  # noqa: E731  exact as a float
    base = [[value() for _ in range(6)] for _ in range(150)]
    rows = list(enumerate(base)) + [(1000 + i, base[i % 4]) for i in range(120)] + [(50, base[50]), (50, base[3])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, cells=4, cell_block=20, query_block=2) == brute(rows)
    assert found(spark, rows, k=1) == brute(rows, 1)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [nan, 1.0]), (200, [inf, 1.0]), (250, []), (300, []), (350, [0.5]),
        (None, [1.0, 1.0]), (None, None), (1, [3.0, -1.0]), (2, [3.0, -1.0]), (400, [0.0, 0.0]), (450, [0.0, 0.0]), (450, [0.0, 0.0]),
        (500, [9000.0, 1.0]),
    ]
    assert found(spark, rows) == brute(rows)
    assert not found(spark, [])


def test_large_components(spark):
    draw = random.Random(2)
    rows = [(i, [draw.randint(-64, 64) / 128 for _ in range(3)]) for i in range(120)]
    assert found(spark, (few := [(500, [70000.0, 1.0]), (1, [1.0, 1.0])])) == brute(few)
    assert found(spark, [*rows, (500, [70000.0, 1.0, -3.0]), (501, [-70000.0, 1.0, -3.0]), (502, [3e6, 3e6, 1.0])]) == brute(
        [*rows, (500, [70000.0, 1.0, -3.0]), (501, [-70000.0, 1.0, -3.0]), (502, [3e6, 3e6, 1.0])]
    )
    # Beyond a long are the components, their own square and single products, but no score.
    wild = [(0, [2.0**100, 2.0**100, 1.0]), (1, [2.0**90, -(2.0**90), 2.0]), (2, [0.0, 0.0, 5.0]), (50, [0.0, 0.0, 7.0]), (3, [2.0**14, -(2.0**14), 9.0])]
    assert found(spark, wild) == brute(wild)
    with pytest.raises(Exception, match="does not fit a long"):
        found(spark, [(0, [2.0**100, 1.0]), (1, [1.0, 1.0])])
    assert not found(spark, [])


def test_wild_values_leave_the_bounds_of_others(spark):
    """One vector of large components does not blur the cells that the others lie in."""
    import numpy as np

    draw = np.random.default_rng(5)
    base = np.floor(draw.normal(0, 30, (2000, 8)))
    wild = np.vstack([base, [[60_000.0 * 256, -9e9, 1.0, 0.0, 7e12, -3.0, 2.0, 1.0]]])

    def half_of(rows):
        frame = spark.createDataFrame([(r.tolist(),) for r in rows], "v array<double>")
        grid = vector_search._grids(frame, 64)[8]
        centre, half = grid.bounds()
        codes = [list(bytes(r["c"])) for r in frame.select(grid.code(F.col("v")).alias("c")).collect()]
        held = centre[np.arange(8), codes], half[np.arange(8), codes]
        assert (np.abs(rows - held[0]) <= held[1]).all()
        return held[1][:2000]

    alone, beside = half_of(base), half_of(wild)
    assert np.median(beside) < 2 * np.median(alone) and beside.max() < 3 * alone.max()
