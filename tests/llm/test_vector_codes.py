import hashlib
import math
import random

import numpy as np
import pytest

from jobloom.llm import vector_codes
from jobloom.llm.vector_codes import Gnat, _squared

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int, error long"
WIDE = SCHEMA.replace("array<float>", "array<double>")


def cuts(length, parts):
    return [sum(length // parts + (i < length % parts) for i in range(p)) for p in range(parts + 1)]


def brute(rows, parts=4, entries=256, rounds=4):
    """Plain loops over Python's whole numbers, for vectors of one length."""
    kept = [
        (i, [math.floor(1024 * x) if abs(x) < 2**40 else int(x) * 1024 for x in v], label)
        for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    at = cuts(len(kept[0][1]), parts)
    pieces = [[v[a:b] for a, b in zip(at, at[1:])] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda n: (kept[n][0] is None, kept[n][0] or 0, kept[n][1]))[:entries]
    books = [[pieces[n][p] for n in first] for p in range(parts)]

    def nearest(q, book):
        return min((sum((a - b) ** 2 for a, b in zip(q, entry)), place) for place, entry in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            own = {}
            for piece in pieces:
                own.setdefault(nearest(piece[p], book)[1], []).append(piece[p])
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else entry for e, entry in enumerate(book)]
    final = [[nearest(piece[p], books[p]) for p in range(parts)] for piece in pieces]
    errors = [sum(d for d, _ in found) for found in final]
    sums = {}
    for (_, _, label), error in zip(kept, errors):
        sums[label] = sums.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return [
        (i, label, "".join(f"{e:02x}" for _, e in found), error, sums[label], sha)
        for (i, _, label), found, error in zip(kept, final, errors)
    ]


def found(spark, rows, schema=WIDE, **options):
    frame = spark.createDataFrame([(i, v, label, "own", 7, 9) for i, v, label in rows], schema).repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress(frame, **options).collect()), key=repr)


def same(spark, rows, schema=WIDE, **options):
    assert found(spark, rows, schema, **options) == sorted(brute(rows, **options), key=repr)


@pytest.mark.parametrize("width", [0, 1, 3, 8])
def test_tree_finds_the_lowest_of_the_nearest(width):
    draw = np.random.default_rng(width)
    for spread in (2, 40, 3000):  # few values make many ties
        entries = draw.integers(-spread, spread, (256, width)).astype(float)
        asked = draw.integers(-spread, spread, (700, width)).astype(float)
        entries[17], entries[200] = entries[99], entries[3]
        index, best = Gnat(entries).nearest(asked)
        plain = _squared(asked, entries)
        assert (index == plain.argmin(1)).all() and (best == plain.min(1)).all()
        whole = lambda x: np.frompyfunc(int, 1, 1)(x).astype(object).reshape(x.shape)
        large, shift = Gnat(whole(entries) * 10**20), whole(asked[:60]) * 10**20
        assert (large.nearest(shift)[0] == index[:60]).all()


def test_tree_leaves_entries_out():
    """Children that lie apart are not met: fewer distances than entries times rows."""
    draw = np.random.default_rng(3)
    centres = draw.integers(-10_000, 10_000, (16, 8))
    near = lambda n: (centres[draw.integers(0, 16, n)] + draw.integers(-50, 50, (n, 8))).astype(float)
    tree, met = Gnat(near(256)), []
    plain = Gnat._better
    Gnat._better = staticmethod(lambda rows, squares, *rest: (met.append(squares.size), plain(rows, squares, *rest)))
    try:
        tree.nearest(near(1000))
    finally:
        Gnat._better = staticmethod(plain)
    assert sum(met) < 1000 * 256 / 4


def test_random_vectors_with_copies_ties_and_labels(spark):
    draw = random.Random(1)
    value = lambda: draw.randint(-64, 64) / 128
    base = [[value() for _ in range(8)] for _ in range(400)]
    rows = [(i, v, draw.choice([1, 2, None])) for i, v in enumerate(base)]
    rows += [(5000 + i, base[3], 2) for i in range(300)] + [(7, base[9], None), (7, base[9], None), (None, base[4], 1)]
    draw.shuffle(rows)
    same(spark, rows, SCHEMA)
    same(spark, rows, SCHEMA, entries=40, rounds=2, parts=2)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 1), (2, [nan, 1.0, 0.0, 0.0, 0.5], 1), (3, [None, 1.0, 0.0, 0.0, 0.5], 1), (4, [1.0, -inf, 0.0, 0.0, 0.5], 1)]
    rows = [(i, [i / 7, -i / 3, 1.0, float(i % 2), 0.25], None) for i in range(10, 30)] + [(None, [9.0, 9.0, 9.0, 9.0, 9.0], 3)]
    same(spark, bad + rows)
    same(spark, [(5, [1.5], 1), (6, [2.5], 1), (8, [2.5], None)])
    assert found(spark, bad) == [] and found(spark, []) == [] and found(spark, [(1, [], 1)]) == []


def test_lengths_have_codebooks_of_their_own(spark):
    short = [(i, [i / 9, 1 - i / 5], 1) for i in range(20)]
    long = [(100 + i, [i / 9] * 6, 2) for i in range(20)]
    got = found(spark, short + long)
    assert got == sorted(brute(short) + brute(long), key=repr)


def test_large_components(spark):
    """A component beyond exact doubles takes part; the parts near it are still told apart."""
    near = [(i, [i / 8, 0.5, -0.25, i / 3], 1) for i in range(30)]
    rows = near + [(100, [2.0**60, 0.0, 0.0, 0.0], 2), (101, [2.0**60, 1.0, 0.0, 3e9], 2), (102, [-(2.0**33), 1.0, 0.0, 3.0], None)]
    same(spark, rows)
    with pytest.raises(Exception, match="(?i)int|long|overflow|large"):
        found(spark, [(i, [i / 8, 0.0, 0.0, 0.0], 1) for i in range(3)] + [(9, [2.0**60, 0.0, 0.0, 0.0], 1)], entries=2, rounds=0)
