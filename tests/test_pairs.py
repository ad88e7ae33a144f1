"""Frequent pairs of free tags: equal to counting all pairs, with few of them made."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from jobloom.operators import skill_demand

SCHEMA = "job_id long, skills array<string>"


def brute(rows, n):
    counts = collections.Counter()
    for _, skills in rows:
        names = sorted({s.strip().lower() for s in skills or () if s and s.strip()})
        counts.update(itertools.combinations(names, 2))
    best = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:n]
    return [(" + ".join(" ".join(w.capitalize() for w in name.split(" ")) for name in pair), count) for pair, count in best]


def found(spark, rows, n, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return [tuple(r) for r in skill_demand.frequent_pairs(frame, n, **options).collect()]


def long_tail(draw, rows, vocabulary=5000, tags=8):
    weights = [1 / (1 + i) for i in range(vocabulary)]
    return [(i, draw.choices([f"tag{j}" for j in range(vocabulary)], weights, k=draw.randint(0, tags))) for i in range(rows)]


@pytest.mark.parametrize("first", [2, 5, 64])
def test_against_counting_all_pairs(spark, first):
    draw = random.Random(first)
    rows = long_tail(draw, 400, 300)
    rows += [(900, None), (901, []), (902, [None, " ", ""]), (903, ["TAG1", " tag1 ", "tag2"]), (904, ["alone"]), (904, ["tag1", "tag2"])]
    for n in (1, 7, 60):
        assert found(spark, rows, n, first=first) == brute(rows, n)


def test_ties_and_few_pairs(spark):
    rows = [(i, [f"a{i}", f"b{i}", f"c{i}"]) for i in range(10)]  # all pairs once
    assert found(spark, rows, 4, first=2) == brute(rows, 4)
    assert found(spark, rows, 1000) == brute(rows, 1000) and len(brute(rows, 1000)) == 30
    assert found(spark, [], 5) == [] and found(spark, [(1, ["x"])], 5) == []
    with pytest.raises(ValueError):
        found(spark, rows, 0)


def test_few_pairs_are_made(spark):
    """On a long tail the skills that remain make a small part of all pairs, and hot ones are counted before they travel."""
    rows = long_tail(random.Random(9), 3000, tags=30)
    mentions = skill_demand._rows_of_skills(spark.createDataFrame(rows, SCHEMA), "skills").persist()
    demand = mentions.groupBy("skill").agg(F.count(F.lit(1)).alias("demand"))
    left = skill_demand.contenders(mentions, demand, 15, 64)

    def made(chosen):
        sizes = mentions.join(chosen.select("skill"), "skill", "left_semi").groupBy("row").count()
        return sizes.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]

    assert left.count() < demand.count() / 50 and made(left) < made(demand) / 10
    assert found(spark, rows, 15) == brute(rows, 15)
    mentions.unpersist()
