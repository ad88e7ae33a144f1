import collections

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from jobloom.llm import mixing
from tests.llm.brute import targets, words


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 10, None: 5}, {"a": 0, "b": 7}, {None: 3}, {"a": 0},
    {"é": 50, "z": 60, "B": 70, "a": 1, "": 9, None: 4}, {f"s{i}": (i * 37) % 101 for i in range(60)},
])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    assert got == pytest.approx(targets(sizes))


@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=3)), st.integers(0, 1000), min_size=1, max_size=9))
def test_brute_targets_use_all_words(sizes):
    assert sum(targets(sizes).values()) == pytest.approx(sum(sizes.values()))


def check(rows, docs):
    sizes = collections.Counter()
    for _, text, source in docs:
        sizes[source] += len(words(text))
    want = targets(sizes)
    assert collections.Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == collections.Counter((d, s, len(words(t))) for d, t, s in docs)
    taken, largest = collections.Counter(), collections.Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        passes = int(r["target"] / r["source_size"] + 1e-9) if r["source_size"] else 0
        assert r["taken"] in (passes * r["size"], (passes + 1) * r["size"]) and r["taken"] <= 3 * r["size"]  # whole passes first
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, target in want.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = mixing.mix(docs, carry=("text",)).collect()
    check(rows, [(d.doc_id, d.text, d.source) for d in docs.collect()])
    again = mixing.mix(docs.repartition(5)).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {(r["doc_id"], r["taken"]) for r in again}
    other = mixing.mix(docs, seed=1).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} != {(r["doc_id"], r["taken"]) for r in other}


def test_the_sample_is_the_front_of_the_key_order(spark):
    """With one bucket and with many, the same documents come first."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    few, many = ({(r["doc_id"], r["taken"]) for r in mixing.mix(docs, buckets=b).collect()} for b in (1, 200))
    assert few == many


def test_heavier_documents_are_taken_more_often(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 2000, "x").otherwise("y").alias("source"))
    heavy = F.col("doc_id") % 2 == 0
    rows = mixing.mix(docs, weights=(1.0, 3.0), quality=F.when(heavy, 1.0).otherwise(0.25)).where("source = 'x'").groupBy(heavy.alias("h")).agg(F.sum("copies").alias("n"))
    n = {r["h"]: r["n"] for r in rows.collect()}
    assert n[True] + n[False] == 1000 and n[True] > 2 * n[False]


def test_odd_rows(odd_docs, odd_rows, no_docs):
    check(mixing.mix(odd_docs, carry=tuple(odd_docs.columns)).collect(), [(r[0], r[1], r[3]) for r in odd_rows])
    assert mixing.mix(no_docs).collect() == []


def test_plan_has_no_python(odd_docs):
    assert "Python" not in mixing.mix(odd_docs)._jdf.queryExecution().executedPlan().toString()
