"""Search by a table of terms: equal to the dictionary search and to a regular expression per term."""

import random

import pytest
from pyspark.sql import functions as F

from jobloom.functions.skills import TECH_SKILLS, find_terms
from jobloom.operators import cleaning, term_join
from tests.test_skills import by_terms


def table(spark, terms):
    return term_join.TermTable(spark.createDataFrame([(t,) for t in terms], "term string"))


def found(spark, texts, terms, boundary="word"):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(3)
    hits = {r["k"]: r["skills"] for r in term_join.term_hits(rows, "k", "t", table(spark, terms), boundary).collect()}
    return [hits.get(place, []) for place in range(len(texts))]


@pytest.mark.parametrize(
    "terms",
    [
        TECH_SKILLS,
        ("de", "de la", "la", "la de", "a", "de la a"),
        ("c++", "c", "++", "c++ d", "+ d", "d", "+", " ", "d "),
        ("a.b", "b.a", "a", "b", ".a", "..", "b."),
    ],
)
def test_random_texts(spark, evaluate, terms):
    pick = random.Random(11)
    parts = list(terms) + [" ", ",", ".", "+", "-", "_", "x", "é", " ", " ", "\n", "1", "你", "😀", "ſ", "İ"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(1, 12))) for _ in range(400)]
    texts = [t.upper() if pick.random() < 0.3 else t for t in texts] + ["", None, "word " * 30_000 + terms[0], terms[0] * 3]
    for boundary in ("word", "token"):
        assert found(spark, texts, terms, boundary) == evaluate(lambda c: find_terms(c, terms, boundary), texts)
    plain = [t for t in texts if t is None or not set("İſ") & set(t)]
    assert found(spark, plain, terms) == [by_terms(t, terms) for t in plain]


def test_skills_of_postings(spark):
    rows = [("a", "Python and SQL", "c++x, ci/cd"), (None, "spark", None), ("b", None, "nothing"), ("c", "go go GO", "")]
    frame = spark.createDataFrame([(*r, "own", 1) for r in rows], "job_id string, description string, tags string, term string, _text int")
    plain = cleaning.extract_skills(frame)
    joined = term_join.extract_skills(frame, table(spark, TECH_SKILLS))
    order = lambda df: sorted((tuple(r) for r in df.select(*plain.columns).collect()), key=str)
    assert order(joined) == order(plain) and joined.columns == plain.columns
    none = term_join.extract_skills(frame, table(spark, [None, ""]), as_text=False)
    assert {(tuple(r["skills"]), r["skill_count"]) for r in none.collect()} == {((), 0)}
    with pytest.raises(ValueError):
        term_join.term_hits(frame, "job_id", "tags", table(spark, ["x"]), "other")


def test_the_plan_does_not_grow_with_the_dictionary(spark):
    texts = spark.createDataFrame([(i, f"see term{i} and two{i} parts{i} here") for i in range(300)], "k long, t string")
    few = term_join.TermTable(spark.range(1).select(F.lit("term0").alias("term")).union(spark.range(1).select(F.lit("two0 parts0"))))
    many = spark.range(50_000).select(F.concat(F.lit("term"), "id").alias("term")).union(
        spark.range(50_000).select(F.concat(F.lit("two"), "id", F.lit(" parts"), "id"))
    )
    many = term_join.TermTable(many)
    assert few.kinds == many.kinds == [term_join.Kind(1, True, True), term_join.Kind(3, True, True)]
    size = lambda terms: len(term_join.term_hits(texts, "k", "t", terms)._jdf.queryExecution().optimizedPlan().toString())
    assert abs(size(few) - size(many)) < 200
    got = {r["k"]: r["skills"] for r in term_join.term_hits(texts, "k", "t", many).collect()}
    assert got == {i: sorted([f"term{i}", f"two{i} parts{i}"]) for i in range(300)}
