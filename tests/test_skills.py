"""Dictionary search: reference cases, and brute force term by term."""

import random
import re

import pytest

from jobloom.functions.skills import TECH_SKILLS, can_overlap, find_terms, search_groups
from jobloom.operators.cleaning import enrich_table, extract_skills


def by_terms(text, terms):
    return sorted({t for t in terms if re.search(rf"\b{re.escape(t)}\b", text or "", re.IGNORECASE)})


def test_dictionary():
    assert len(TECH_SKILLS) > 50
    assert all(term == term.lower() for term in TECH_SKILLS)
    assert len(TECH_SKILLS) == len(set(TECH_SKILLS))
    assert len(search_groups(TECH_SKILLS)) == 1


def test_single_texts(evaluate):
    texts = [
        "We need a Python developer", "Must know Python, SQL, and Docker", "", None, "Looking for a nice person",
        "Experience with AWS required", "We use Spark for processing", "docker kubernetes python aws",
        "python Python PYTHON python", "JavaScript not java-script", "C++ and c++11", "ci/cd, Node.js; power bi",
        "go_lang", "GO²", "éjava javá", "ſql and gİt and Kafka", "scikit-learn/numpy", "javascript",
    ]
    got = evaluate(find_terms, texts)
    assert got == [by_terms(text, TECH_SKILLS) for text in texts]


def test_token_boundary_finds_signs(evaluate):
    assert evaluate(lambda c: find_terms(c, boundary="token"), ["C++ and SQL", "c++11", "(C++)"]) == [["c++", "sql"], [], ["c++"]]


@pytest.mark.parametrize(
    "terms",
    [
        TECH_SKILLS,
        ("de", "de la", "la", "la de", "a", "de la a"),
        ("c++", "c", "++", "c++ d", "+ d", "d"),
        ("a.b", "b.a", "a", "b", ".a"),
    ],
)
def test_random_texts(evaluate, terms):
    pick = random.Random(11)
    parts = list(terms) + [" ", ",", ".", "+", "-", "_", "x", "é", " ", " ", "\n", "1"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(1, 12))) for _ in range(800)]
    texts = [t.upper() if pick.random() < 0.3 else t for t in texts]
    got = evaluate(lambda c: find_terms(c, terms), texts)
    wrong = [(t, g, by_terms(t, terms)) for t, g in zip(texts, got) if g != by_terms(t, terms)]
    assert not wrong, wrong[:3]


def test_overlaps():
    assert can_overlap("de la", "la")
    assert can_overlap("machine learning", "learning path")
    assert not can_overlap("java", "javascript")
    assert not can_overlap("sql", "linux")


def test_columns_are_added(spark):
    df = spark.createDataFrame(
        [("Need Python and SQL experience", "python, backend"), ("Python, SQL, Docker expert needed", ""), (None, "python"), ("", None)],
        "description string, tags string",
    )
    rows = extract_skills(df).collect()
    assert [(r["skills"], r["skill_count"]) for r in rows] == [
        ("python, sql", 2), ("docker, python, sql", 3), ("python", 1), ("", 0),
    ]
    empty = extract_skills(df.limit(0))
    assert empty.count() == 0 and {"skills", "skill_count"} <= set(empty.columns)
    assert extract_skills(df.drop("tags")).columns == ["description", "skills", "skill_count"]


def test_enrich_strips_all_rows_if_any_has_tags(spark):
    rows = [(1, "<b>python</b>"), (2, "power &amp; sql")]
    df = spark.createDataFrame(rows, "id int, description string")
    assert [r["description"] for r in enrich_table(df).orderBy("id").collect()] == ["python", "power & sql"]
    plain = enrich_table(df.where("id = 2")).first()
    assert plain["description"] == "power &amp; sql"
    assert enrich_table(df.select("id")).columns == ["id"]
