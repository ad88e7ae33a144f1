import random

import pytest

from jobloom.llm import units, vector_search


@pytest.fixture(autouse=True)
def few_units(monkeypatch):
    """Small inputs in few tasks; several, so that texts and hashes meet across them."""
    monkeypatch.setattr(units, "LEAST_UNITS", 3)
    monkeypatch.setattr(vector_search, "LEAST_BLOCKS", 3)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves.
CLASHES = ("row", "unit", "bucket", "size", "number", "kept", "class", "group", "curve", "level", "key", "part", "place", "copies", "train", "score")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(400)]
    text = lambda n: " ".join(draw.choices(words, k=n))
    rows = [(i, text(draw.randint(25, 90)), draw.choice(["en", "de"]), draw.choice(["a", "b", "c"]), 5) for i in range(40)]
    rows += [
        (100, None, "en", "a", None), (101, "", "en", "a", 0), (102, " \t\n ", "de", None, 4), (103, "one two", None, None, 7),
        (104, text(30_000), "en", "a", 1), (None, text(50), None, "b", None), (None, None, None, None, None),
        (105, "same " * 60, "en", "b", 9), rows[3], rows[3], rows[3], (106, rows[4][1], "en", "c", 3),
        (107, "one two", "fr", "a", 7), (108, "x" * 70_000, "en", "a", 1), (109, "a\u0000b été 你好", "en", "a", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, tmp_path_factory):
    """The odd rows with columns whose names clash, stored as a table."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("odd") / "docs")
    frame = spark.createDataFrame(odd_rows, SCHEMA).withColumns({name: F.lit(f"own {name}") for name in CLASHES})
    frame.repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "docs")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)
