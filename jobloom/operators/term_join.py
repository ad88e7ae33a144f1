"""Whole-word search for dictionaries of any size: runs of a text's tokens joined to a table of terms.

A token is a run of letters, digits and underscores, or a single other sign. A term is found where its
tokens stand in a row, under the same rules for its edges as `functions.skills.find_terms`. The
plan depends on the kinds of terms there are (how many tokens, letters or signs at the ends), not on
their number: each text gives its different runs of those kinds, and runs meet terms in an
equi-join, which Spark broadcasts while it has measured the table of terms to be small.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.skills import _fold, join_skills, posting_text
from jobloom.functions.common import text_or_empty
from jobloom.sources.storage import shared_folder

_WORD = r"[\p{L}\p{N}_]"
_TOKEN = rf"{_WORD}+|[^\p{{L}}\p{{N}}_]"


@dataclass(frozen=True, order=True)
class Kind:
    """Terms of as many tokens, with a letter (or digit) or a sign at either end."""

    tokens: int
    letter_first: bool
    letter_last: bool


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


class TermTable:
    """Lower-cased terms, stored once; `kinds` are the few that occur among them.

    Null and empty terms are none. Terms that differ in case only are one.
    """

    def __init__(self, terms: DataFrame, column: str = "term"):
        spark, path = terms.sparkSession, shared_folder(terms.sparkSession, "terms")
        named = terms.select(F.lower(F.col(column)).alias("term")).where(F.col("term") != "").distinct()
        letter = lambda end: F.rlike(end, F.lit(f"^{_WORD}"))
        held = _tokens(F.col("term"))
        kind = F.struct(
            F.size("tokens").alias("tokens"), letter(F.element_at("tokens", 1)).alias("letter_first"),
            letter(F.element_at("tokens", -1)).alias("letter_last"),
        )
        named.withColumn("tokens", held).select("term", kind.alias("kind")).write.parquet(path)
        self.terms = spark.read.parquet(path)
        # As many rows as there are kinds: four for each length of a term.
        self.kinds = sorted(Kind(*row["kind"]) for row in self.terms.select("kind").distinct().collect())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def token_runs(text: Column, kinds: list[Kind], boundary: str = "word") -> Column:
    """The different runs of a text's tokens that could be terms of these kinds, as an array.

    `text` is lower-cased. A word edge next to a sign needs a letter outside; with `boundary="token"`
    it must have none.
    """
    outside = boundary == "word"
    none = F.array().cast("array<string>")

    def of_kind(kind: Kind, tokens: Column, letters: Column) -> Column:
        def fits(at: Column) -> Column:
            right = (F.get(letters, at) == kind.letter_first) & (F.get(letters, at + (kind.tokens - 1)) == kind.letter_last)
            # A run of letters ends where its token ends; only signs look at what is beside them.
            if not kind.letter_first:
                right &= F.coalesce(F.get(letters, at - 1), F.lit(False)) == outside
            if not kind.letter_last:
                right &= F.coalesce(F.get(letters, at + kind.tokens), F.lit(False)) == outside
            return right

        def run(at: Column) -> Column:
            if kind.tokens == 1:
                return F.get(tokens, at)
            return F.concat(*[F.get(tokens, at + i) for i in range(kind.tokens)])

        places = F.filter(F.sequence(F.lit(0), F.size(tokens) - kind.tokens), fits)
        return F.when(F.size(tokens) >= kind.tokens, F.transform(places, run)).otherwise(none)

    def runs(tokens: Column) -> Column:
        flags = F.transform(tokens, lambda t: F.rlike(t, F.lit(f"^{_WORD}")))
        return _let(flags, lambda letters: F.flatten(F.array(*[of_kind(kind, tokens, letters) for kind in kinds])))

    return F.array_distinct(_let(_tokens(text), runs)) if kinds else none


def term_hits(texts: DataFrame, key: str, text: Column | str, terms: TermTable, boundary: str = "word") -> DataFrame:
    """(key, skills): the sorted terms found in the texts of each key; keys without any do not appear."""
    if boundary not in ("word", "token"):
        raise ValueError(f"unknown boundary: {boundary}")
    runs = token_runs(_fold(text_or_empty(text)), terms.kinds, boundary)
    asked = texts.select(F.col(key).alias("_key"), F.explode(runs).alias("term"))
    found = asked.join(terms.terms.select("term"), "term")
    return found.groupBy("_key").agg(F.array_sort(F.collect_set("term")).alias("skills")).withColumnRenamed("_key", key)


def extract_skills(
    df: DataFrame, terms: TermTable, key: str = "job_id", boundary: str = "word", as_text: bool = True
) -> DataFrame:
    """`cleaning.extract_skills` for a table of terms: `skills` and `skill_count` from description and tags.

    `key` is unique; null is a key like any other. Only keys and terms are shuffled before
    the skills go back to their rows.
    """
    text = posting_text(
        F.col("description") if "description" in df.columns else F.lit(""), F.col("tags") if "tags" in df.columns else F.lit("")
    )
    hits = term_hits(df.select(key, text.alias("_text")), key, "_text", terms, boundary)
    hits = hits.withColumnsRenamed({key: "_key", "skills": "_skills"})
    found = F.coalesce("_skills", F.array().cast("array<string>"))
    joined = df.join(hits, F.col(key).eqNullSafe(F.col("_key")), "left").withColumns(
        {"skills": join_skills(found) if as_text else found, "skill_count": F.size(found)}
    )
    return joined.drop("_key", "_skills")
