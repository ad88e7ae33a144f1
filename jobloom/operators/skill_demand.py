"""Skill rankings and co-occurrence.

Inputs are either postings with a `skills` column (array or comma-separated
text) or long rows (job_id, skill).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.functions.common import as_col, title_case
from jobloom.functions.skills import split_skills
from jobloom.sources.storage import shared_folder

DISPLAY_DEFAULT = 20


def skill_array(postings: DataFrame, column: str = "skills") -> Column:
    """Lower-cased skills of each posting, stored as array or as text; nulls and blanks are none."""
    if postings.schema[column].dataType.typeName() == "array":
        named = F.transform(column, lambda skill: F.lower(F.trim(skill)))
        return F.filter(named, lambda skill: F.coalesce(skill, F.lit("")) != "")
    return split_skills(column)


def posting_skills(postings: DataFrame, column: str = "skills") -> DataFrame:
    """Long rows (job_id, skill) of postings."""
    return postings.select("job_id", F.explode(skill_array(postings, column)).alias("skill"))


def skill_sets(pairs: DataFrame) -> DataFrame:
    """Postings with the sorted array of their distinct skills.

    The set is built in partial aggregates, so repeats collapse before the
    shuffle and a group is never larger than the skill vocabulary.
    """
    return pairs.groupBy("job_id").agg(F.array_sort(F.collect_set("skill")).alias("skills"))


def _demand(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.trim("skill") != "").groupBy("skill").agg(F.count(F.lit(1)).alias("demand"))


def skill_rankings(pairs: DataFrame) -> DataFrame:
    """(skill, demand) with title-cased labels, highest demand first."""
    return label_rankings(_demand(pairs))


def label_rankings(demand: DataFrame) -> DataFrame:
    ranked = demand.orderBy(F.desc("demand"), "skill")
    return ranked.select(title_case("skill").alias("skill"), "demand")


def ranked_top_n(pairs: DataFrame, n: int = DISPLAY_DEFAULT) -> DataFrame:
    """The `n` skills in highest demand with their 1-based position.

    The limit comes first, so the positions are given to at most `n` rows.
    """
    if n < 1:
        raise ValueError(f"{n} skills cannot be ranked")
    top = _demand(pairs).orderBy(F.desc("demand"), "skill").limit(n)
    position = F.row_number().over(Window.orderBy(F.desc("demand"), "skill"))
    return top.select(position.alias("position"), title_case("skill").alias("skill"), "demand")


def skill_totals(pairs: DataFrame) -> DataFrame:
    return sum_demand(_demand(pairs))


def sum_demand(demand: DataFrame) -> DataFrame:
    return demand.agg(
        F.coalesce(F.sum("demand"), F.lit(0)).cast("bigint").alias("total_mentions"),
        F.count(F.lit(1)).alias("unique_skills"),
    )


def unordered_pairs(skills: Column | str) -> Column:
    """All pairs (a, b), a < b, of the distinct values of one array."""
    names = F.array_sort(F.array_distinct(as_col(skills)))

    def with_later(name: Column, place: Column) -> Column:
        # `place` counts from 0, slices from 1: the slice starts behind `name`.
        later = F.slice(names, place + 2, F.size(names))
        return F.transform(later, lambda other: F.struct(name.alias("a"), other.alias("b")))

    return F.flatten(F.transform(names, with_later))


def skill_cooccurrence(
    postings: DataFrame, n: int | None = 15, column: str = "skills", dictionary: Iterable[str] | None = None
) -> DataFrame:
    """How many postings name both skills of a pair, most frequent pairs first.

    Pairs are made inside the row of one posting, whose skills come from a
    dictionary, and counted before the shuffle: what travels is at most one row
    per pair of dictionary terms and task, however many postings there are. Where
    skills are free tags, give the `dictionary` of those that are to be paired.
    """
    skills = skill_array(postings, column)
    if dictionary is not None:
        skills = F.array_intersect(skills, F.array(*[F.lit(term.lower()) for term in dictionary]).cast("array<string>"))
    # A projection of its own keeps the prepared array from being built once per use.
    sets = postings.select(F.array_sort(F.array_distinct(skills)).alias("skills"))
    counted = (
        sets.where(F.size("skills") > 1)
        .select(F.explode(unordered_pairs("skills")).alias("pair"))
        .groupBy("pair.a", "pair.b")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return label_pairs(counted, n)


def label_pairs(counted: DataFrame, n: int | None) -> DataFrame:
    """(pair, count) of counted pairs (a, b), most frequent first."""
    ordered = counted.orderBy(F.desc("count"), "a", "b")
    top = ordered if n is None else ordered.limit(n)
    return top.select(F.concat(title_case("a"), F.lit(" + "), title_case("b")).alias("pair"), "count")


# ---- frequent pairs without a dictionary -----------------------------------------------------


def _rows_of_skills(postings: DataFrame, column: str) -> DataFrame:
    """(row, skill): each skill of a posting once, the posting numbered."""
    numbered = postings.select(F.monotonically_increasing_id().alias("row"), skill_array(postings, column).alias("skills"))
    return numbered.select("row", F.explode(F.array_distinct("skills")).alias("skill"))


def _pairs_among(mentions: DataFrame, chosen: DataFrame) -> DataFrame:
    """(a, b, count) of pairs whose skills are both chosen; sets are built of these skills alone."""
    sets = mentions.join(chosen.select("skill"), "skill", "left_semi").groupBy("row").agg(F.collect_set("skill").alias("skills"))
    pairs = sets.where(F.size("skills") > 1).select(F.explode(unordered_pairs("skills")).alias("pair"))
    return pairs.groupBy("pair.a", "pair.b").agg(F.count(F.lit(1)).alias("count"))


def contenders(mentions: DataFrame, demand: DataFrame, n: int, first: int) -> DataFrame:
    """The skills of which some pair can be among the `n` most frequent.

    A pair is named at most as often as the rarer of its skills. The pairs among the `first`
    skills in highest demand give a count that the n-th best pair reaches at least; skills in
    less demand than that are out. Where these pairs are fewer than `n`, all skills remain
    that are named with others at all.
    """
    leading = demand.orderBy(F.desc("demand"), "skill").limit(first)
    best = _pairs_among(mentions, leading).orderBy(F.desc("count")).limit(n)
    reached = best.agg(F.when(F.count(F.lit(1)) == n, F.min("count")).alias("count")).scalar()
    return demand.where(F.col("demand") >= F.coalesce(reached, F.lit(1)))


def frequent_pairs(postings: DataFrame, n: int = 15, column: str = "skills", first: int = 64) -> DataFrame:
    """`skill_cooccurrence` for free tags: the same `n` pairs, exact, without a dictionary.

    Only pairs of skills that can still be among the best are made, so a long tail of rare
    tags costs its counts and no pairs, in a posting with many tags too. The postings
    are written once as (row, skill); a skill that many postings name is counted before its shuffle,
    and Spark broadcasts the skills that remain while it has measured them to be small.
    """
    if n < 1 or first < 2:
        raise ValueError("pairs need a positive number, made of two skills at least")
    spark = postings.sparkSession
    path = shared_folder(spark, "pairs")
    _rows_of_skills(postings, column).write.parquet(f"{path}/mentions")
    mentions = spark.read.parquet(f"{path}/mentions")
    mentions.groupBy("skill").agg(F.count(F.lit(1)).alias("demand")).write.parquet(f"{path}/demand")
    contenders(mentions, spark.read.parquet(f"{path}/demand"), n, first).select("skill").write.parquet(f"{path}/left")
    return label_pairs(_pairs_among(mentions, spark.read.parquet(f"{path}/left")), n)
