"""Cleaning chain from raw to clean postings, without an action in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom import schemas
from jobloom.functions import fields, markup, skills as skill_functions
from jobloom.functions.common import text_or_empty
from jobloom.functions.skills import TECH_SKILLS
from jobloom.operators.keyed import dedupe
from jobloom.sources.storage import ensure_columns, order_columns


def clean_descriptions(df: DataFrame, column: str = "description") -> DataFrame:
    return df.withColumn(column, markup.strip_html(column))


def clean_places(df: DataFrame, legacy_suffix: bool = False) -> DataFrame:
    """Work mode from the location as given, then the tidy location and remote flag."""
    tidy = df.withColumns(
        {
            "work_mode": fields.work_mode("location"),
            "location": fields.normalise_location("location", legacy_suffix),
        }
    )
    return tidy.withColumn("is_remote", fields.is_remote("location", "job_type"))


def clean_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("posted_date", fields.posted_date("posted_date"))


def clean_salaries(df: DataFrame, k_suffix: bool = False) -> DataFrame:
    return (
        df.withColumn("_bounds", fields.salary_bounds("salary", k_suffix))
        .withColumns({"salary_min": F.col("_bounds.salary_min"), "salary_max": F.col("_bounds.salary_max")})
        .drop("_bounds")
    )


def clean_job_types(df: DataFrame) -> DataFrame:
    return df.withColumn("job_type", fields.normalise_job_type("job_type"))


def extract_skills(
    df: DataFrame,
    dictionary: tuple[str, ...] = TECH_SKILLS,
    boundary: str = "word",
    as_text: bool = True,
) -> DataFrame:
    """Add `skills` and `skill_count` from description and tags."""
    text = skill_functions.posting_text(
        F.col("description") if "description" in df.columns else F.lit(""),
        F.col("tags") if "tags" in df.columns else F.lit(""),
    )
    found = df.withColumn("skills", skill_functions.find_terms(text, dictionary, boundary))
    counted = found.withColumn("skill_count", F.size("skills"))
    return counted.withColumn("skills", skill_functions.join_skills("skills")) if as_text else counted


def enrich_table(
    df: DataFrame,
    dictionary: tuple[str, ...] = TECH_SKILLS,
    boundary: str = "word",
    strip: bool | None = None,
) -> DataFrame:
    """Recompute the skill columns of any stored table with a `description`.

    `strip=None` strips HTML from all rows if any row holds a `<`. That test is
    a scalar subquery that stops at the first hit of each partition. A table
    without `description` is returned as it is.
    """
    if "description" not in df.columns:
        return df
    text = text_or_empty("description")
    if strip is None:
        any_tag = df.where(text.contains("<")).limit(1).select(F.lit(True).alias("hit")).scalar()
        text = F.when(F.coalesce(any_tag, F.lit(False)), markup.strip_html("description")).otherwise(text)
    elif strip:
        text = markup.strip_html("description")
    return extract_skills(df.withColumn("description", text), dictionary, boundary)


def clean_postings(
    raw: DataFrame,
    dictionary: tuple[str, ...] = TECH_SKILLS,
    order: list[str] | None = None,
    boundary: str = "word",
    legacy_suffix: bool = False,
    k_suffix: bool = False,
    unique: bool = False,
) -> DataFrame:
    """All cleaning steps as one lazy plan.

    The only shuffle is the one that keeps one row per `job_id`; `unique=True`
    leaves it out for input that is already unique.
    """
    df = ensure_columns(raw, schemas.CLEANING_INPUTS)
    if not unique:
        df = dedupe(df, "job_id", order)
    return (
        df.transform(clean_descriptions)
        .transform(clean_places, legacy_suffix)
        .transform(clean_dates)
        .transform(clean_salaries, k_suffix)
        .transform(clean_job_types)
        .transform(extract_skills, dictionary, boundary)
        .transform(order_columns)
    )
