"""Market questions over clean postings: counts, timeline, work mode, headline figures.

Where counts tie, the name decides (ascending), so results are repeatable.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.functions.common import as_col, blank_to_null, mentions_any, number_column, text_or_empty
from jobloom.functions.fields import FALLBACK_LOCATION_WORDS, posted_date
from jobloom.sources.storage import MONTH, month_number


def _rows() -> Column:
    return F.count(F.lit(1))


def prepare(df: DataFrame) -> DataFrame:
    """Types the questions rely on, whatever the stored table has: date, numbers, flag."""
    casts: dict[str, Column] = {}
    if "posted_date" in df.columns:
        casts["posted_date"] = posted_date("posted_date")
    for name in ("salary_min", "salary_max", "skill_count"):
        if name in df.columns:
            casts[name] = number_column(df, name)
    if "is_remote" in df.columns:
        casts["is_remote"] = F.col("is_remote").try_cast("boolean")
    return df.withColumns(casts) if casts else df


def filter_postings(
    df: DataFrame,
    locations: Iterable[str] = (),
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """Postings of the given locations (none given: all) within inclusive day bounds.

    A posting without date fails as soon as a bound is set. Of postings stored by month
    (`storage.write_by_month`), only the folders of these months are read.
    """
    wanted = list(locations)
    if wanted:
        df = df.where(F.col("location").isin(wanted))
    for bound, within in ((date_from, Column.__ge__), (date_to, Column.__le__)):
        if bound:
            day = F.lit(bound).cast("date")
            df = df.where(within(F.col("posted_date"), day))
            if MONTH in df.columns:
                df = df.where(within(F.col(MONTH), month_number(day)))
    return df


def location_options(df: DataFrame) -> DataFrame:
    """Distinct non-empty locations in name order."""
    return df.where(F.col("location") != "").select("location").distinct().orderBy("location")


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("posted_date").alias("first_date"), F.max("posted_date").alias("last_date"))


def search_locations(df: DataFrame, text: str) -> DataFrame:
    """Location options that contain the text, ignoring case."""
    return location_options(df.where(F.lower("location").contains(text.lower())))


def headline_totals(df: DataFrame) -> dict[str, Column]:
    """What the headline adds up, as totals of `facet_counts`."""
    has = set(df.columns)
    given = {"posting": F.lit(1)}
    if "skill_count" in has:
        given["skill_count"] = F.col("skill_count")
    if "salary_min" in has:
        given["paid"] = number_column(df, "salary_min")
    return given


def headline_metrics(df: DataFrame) -> DataFrame:
    """Postings, companies, locations, mean skills per posting, postings with salary; one pass over the postings.

    Distinct names are the rows of a facet: two distinct counts in one aggregate
    would make Spark write every row three times.
    """
    return headline_of(facet_counts(df, {"company": F.col("company"), "location": F.col("location")}, headline_totals(df)))


def headline_of(counts: DataFrame) -> DataFrame:
    """The headline out of facet counts with the facets and totals that it needs."""

    def of(facet: str, column: str) -> Column:
        return F.sum(F.when(F.col("facet") == facet, F.col(column)))

    mean = F.round(of("skill_count", "total") / of("skill_count", "count"), 1)
    return counts.agg(
        F.coalesce(of("posting", "count"), F.lit(0)).alias("total_jobs"),
        F.count_if(F.col("facet") == "company").alias("companies"),
        F.count_if(F.col("facet") == "location").alias("locations"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_skills"),
        F.coalesce(of("paid", "count"), F.lit(0)).alias("with_salary"),
    )


def top_values(df: DataFrame, column: str | Column, n: int | None = 12) -> DataFrame:
    """Most frequent non-null values as (name, count)."""
    value = as_col(column)
    ranked = (
        df.where(value.isNotNull())
        .groupBy(value.cast("string").alias("name"))
        .agg(_rows().alias("count"))
        .orderBy(F.desc("count"), "name")
    )
    return ranked if n is None else ranked.limit(n)


def timeline(df: DataFrame) -> DataFrame:
    """Postings per day, ascending; days without postings do not appear."""
    day = F.col("posted_date").cast("date")
    return df.where(day.isNotNull()).groupBy(day.alias("date")).agg(_rows().alias("count")).orderBy("date")


def with_work_mode(df: DataFrame) -> DataFrame:
    """Work mode as stored, or judged on the location where it is absent or empty."""
    guess = F.when(
        mentions_any(text_or_empty("location"), FALLBACK_LOCATION_WORDS), F.lit("Remote")
    ).otherwise(F.lit("Onsite"))
    stored = blank_to_null(F.col("work_mode")) if "work_mode" in df.columns else F.lit(None).cast("string")
    return df.withColumn("work_mode", F.coalesce(stored, guess))


def work_mode_split(df: DataFrame) -> DataFrame:
    """Postings per work mode with their share in percent.

    The window runs over the finished counts, one row per mode.
    """
    return with_share(with_work_mode(df).groupBy(F.col("work_mode").alias("mode")).agg(_rows().alias("count")))


def with_share(counts: DataFrame) -> DataFrame:
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("count") * 100.0 / total, 1)).orderBy(F.desc("count"), "mode")


def remote_locations(df: DataFrame, n: int = 12) -> DataFrame:
    remote = with_work_mode(df).where(F.col("work_mode") == "Remote")
    return top_values(remote, "location", n)


def facet_counts(df: DataFrame, facets: dict[str, Column], totals: dict[str, Column] | None = None) -> DataFrame:
    """Rows (facet, name, count): several group counts from one pass and one shuffle.

    A facet is a text column, or an array of texts of which every element counts.
    Nulls do not count. Each posting meets the partial aggregate once per facet,
    so only one row per distinct name and task travels. `totals` are numbers to be added up: each
    is a facet with one empty name, the count of its numbers and, in a column `total`, their sum.
    """
    kinds = dict(df.select(*[value.alias(facet) for facet, value in facets.items()]).dtypes)
    none = F.lit(None).cast("double")
    sums = [] if totals is None else [none.alias("total")]

    def cells(facet: str, value: Column) -> Column:
        names = value if kinds[facet].startswith("array") else F.array(value.cast("string"))
        return F.transform(names, lambda name: F.struct(F.lit(facet).alias("facet"), name.alias("name"), *sums))

    def number(facet: str, value: Column) -> Column:
        name = F.when(value.isNotNull(), F.lit(""))
        return F.struct(F.lit(facet).alias("facet"), name.alias("name"), value.cast("double").alias("total"))

    parts = [F.coalesce(cells(facet, value), F.array()) for facet, value in facets.items()]
    if totals:
        parts.append(F.array(*[number(facet, value) for facet, value in totals.items()]))
    return (
        df.select(F.inline(F.concat(*parts)))
        .where(F.col("name").isNotNull())
        .groupBy("facet", "name")
        .agg(_rows().alias("count"), *([F.sum("total").alias("total")] if sums else []))
    )


def facet(counts: DataFrame, name: str, n: int | None = None) -> DataFrame:
    """One facet of `facet_counts` as (name, count), most frequent first."""
    ranked = counts.where(F.col("facet") == name).select("name", "count").orderBy(F.desc("count"), "name")
    return ranked if n is None else ranked.limit(n)
