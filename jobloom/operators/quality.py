"""Data-quality summaries: one aggregate pass each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F

from jobloom.functions.common import as_col, number_column
from jobloom.operators.market import facet_counts


def ingestion_summary(raw: DataFrame) -> DataFrame:
    """Totals of a raw table, in one pass; sources are few and joined in name order.

    Names and dates are counted by value before their shuffle, so that their numbers and ends are those of
    short tables: beside distinct counts, the least and greatest text would make Spark sort every task's rows.
    """
    counts = facet_counts(
        raw, {name: F.col(name) for name in ("company", "location", "source", "posted_date")}, {"posting": F.lit(1)}
    )
    of = lambda facet: F.col("facet") == facet
    name_of = lambda facet: F.when(of(facet), F.col("name"))
    day = raw.schema["posted_date"].dataType
    return counts.agg(
        F.coalesce(F.sum(F.when(of("posting"), F.col("count"))), F.lit(0)).alias("total_records"),
        # One row per source is left here, whatever the table holds.
        F.array_join(F.array_sort(F.collect_list(name_of("source"))), ", ").alias("sources"),
        F.count_if(of("company")).alias("companies"),
        F.count_if(of("location")).alias("locations"),
        F.min(name_of("posted_date")).cast(day).alias("first_posted"),
        F.max(name_of("posted_date")).cast(day).alias("last_posted"),
    )


def cleaning_summary(clean: DataFrame) -> DataFrame:
    """Rows, those with a salary and with skills, and distinct names, in one pass."""
    skilled = F.when(F.col("skill_count") > 0, F.lit(1))
    totals = {"posting": F.lit(1), "paid": number_column(clean, "salary_min"), "skilled": skilled}
    counts = facet_counts(clean, {"company": F.col("company"), "location": F.col("location")}, totals)
    of = lambda facet: F.coalesce(F.sum(F.when(F.col("facet") == facet, F.col("count"))), F.lit(0))
    return counts.agg(
        of("posting").alias("records"), of("paid").alias("with_salary"), of("skilled").alias("with_skills"),
        F.count_if(F.col("facet") == "location").alias("locations"), F.count_if(F.col("facet") == "company").alias("companies"),
    )


def step_counters(clean: DataFrame) -> DataFrame:
    """What the single cleaning steps report, gathered in one pass."""

    def percent(part):
        return F.round(part * 100 / F.greatest(F.count(F.lit(1)), F.lit(1))).cast("int")

    return clean.agg(
        F.round(F.coalesce(F.avg(F.length("description")), F.lit(0.0))).cast("bigint").alias("mean_description_length"),
        F.count_if(F.col("posted_date").isNull()).alias("bad_dates"),
        F.min("posted_date").alias("first_posted"),
        F.max("posted_date").alias("last_posted"),
        F.count(number_column(clean, "salary_min")).alias("with_salary"),
        percent(F.count(number_column(clean, "salary_min"))).alias("salary_percent"),
        F.count_distinct("location").alias("locations"),
        percent(F.count_if("is_remote")).alias("remote_percent"),
    )


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per category, most frequent first."""
    return (
        df.groupBy(as_col(column).alias("name"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "name")
    )


def skill_stats(postings: DataFrame) -> DataFrame:
    """Mean and largest number of skills per posting, postings without any."""
    return postings.agg(
        F.round(F.avg("skill_count"), 1).alias("mean_skills"),
        F.max("skill_count").alias("max_skills"),
        F.count_if(F.col("skill_count") == 0).alias("zero_skill_jobs"),
    )


def step_row_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """Rows each step gives, one row per step in order."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(number).alias("step_no"), F.lit(name).alias("step"), "row_count"
        )
        for number, (name, df) in enumerate(steps.items(), 1)
    ]
    return reduce(DataFrame.unionByName, counts)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same frame, counting its rows on the side while another action runs."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("row_count")), watch
