"""Exact medians that never bring a column into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Coarse buckets per natural-log unit: values in one differ by less than 0.025 %.
_COARSE = 4096
# Fine buckets within a coarse one; for values of 1 and more, about two million
# different doubles fit in each, and of amounts in cents a handful.
_FINE = 1 << 20


def _coarse(value: Column) -> Column:
    """A never-falling whole number of the value.

    All finite numbers together have fewer than six million buckets, and amounts
    of money up to a billion fewer than 90,000, however many rows there are. The
    buckets are meant for amounts: all values below 0.000244 share one, in which only
    the fine buckets tell them apart.
    """
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * _COARSE)


def _fine(value: Column, low: Column, high: Column) -> Column:
    """Equal-width place of a value between the ends of its coarse bucket."""
    return F.when(high > low, F.floor((value - low) / (high - low) * _FINE)).otherwise(F.lit(0))


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Finite numbers of several columns as rows (metric, value)."""
    cells = [F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value")) for name in columns]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.abs("value") < float("inf"))


def _holding_middle(counted: DataFrame, order: list[str], start: Column) -> DataFrame:
    """Of counted groups in rising order, the one or two that hold the middle ranks.

    Adds `before`, the rank just in front of the group; `start` is that of the
    first group, and `count` the number of values of the metric.
    """
    rising = Window.partitionBy("metric").orderBy(*order)
    first_rank, last_rank = F.floor((F.col("count") + 1) / 2), F.floor((F.col("count") + 2) / 2)
    return counted.withColumn("before", start + F.sum("n").over(rising) - F.col("n")).where(
        (F.col("before") < last_rank) & (F.col("before") + F.col("n") >= first_rank)
    )


def coarse_counts(values: DataFrame, *by: str) -> DataFrame:
    """Values per metric and coarse bucket (`n`), with the least and greatest of each (`low`, `high`).

    With further columns in `by` the counts can be kept and merged later (`merged`).
    """
    return values.groupBy(*by, "metric", _coarse(F.col("value")).alias("coarse")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def merged(counts: DataFrame) -> DataFrame:
    """Kept counts as one row per metric and coarse bucket."""
    return counts.groupBy("metric", "coarse").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def middle_buckets(coarse: DataFrame) -> DataFrame:
    """The coarse buckets, two per metric at most, that hold the middle ranks, with the totals of their metric."""
    whole = Window.partitionBy("metric")
    totals = {"count": F.sum("n").over(whole), "smallest": F.min("low").over(whole), "largest": F.max("high").over(whole)}
    return _holding_middle(coarse.withColumns(totals), ["coarse"], F.lit(0)).drop("n")


def spread(values: DataFrame) -> DataFrame:
    """Per metric of (metric, value) rows: count, exact median, smallest and largest value.

    Ranks are narrowed down in three steps: rows per coarse bucket, then per fine
    bucket of the middle coarse ones, then per value of the middle fine ones.
    Every step counts before its shuffle, and only the short tables of counts
    are summed up in order. The input is read twice. The built-in exact
    percentile would gather all distinct values in one task instead.
    """
    return spread_within(values, middle_buckets(coarse_counts(values)))


def spread_within(values: DataFrame, middle: DataFrame) -> DataFrame:
    """`spread`, once the middle buckets are known: of the values, only those in these buckets count."""
    whole = Window.partitionBy("metric")
    # At most two groups per metric, here and below: always small enough to broadcast.
    in_middle = values.withColumn("coarse", _coarse(F.col("value"))).join(F.broadcast(middle), ["metric", "coarse"])
    carried = ("count", "smallest", "largest", "low", "high", "before")
    distinct = (
        in_middle.groupBy("metric", "coarse", "value")
        .agg(F.count(F.lit(1)).alias("n"), *[F.first(name).alias(name) for name in carried])
        .withColumn("fine", _fine(F.col("value"), F.col("low"), F.col("high")))
        .withColumnRenamed("before", "start")
    )
    fine = distinct.groupBy("metric", "coarse", "fine", "count").agg(
        F.sum("n").alias("n"), F.min("start").alias("start")
    )
    fine_middle = _holding_middle(fine, ["coarse", "fine"], F.min("start").over(whole)).select(
        "metric", "coarse", "fine", "before"
    )

    candidates = distinct.join(F.broadcast(fine_middle), ["metric", "coarse", "fine"])
    at_middle = _holding_middle(
        candidates.withColumnRenamed("before", "start_here"), ["value"], F.min("start_here").over(whole)
    )
    return at_middle.groupBy("metric").agg(
        *[F.first(name).alias(name) for name in ("count", "smallest", "largest")],
        ((F.min("value") + F.max("value")) / 2).alias("median"),
    )
