"""Keep one row per key, and dense numbering without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from jobloom.sources.storage import shared_folder

_PLACE_BITS = 33  # of monotonically_increasing_id: the partition is above


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def content_order(df: DataFrame) -> Column:
    """A number that depends on a row's content alone: rows with equal ones are, but for 64-bit collisions, equal.

    Columns that cannot be hashed (maps, variants) do not count.
    """
    return F.xxhash64(*[F.col(f"`{field.name}`") for field in df.schema if _hashable(field.dataType)])


def dedupe_first(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order; where that does not decide, the content does.

    So a task that runs again, or another partitioning, chooses the same row. Written as `row_number() = 1`, which Spark turns into a group limit before
    the shuffle: each task sends at most one row per key, so one key holding a
    large part of the table does not pile up in one task.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order, content_order(df)))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def dedupe_last(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return dedupe_first(df, key, [F.desc(name) for name in order])


def dedupe(df: DataFrame, key: str = "job_id", order: list[str] | None = None) -> DataFrame:
    """One row per key: the first in `order`; without one, or where rows tie, the content decides."""
    return dedupe_first(df, key, order or [])


def dedupe_counts(df: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows before and after `dedupe`, and how many it drops.

    Counting per key first keeps the work in partial aggregates; null keys make
    one group, as in `dedupe`.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    )
    return totals.withColumn("dropped", F.col("rows_before") - F.col("rows_after"))


def number_rows(df: DataFrame, order: list[Column], number: str, purpose: str = "numbered") -> DataFrame:
    """Number rows 1..n in the given order, which tells any two rows apart.

    The rows are range-partitioned, sorted and written once with their place in
    the partition; only a table with one row per partition is summed up in one task.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    within = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1) + 1
    return (
        placed.join(sizes.select("_part", before.alias("_before")), "_part")
        .withColumn(number, F.col("_before") + within)
        .drop("_part", "_place", "_before")
    )


def number_by_name(names: DataFrame, column: str, number: str) -> DataFrame:
    """Number distinct names 1..n in name order."""
    return number_rows(names, [F.asc(column)], number, "names")
