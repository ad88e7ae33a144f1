"""Salary figures, histograms, ranges and tables over clean postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobloom.functions.common import dollars, finite
from jobloom.operators.medians import long_values, spread

SERIES = ["salary_min", "salary_max"]


def with_salary(df: DataFrame) -> DataFrame:
    """Postings with a minimum; NaN and infinities count as missing in either bound.

    Spark holds NaN greater than any number, so the bounds are tested on both
    sides; both tests reach the scan.
    """
    for name in SERIES:
        if name in df.columns and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            whole = F.col(name) < float("inf")
            df = df.where(whole) if name == "salary_min" else df.withColumn(name, finite(F.col(name)))
    return df.where(F.col("salary_min") > 0)


def salary_metrics(df: DataFrame) -> DataFrame:
    """Count, exact medians of both bounds (0 where no maximum is known), full range."""
    return metrics_of(spread(long_values(with_salary(df), SERIES)))


def metrics_of(facts: DataFrame) -> DataFrame:
    """One row of figures from those of each bound."""

    def of(metric: str, column: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(column)))

    return facts.agg(
        F.coalesce(of("salary_min", "count"), F.lit(0)).alias("count"),
        of("salary_min", "median").alias("median_min"),
        F.coalesce(of("salary_max", "median"), F.lit(0.0)).alias("median_max"),
        of("salary_min", "smallest").alias("full_min"),
        F.max("largest").alias("full_max"),
    )


def _label(low: Column, high: Column) -> Column:
    return F.concat(dollars(low), F.lit("–"), dollars(high))


def _edge(low: Column, high: Column, place: Column, bins: int) -> Column:
    """Left edge of bin `place` of an equal-width grid; place = bins gives the end."""
    step = (high - low) / bins
    return F.when(place >= bins, high).otherwise(place * step + low)


def _bin_on_edges(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin by comparing with the edges; the division is only a first guess.

    The guess is off by at most one, so one comparison on each side settles it.
    """
    guess = F.least(F.floor((value - low) / ((high - low) / bins)), F.lit(bins - 1))
    moved = (
        guess
        - (value < _edge(low, high, guess, bins)).cast("int")
        + (value >= _edge(low, high, guess + 1, bins)).cast("int")
    )
    return F.greatest(F.least(moved, F.lit(bins - 1)), F.lit(0))


def _counts_by_bin(binned: DataFrame) -> DataFrame:
    """(bin, min_salary, max_salary) counts of (metric, bin, n) rows."""
    return binned.groupBy("bin").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("metric") == name, F.col("n"))), F.lit(0)).alias(label)
            for name, label in zip(SERIES, ("min_salary", "max_salary"))
        ]
    )


def _fill(grid: DataFrame, counts: DataFrame) -> DataFrame:
    return (
        grid.join(counts, "bin", "left")
        .select(
            F.col("bin").cast("int").alias("bin"),
            "range",
            *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in ("min_salary", "max_salary")],
        )
        .orderBy("bin")
    )


def _grid(df: DataFrame, n_bins: int) -> DataFrame:
    return df.sparkSession.range(n_bins).select(F.col("id").alias("bin"))


def salary_histogram(df: DataFrame, bins: int = 12) -> DataFrame:
    """Both bounds counted on one set of equal-width bins over all salary values.

    The last bin includes its right edge, and bins without postings stay. If all
    values are equal, the range is widened by half on either side.
    """
    paid = with_salary(df)
    ends = paid.agg(F.min(F.least(*SERIES)).alias("low"), F.max(F.greatest(*SERIES)).alias("high"))
    values = bin_of(F.col("value"), ends, bins, long_values(paid, SERIES))
    return histogram_of(values.select("metric", "bin", F.lit(1).cast("long").alias("n")), ends, bins)


def _widened(ends: DataFrame) -> Column:
    """The range to be cut into bins, as a scalar; a single value is widened by half on either side."""
    same = (F.col("low") == F.col("high")).cast("double") * 0.5
    return ends.select(F.struct((F.col("low") - same).alias("low"), (F.col("high") + same).alias("high")).alias("r")).scalar()


def bin_of(value: Column, ends: DataFrame, bins: int, rows: DataFrame) -> DataFrame:
    """Rows with the `bin` of a value on equal-width bins between the ends, one row (low, high)."""
    return rows.withColumn("r", _widened(ends)).withColumn("bin", _bin_on_edges(value, F.col("r.low"), F.col("r.high"), bins))


def histogram_of(binned: DataFrame, ends: DataFrame, bins: int) -> DataFrame:
    """All bins between the ends with their label and the sums of (metric, bin, n) rows."""
    low, high = F.col("r.low"), F.col("r.high")
    place = F.col("bin")
    grid = _grid(binned, bins).withColumn("r", _widened(ends)).where(low.isNotNull())
    labels = _label(_edge(low, high, place, bins), _edge(low, high, place + 1, bins))
    return _fill(grid.select("bin", labels.alias("range")), _counts_by_bin(binned))


def histogram_own_edges(df: DataFrame, bins: int = 12) -> DataFrame:
    """Variant: each bound is counted on bins over its own range.

    Labels show the bins over all values. A range of one single value has one
    bin, and the result is as long as the shorter of overall and minimum bins.
    """
    paid = with_salary(df)
    ranges = paid.agg(
        F.min("salary_min").alias("low_min"),
        F.max("salary_min").alias("high_min"),
        F.min("salary_max").alias("low_max"),
        F.max("salary_max").alias("high_max"),
    ).select(
        F.struct(
            F.least("low_min", "low_max").alias("low"),
            F.greatest("high_min", "high_max").alias("high"),
            "low_min", "high_min", "low_max", "high_max",
        ).alias("r")
    ).scalar()
    values = long_values(paid, SERIES).withColumn("r", ranges)
    is_min = F.col("metric") == "salary_min"
    low = F.when(is_min, F.col("r.low_min")).otherwise(F.col("r.low_max"))
    high = F.when(is_min, F.col("r.high_min")).otherwise(F.col("r.high_max"))
    width = (high - low) / bins
    place = F.when(high == low, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - low) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    )
    counts = _counts_by_bin(values.select("metric", place.alias("bin"), F.lit(1).cast("long").alias("n")))
    single = F.col("r.low_min") == F.col("r.high_min")
    low_all, high_all = F.col("r.low"), F.col("r.high")
    grid = _grid(df, bins).withColumn("r", ranges).where(
        low_all.isNotNull() & ((F.col("bin") == 0) | ~single)
    )
    left = F.col("bin") * ((high_all - low_all) / bins) + low_all
    right = F.when(low_all == high_all, high_all + 1).otherwise(
        _edge(low_all, high_all, F.col("bin") + 1, bins)
    )
    return _fill(grid.select("bin", _label(left, right).alias("range")), counts)


def _highest(df: DataFrame, n: int | None, key: str) -> DataFrame:
    ordered = df.orderBy(F.desc("salary_min"), key)
    return ordered if n is None else ordered.limit(n)


def salary_ranges(df: DataFrame, n: int = 15, key: str = "job_id", keep_key: bool = False) -> DataFrame:
    """The `n` postings with both bounds and the highest minimum, shown ascending."""
    both = with_salary(df).where(F.col("salary_max").isNotNull())
    label = F.concat(F.substring("title", 1, 28), F.lit(" — "), F.substring("company", 1, 12))
    return (
        _highest(both, n, key)
        .orderBy("salary_min", key)
        .select(
            *([F.col(key).alias("job_id")] if keep_key else []),
            label.alias("label"), F.col("salary_min").alias("min"), F.col("salary_max").alias("max"),
        )
    )


def range_bars(df: DataFrame, n: int = 15, key: str = "job_id") -> DataFrame:
    """Left offset and width of each salary range in percent of the full range.

    Widths are at least 1.5; with a full range of zero both are null.
    """
    full = with_salary(df).agg(
        F.struct(F.min("salary_min").alias("low"), F.max(F.greatest(*SERIES)).alias("high")).alias("r")
    ).scalar()
    bars = salary_ranges(df, n, key).withColumn("r", full)
    span = F.nullif(F.col("r.high") - F.col("r.low"), F.lit(0.0))
    width = (F.col("max") - F.col("min")) / span * 100
    return bars.select(
        "label",
        "min",
        "max",
        ((F.col("min") - F.col("r.low")) / span * 100).alias("left_percent"),
        F.when(width.isNotNull(), F.greatest(width, F.lit(1.5))).alias("width_percent"),
    )


def salary_table(df: DataFrame, n: int | None = 50, key: str = "job_id", keep_key: bool = False) -> DataFrame:
    """Postings with the highest minimum salary; `n=None` gives all of them."""
    columns = [key] if keep_key else []
    columns += [c for c in ("title", "company", "location", "salary", *SERIES) if c in df.columns]
    return _highest(with_salary(df), n, key).select(*columns)
