"""The dashboard from stored summaries: counts by day and location, merged when a question is asked.

A summary holds, per day and location, the postings by company, work mode, skill and pair of skills, sums
of their figures, and how many salaries lie in each narrow band. All of that adds up, so any choice of locations
and days is answered from rows of the summary, exactly: names are kept, not sketched. The postings
themselves are read only where values matter: the one band that holds a median, the bands that an
edge of the histogram cuts, and the few best paid; each by bounds that reach the scan.

Summaries are kept in buckets by month. New postings cost the months they fall into.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobloom.operators import market, medians, salaries, skill_demand
from jobloom.plans import dashboard
from jobloom.sources.buckets import BucketedTable
from jobloom.sources.storage import MONTH, month_number

_DAY = "posted_date"
_BY = (MONTH, _DAY, "location")
_RANGED = "ranged"


def _prepared(postings: DataFrame) -> DataFrame:
    narrow = market.prepare(postings.select(*[c for c in dashboard.COLUMNS if c in postings.columns]))
    return narrow.withColumn(MONTH, month_number(F.col(_DAY)))


def counts_of(postings: DataFrame) -> DataFrame:
    """(month, day, location, facet, name, other, n, total): what adds up over prepared postings, in one pass and one shuffle.

    `other` is the second skill of a pair; `total` is a sum of figures beside the number of rows that have one.
    """
    moded = market.with_work_mode(postings)
    has = set(postings.columns)

    def cell(facet: str, name: Column | str = "", other: Column | None = None, total: Column | None = None) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        empty = F.lit(None).cast("string")
        return F.struct(
            F.lit(facet).alias("facet"), name.cast("string").alias("name"), (empty if other is None else other).alias("other"),
            (F.lit(None) if total is None else total).cast("double").alias("total"),
        )

    def each(facet: str, given: Column, name: Column, **more: Column) -> Column:
        return F.when(given.isNotNull(), F.array(cell(facet, name, **more))).otherwise(F.array())

    parts = [
        F.array(cell("posting"), cell("mode", F.col("work_mode"))), each("company", F.col("company"), F.col("company")),
    ]
    if "skill_count" in has:
        parts.append(each("skill_count", F.col("skill_count"), F.lit(""), total=F.col("skill_count")))
    if "salary_min" in has:
        parts.append(each("paid", F.col("salary_min"), F.lit("")))
    if "skills" in has:
        moded = moded.withColumn("_skills", skill_demand.skill_array(postings))
        parts.append(F.transform("_skills", lambda s: cell("skill", s)))
        parts.append(F.transform(skill_demand.unordered_pairs("_skills"), lambda p: cell("pair", p["a"], p["b"])))
    cells = moded.select(*_BY, F.inline(F.concat(*parts)))
    return cells.groupBy(*_BY, "facet", "name", "other").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("total"))


def amounts_of(postings: DataFrame) -> DataFrame:
    """(month, day, location, metric, coarse, n, low, high): salaries of paid postings by narrow band.

    The metric `ranged` holds the minimum of those that have a maximum too.
    """
    paid = salaries.with_salary(postings)
    ranged = F.when(F.col("salary_max").isNotNull(), F.col("salary_min"))
    named = {name: F.col(name) for name in salaries.SERIES} | {_RANGED: ranged}
    cells = [F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value")) for name, value in named.items()]
    values = paid.select(*_BY, F.inline(F.array(*cells))).where(F.abs("value") < float("inf"))
    return medians.coarse_counts(values, *_BY)


class Summary:
    """Stored summaries of one table of clean postings; see the head of this module."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = 32):
        self._spark = spark
        self.counts = BucketedTable(spark, f"{base}/counts", MONTH, buckets, filters=False)
        self.amounts = BucketedTable(spark, f"{base}/amounts", MONTH, buckets, filters=False)

    def update(self, postings: DataFrame, months: Iterable[int | None] | None = None) -> None:
        """Summarise the postings anew: all months, or those given (as year * 100 + month, None: no date).

        Give the months of postings that came, changed (before and after) or went. Postings stored by month are
        read in their folders only.
        """
        if months is None:
            whole = _prepared(postings)
            self.counts.replace(counts_of(whole))
            if "salary_min" in whole.columns:
                self.amounts.replace(amounts_of(whole))
            return
        months = list(dict.fromkeys(months))
        if not months:
            return
        if MONTH in postings.columns:
            postings = postings.where(self._among(months))
        chosen = _prepared(postings).where(self._among(months))
        for table, of in ((self.counts, counts_of), (self.amounts, amounts_of)):
            if of is amounts_of and "salary_min" not in chosen.columns:
                continue
            touched = self._touched(table, months)
            kept, fresh = table.read(touched), of(chosen)
            if kept is not None:
                fresh = kept.where(~self._among(months)).unionByName(fresh)
            table.replace(fresh, touched)

    @staticmethod
    def _among(months: list[int | None]) -> Column:
        known = [month for month in months if month is not None]
        among = F.coalesce(F.col(MONTH).isin(known), F.lit(False)) if known else F.lit(False)
        return among | F.col(MONTH).isNull() if None in months else among

    def _touched(self, table: BucketedTable, months: list[int | None]) -> list[int]:
        rows = F.explode(F.array(*[F.lit(month).cast("int") for month in months])).alias(MONTH)
        return table.touched(self._spark.range(1).select(rows))

    def _chosen(self, table: BucketedTable, locations: Iterable[str], date_from: str | None, date_to: str | None) -> DataFrame:
        buckets = None
        if date_from and date_to:
            first, last = (int(day[:4]) * 12 + int(day[5:7]) - 1 for day in (date_from, date_to))
            buckets = self._touched(table, [at // 12 * 100 + at % 12 + 1 for at in range(first, last + 1)]) if last >= first else []
        stored = table.read(buckets)
        if stored is None:
            raise ValueError("nothing has been summarised yet")
        return market.filter_postings(stored, locations, date_from, date_to)

    def facets(self, locations: Iterable[str] = (), date_from: str | None = None, date_to: str | None = None) -> DataFrame:
        """Rows (facet, name, other, count, total) of the chosen days and locations; those of `market.facet_counts` among them."""
        rows = self._chosen(self.counts, list(locations), date_from, date_to)
        same = F.struct("facet", "name", "other", "n", "total")
        named = lambda facet, name: F.struct(
            F.lit(facet).alias("facet"), name.cast("string").alias("name"), F.lit(None).cast("string").alias("other"), "n", "total"
        )
        of_posting = F.array(same, named("location", F.col("location")), named("day", F.col(_DAY)))
        remote = F.array(same, named("remote_location", F.col("location")))
        cells = F.when(F.col("facet") == "posting", of_posting).when(
            (F.col("facet") == "mode") & (F.col("name") == "Remote"), remote
        ).otherwise(F.array(same))
        found = rows.select(F.inline(cells)).where(F.col("name").isNotNull())
        return found.groupBy("facet", "name", "other").agg(F.sum("n").alias("count"), F.sum("total").alias("total"))

    def options(self) -> DataFrame:
        """The locations and days to choose from."""
        rows = self.counts.read().where("facet = 'posting'")
        return dashboard.filter_options(rows.select("location", _DAY))

    def board(
        self, postings: DataFrame, locations: Iterable[str] = (), date_from: str | None = None, date_to: str | None = None,
        sizes: dashboard.Sizes = dashboard.Sizes(),
    ) -> dict[str, DataFrame]:
        """All sections of the dashboard over the chosen postings, which are the ones summarised.

        Of the postings, only the rows named at the head of this module are read.
        """
        locations = list(locations)
        facets = self.facets(locations, date_from, date_to)
        counts = facets.select("facet", "name", "count", "total")
        month = [MONTH] if MONTH in postings.columns else []
        narrow = postings.select(*[c for c in dashboard.COLUMNS if c in postings.columns], *month)

        def chosen(bound: Column | None = None) -> DataFrame:
            """The chosen postings; a bound on stored numbers comes before they are prepared, so that it reaches the scan."""
            stored = all(isinstance(narrow.schema[name].dataType, T.NumericType) for name in salaries.SERIES if name in narrow.columns)
            bounded = narrow if bound is None or not stored else narrow.where(bound)
            return market.filter_postings(market.prepare(bounded), locations, date_from, date_to).drop(MONTH)

        parts = dashboard.sections(chosen(), counts, sizes, self.options())
        if "skill_cooccurrence" in parts:
            parts["skill_cooccurrence"] = _pairs(facets, sizes.pairs)
        if "salary_metrics" in parts:
            all_bands = medians.merged(self._chosen(self.amounts, locations, date_from, date_to))
            bands = all_bands.where(F.col("metric") != _RANGED)
            best = lambda metric, n: chosen(_best_paid(all_bands.where(F.col("metric") == metric), n))
            parts["salary_metrics"] = _salary_metrics(chosen, bands)
            parts["salary_histogram"] = _histogram(chosen, bands, sizes.bins)
            parts["salary_ranges"] = salaries.salary_ranges(best(_RANGED, sizes.ranges), sizes.ranges, keep_key=True)
            parts["salary_table"] = salaries.salary_table(best("salary_min", sizes.table), sizes.table, keep_key=True)
        return parts


def _pairs(facets: DataFrame, n: int | None) -> DataFrame:
    pairs = facets.where("facet = 'pair'").select(F.col("name").alias("a"), F.col("other").alias("b"), "count")
    return skill_demand.label_pairs(pairs, n)


_Chosen = Callable[[Column | None], DataFrame]


def _in_bands(chosen: _Chosen, bands: list) -> DataFrame:
    """(metric, value) of the salaries in some bands, (metric, low, high) each."""
    within = {
        name: reduce(or_, [F.col(name).between(band["low"], band["high"]) for band in bands if band["metric"] == name], F.lit(False))
        for name in salaries.SERIES
    }
    paid = salaries.with_salary(chosen(reduce(or_, within.values())))
    return medians.long_values(paid.select(*[F.when(inside, F.col(name)).alias(name) for name, inside in within.items()]), salaries.SERIES)


def _salary_metrics(chosen: _Chosen, bands: DataFrame) -> DataFrame:
    """`salaries.salary_metrics`, of which only the bands with the middle ranks are read: two per bound at most."""
    found = medians.middle_buckets(bands)
    middle = found.collect()
    kept = bands.sparkSession.createDataFrame(middle, found.schema)
    return salaries.metrics_of(medians.spread_within(_in_bands(chosen, middle), kept))


def _histogram(chosen: _Chosen, bands: DataFrame, bins: int) -> DataFrame:
    """`salaries.salary_histogram`: bands within a bin are counted whole, the few that an edge cuts are read."""
    ends = bands.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    first = salaries.bin_of(F.col("low"), ends, bins, bands)
    placed = first.withColumnRenamed("bin", "first").drop("r")
    placed = salaries.bin_of(F.col("high"), ends, bins, placed).withColumnRenamed("bin", "last").drop("r")
    cut = placed.where("first <> last").select("metric", "low", "high").collect()
    single = salaries.bin_of(F.col("value"), ends, bins, _in_bands(chosen, cut)).select("metric", "bin", F.lit(1).cast("long").alias("n"))
    whole = placed.where("first = last").select("metric", F.col("first").alias("bin"), "n")
    return salaries.histogram_of(whole.unionByName(single), ends, bins)


def _best_paid(bands: DataFrame, n: int | None) -> Column | None:
    """A bound that the `n` best paid postings reach, if there are as many."""
    reached = 0
    for band in [] if n is None else bands.orderBy(F.desc("coarse")).limit(n).collect():
        reached += band["n"]
        if reached >= n:
            return F.col("salary_min") >= band["low"]
    return None
