"""The dashboard query: one filter, all sections from one kept copy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.operators import market, salaries, skill_demand
from jobloom.operators.keyed import number_rows
from jobloom.sources.storage import MONTH

COLUMNS = (
    "job_id", "title", "company", "location", "posted_date", "work_mode",
    "salary_min", "salary_max", "skills", "skill_count",
)
NO_DATA = "No data available. Run the ingestion and cleaning first."


def _facets(postings: DataFrame) -> DataFrame:
    """Everything the sections count by name, in one pass."""
    moded = market.with_work_mode(postings)
    facets = {
        "location": F.col("location"),
        "company": F.col("company"),
        "day": F.col("posted_date"),
        "mode": F.col("work_mode"),
        "remote_location": F.when(F.col("work_mode") == "Remote", F.col("location")),
    }
    if "skills" in postings.columns:
        facets["skill"] = skill_demand.skill_array(postings)
    return market.facet_counts(moded, facets, market.headline_totals(moded))


@dataclass(frozen=True)
class Sizes:
    """How many rows the ranked sections show."""

    top: int = 12
    pairs: int | None = 15
    ranges: int = 15
    table: int | None = 50
    bins: int = 12


# What each section is ordered by; the rest decides nothing or is one row.
_BY_COUNT = (("count", True), ("name", False))
ORDER = {
    "filter_options": (("option", False),),
    "top_locations": _BY_COUNT,
    "top_companies": _BY_COUNT,
    "remote_locations": _BY_COUNT,
    "timeline": (("date", False),),
    "work_mode_split": (("count", True), ("mode", False)),
    "skill_rankings": (("demand", True), ("skill", False)),
    "skill_cooccurrence": (("count", True), ("pair", False)),
    "salary_histogram": (("bin", False),),
    "salary_ranges": (("min", False), ("job_id", False)),
    "salary_table": (("salary_min", True), ("job_id", False)),
}


def sections(postings: DataFrame, counts: DataFrame, sizes: Sizes = Sizes(), options: DataFrame | None = None) -> dict[str, DataFrame]:
    """All sections of prepared, filtered postings and their facet counts; all lazy.

    `options` are the rows of the filter that was offered, if they are to be shown.
    """
    days = counts.where(F.col("facet") == "day")
    modes = market.facet(counts, "mode").withColumnRenamed("name", "mode")
    parts = {} if options is None else {"filter_options": options}
    parts |= {
        "metrics": market.headline_of(counts),
        "top_locations": market.facet(counts, "location", sizes.top),
        "top_companies": market.facet(counts, "company", sizes.top),
        "timeline": days.select(F.col("name").cast("date").alias("date"), "count").orderBy("date"),
        "work_mode_split": market.with_share(modes),
        "remote_locations": market.facet(counts, "remote_location", sizes.top),
    }
    if "skills" in postings.columns:
        demand = market.facet(counts, "skill").toDF("skill", "demand")
        parts |= {
            "skill_rankings": skill_demand.label_rankings(demand),
            "skill_totals": skill_demand.sum_demand(demand),
            "skill_cooccurrence": skill_demand.skill_cooccurrence(postings, sizes.pairs),
        }
    if "salary_min" in postings.columns:
        parts |= {
            "salary_metrics": salaries.salary_metrics(postings),
            "salary_histogram": salaries.salary_histogram(postings, sizes.bins),
            "salary_ranges": salaries.salary_ranges(postings, sizes.ranges, keep_key=True),
            "salary_table": salaries.salary_table(postings, sizes.table, keep_key=True),
        }
    return parts


def filter_options(postings: DataFrame) -> DataFrame:
    """Locations to choose from, each with the first and last day of all postings."""
    bounds = market.date_range(postings).select(F.struct("first_date", "last_date").alias("r")).scalar()
    options = market.location_options(postings).withColumn("r", bounds)
    return options.select(F.col("location").alias("option"), "r.first_date", "r.last_date")


class Dashboard:
    """Sections over one persisted copy of the filtered postings and of their counts.

    Only the columns the sections read are kept. Lost blocks are computed again
    from the source. Use as a context manager, or call `close()`, to let go.
    """

    def __init__(
        self,
        postings: DataFrame,
        locations: Iterable[str] = (),
        date_from: str | None = None,
        date_to: str | None = None,
        sizes: Sizes = Sizes(),
    ):
        narrow = market.prepare(postings.select(*[c for c in (*COLUMNS, MONTH) if c in postings.columns]))
        chosen = market.filter_postings(narrow, locations, date_from, date_to).drop(MONTH)
        self.postings = chosen.persist(StorageLevel.MEMORY_AND_DISK)
        self.counts = _facets(self.postings).persist(StorageLevel.MEMORY_AND_DISK)
        self.sections = sections(self.postings, self.counts, sizes, filter_options(narrow))

    def __enter__(self) -> Dashboard:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        self.counts.unpersist()
        self.postings.unpersist()


@contextmanager
def dashboard(postings: DataFrame, *filters, **options) -> Iterator[dict[str, DataFrame]]:
    """Sections by name while the context lasts, or a single `error` record if the stored table is empty."""
    if postings.isEmpty():
        yield {"error": postings.sparkSession.range(1).select(F.lit(NO_DATA).alias("error"))}
        return
    with Dashboard(postings, *filters, **options) as board:
        yield board.sections


# Sections that are not cut to a number of rows: they grow with the names and days there are.
_WHOLE = {"filter_options": None, "timeline": None, "skill_rankings": None, "salary_table": "table", "skill_cooccurrence": "pairs"}


def with_position(section: str, part: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """The section with the place of each row, from 1.

    Sections cut to `sizes` are short and numbered in one window; the others are numbered over range partitions.
    """
    keys = [F.desc_nulls_last(name) if down else F.asc(name) for name, down in ORDER.get(section, ())]
    if section in _WHOLE and (_WHOLE[section] is None or getattr(sizes, _WHOLE[section]) is None):
        return number_rows(part, keys, "position").withColumn("position", F.col("position").cast("int"))
    place = F.row_number().over(Window.orderBy(*keys)) if keys else F.lit(1)
    return part.withColumn("position", place)


def write_sections(parts: dict[str, DataFrame], path: str, sizes: Sizes = Sizes()) -> None:
    """Each section in its own folder and schema, as JSON lines in order of position."""
    for section, part in parts.items():
        with_position(section, part, sizes).write.mode("overwrite").json(f"{path}/{section}")


def as_rows(parts: dict[str, DataFrame], sizes: Sizes = Sizes()) -> DataFrame:
    """All sections in one long frame: (section, position, measure, text, value).

    Every cell is a row: texts and days in `text`, numbers in `value`. Cells of
    one row share section and position, so nothing is lost.
    """

    def cells(section: str, part: DataFrame) -> DataFrame:
        def cell(name: str, kind: str) -> Column:
            is_text = kind in ("string", "date")
            return F.struct(
                F.lit(name).alias("measure"),
                (F.col(name).cast("string") if is_text else F.lit(None).cast("string")).alias("text"),
                (F.lit(None).cast("double") if is_text else F.col(name).cast("double")).alias("value"),
            )

        each = F.explode(F.array(*[cell(name, kind) for name, kind in part.dtypes]))
        placed = with_position(section, part, sizes).select(F.lit(section).alias("section"), "position", each.alias("cell"))
        return placed.select("section", "position", "cell.*")

    return reduce(DataFrame.unionByName, [cells(section, part) for section, part in parts.items()])
