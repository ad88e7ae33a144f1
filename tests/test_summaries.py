"""The board from stored summaries: equal to the direct one, and what it reads."""

import random

import pytest
from pyspark.sql import functions as F

from jobloom.plans import dashboard as board
from jobloom.plans.summaries import Summary
from jobloom.sources import storage

SCHEMA = (
    "job_id string, title string, company string, location string, posted_date date, work_mode string, salary_min double,"
    " salary_max double, skills string, skill_count int"
)


def made(draw, count, first=0):
    import datetime

    rows = []
    for i in range(first, first + count):
        day = None if draw.random() < 0.05 else datetime.date(2024, 1, 1) + datetime.timedelta(days=draw.randint(0, 180))
        low = draw.choice([None, float("nan"), 0.0, *[round(draw.uniform(20_000, 90_000), 2) for _ in range(9)]])
        high = None if low is None or draw.random() < 0.4 else low * 1.5
        skills = draw.choice([None, "", ", ".join(draw.sample(["python", "sql", "go", "rust", "ci/cd"], draw.randint(1, 5)))])
        rows.append((
            f"j{i}", "Title", draw.choice([None, "Acme", "Globex", f"c{draw.randint(0, 40)}"]), draw.choice([None, "", "Remote", "Oslo", f"town {draw.randint(0, 9)}"]),
            day, draw.choice(["Remote", "Onsite", "", None]), low, high, skills, None if skills is None else len([s for s in skills.split(",") if s]),
        ))
    return rows


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Stored postings, and their summary, whose last months were added later."""
    base = str(tmp_path_factory.mktemp("summaries"))
    draw = random.Random(4)
    early = spark.createDataFrame(made(draw, 700), SCHEMA)
    late = spark.createDataFrame(made(draw, 500, 700), SCHEMA).where("posted_date >= '2024-04-01' or posted_date is null")
    summary = Summary(spark, f"{base}/summary", buckets=4)
    storage.write_by_month(early, f"{base}/early")
    summary.update(spark.read.parquet(f"{base}/early"))
    storage.write_by_month(early.unionByName(late), f"{base}/all")
    stored = spark.read.parquet(f"{base}/all")
    summary.update(stored, [202404, 202405, 202406, None])
    return summary, stored, base


def shown(parts):
    """The sections that come from summaries or by bounds out of them."""
    return {name: [tuple(r) for r in part.collect()] for name, part in parts.items() if name not in ("top_locations", "skill_totals")}


@pytest.mark.parametrize(
    "filters",
    [(["Remote", "Oslo", "town 3"], "2024-03-15", "2024-05-02"), ([], "2024-05-01", "2024-04-01")],
)
def test_equal_to_the_direct_board(world, filters):
    summary, stored, _ = world
    with board.Dashboard(stored, *filters) as direct:
        expected = shown(direct.sections)
    assert shown(summary.board(stored, *filters)) == expected


def test_other_sizes(world):
    summary, stored, _ = world
    sizes = board.Sizes(top=3, pairs=None, ranges=4, table=None, bins=3)
    with board.Dashboard(stored, sizes=sizes) as direct:
        expected = shown(direct.sections)
    assert shown(summary.board(stored, sizes=sizes)) == expected


def test_months_added_are_as_good_as_all_anew(spark, world):
    summary, stored, base = world
    whole = Summary(spark, f"{base}/whole", buckets=4)
    whole.update(stored)
    rows = lambda table: sorted((tuple(r) for r in table.read().select(*sorted(table.read().columns)).collect()), key=str)
    for name in ("counts", "amounts"):
        assert rows(getattr(summary, name)) == rows(getattr(whole, name))
    # Postings that went take their counts with them.
    whole.update(stored.where("posted_date >= '2024-02-01'"), [202401, None])
    left = whole.counts.read().where("posted_date is null or posted_date < '2024-02-01'")
    assert left.count() == 0 and whole.counts.read().count() > 0
    whole.update(stored, [])


def test_a_month_costs_its_own_buckets(spark, world):
    summary, stored, base = world
    table = Summary(spark, f"{base}/buckets", buckets=16)
    table.update(stored)
    touched = table._touched(table.counts, [202403])
    table.update(stored, [202403])
    log = table.counts._log()
    assert len(touched) == 1 and log[-1]["filled"] == touched and len(log[0]["filled"]) > 3
    chosen = table._chosen(table.counts, [], "2024-03-01", "2024-03-31")
    assert len(chosen.inputFiles()) == 1


def test_counts_do_not_read_postings(spark, world):
    summary, stored, base = world
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    parts = summary.board(stored, ["Remote"], "2024-02-01", "2024-05-31")
    reads = {name: any(f"{base}/all" in f for f in part.inputFiles()) for name, part in parts.items()}
    # The histogram reads postings only if an edge cuts a band.
    assert {name for name, read in reads.items() if read} - {"salary_histogram"} == {"salary_metrics", "salary_ranges", "salary_table"}
    for name in ("salary_metrics", "salary_table", "salary_ranges"):
        text = parts[name]._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in text.splitlines() if "FileScan parquet" in line and f"{base}/all" in line]
        assert scans
        for scan in scans:
            pushed = scan.split("PushedFilters: ")[1]
            assert "GreaterThanOrEqual(salary_min" in pushed.replace("(salary_min,0.0)", "") and "PartitionFilters: [isnotnull(posted_month" in scan


def test_nothing_summarised_yet(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing has been summarised"):
        Summary(spark, str(tmp_path / "none")).facets()
