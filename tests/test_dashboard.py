"""The three-row fixture and its published expectations, and small cases by hand."""

import datetime
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.operators import market, medians, salaries, skill_demand
from jobloom.plans.dashboard import Dashboard, Sizes, as_rows, dashboard


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_all_sections(three_postings):
    with Dashboard(three_postings) as board:
        parts = {name: part.collect() for name, part in board.sections.items()}
        cells = as_rows(board.sections)
        table = cells.where("section = 'salary_table'").groupBy("position").pivot("measure", ["job_id", "company", "salary_min", "salary_max"])
        shown = table.agg(F.first(F.coalesce("text", F.col("value").cast("string")))).orderBy("position").collect()
        assert [tuple(r)[1:] for r in shown] == [("a2", "Globex", "110000.0", "150000.0"), ("a1", "Acme", "90000.0", "130000.0")]
    with Dashboard(three_postings, sizes=Sizes(top=1, pairs=2, ranges=1, table=1)) as board:
        assert [board.sections[n].count() for n in ("top_companies", "skill_cooccurrence", "salary_ranges", "salary_table")] == [1, 2, 1, 1]
    metrics = parts["metrics"][0]
    assert (metrics["total_jobs"], metrics["companies"], metrics["locations"]) == (3, 2, 2)
    assert (metrics["avg_skills"], metrics["with_salary"]) == (2.7, 2)
    assert [tuple(r) for r in parts["top_locations"]] == [("Remote", 2), ("New York", 1)]
    assert [tuple(r) for r in parts["top_companies"]] == [("Acme", 2), ("Globex", 1)]
    assert [tuple(r) for r in parts["timeline"]] == [(datetime.date(2025, 3, day), 1) for day in (1, 2, 3)]
    assert tuple(parts["skill_rankings"][0]) == ("Python", 3)
    assert tuple(parts["skill_totals"][0]) == (8, 5)
    assert tuple(parts["skill_cooccurrence"][0]) == ("Docker + Python", 2)
    salary = parts["salary_metrics"][0]
    assert tuple(salary) == (2, 100000.0, 140000.0, 90000.0, 150000.0)
    assert sum(r["min_salary"] for r in parts["salary_histogram"]) == 2
    assert [r["option"] for r in parts["filter_options"]] == ["New York", "Remote"]
    assert [r["label"] for r in parts["salary_ranges"]] == ["Data Engineer — Acme", "Backend Dev — Globex"]
    assert [r["salary_min"] for r in parts["salary_table"]] == [110000.0, 90000.0]
    assert [tuple(r) for r in parts["work_mode_split"]] == [("Remote", 2, 66.7), ("Onsite", 1, 33.3)]
    assert [tuple(r) for r in parts["remote_locations"]] == [("Remote", 2)]


def test_sections_agree_with_single_operators(three_postings):
    with Dashboard(three_postings) as board:
        kept, parts = board.postings, board.sections
        pairs = skill_demand.posting_skills(kept)
        assert rows(parts["metrics"]) == rows(market.headline_metrics(kept))
        assert rows(parts["top_companies"]) == rows(market.top_values(kept, "company"))
        assert rows(parts["timeline"]) == rows(market.timeline(kept))
        assert rows(parts["work_mode_split"]) == rows(market.work_mode_split(kept))
        assert rows(parts["remote_locations"]) == rows(market.remote_locations(kept))
        assert rows(parts["skill_rankings"]) == rows(skill_demand.skill_rankings(pairs))
        assert rows(parts["skill_totals"]) == rows(skill_demand.skill_totals(pairs))


def test_filters(three_postings):
    with Dashboard(three_postings, locations=["Remote"]) as board:
        assert board.sections["metrics"].first()["total_jobs"] == 2
    with Dashboard(three_postings, date_from="2025-03-02", date_to="2025-03-03") as board:
        assert board.sections["metrics"].first()["total_jobs"] == 2


def test_null_date_fails_any_bound(three_postings):
    undated = market.prepare(three_postings.withColumn("posted_date", F.lit("soon")))
    assert market.filter_postings(undated).count() == 3
    assert market.filter_postings(undated, date_from="1990-01-01").count() == 0
    assert market.timeline(undated).count() == 0


def test_empty_selection(three_postings):
    with Dashboard(three_postings, locations=["Nowhere"]) as board:
        assert board.sections["metrics"].first()["total_jobs"] == 0
        assert board.sections["salary_metrics"].first()["count"] == 0
        for name in ("salary_histogram", "skill_rankings", "timeline", "work_mode_split"):
            assert board.sections[name].count() == 0
    with dashboard(three_postings.limit(0)) as parts:
        assert list(parts) == ["error"]


def test_options_and_search(three_postings):
    assert rows(market.location_options(three_postings)) == [("New York",), ("Remote",)]
    assert rows(market.search_locations(three_postings, "YORK")) == [("New York",)]
    assert rows(market.date_range(three_postings)) == [("2025-03-01", "2025-03-03")]


def test_ties_go_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "company string")
    assert rows(market.top_values(df, "company", 2)) == [("c", 2), ("a", 1)]


def test_stored_work_mode_wins(spark):
    df = spark.createDataFrame(
        [("Remote", "Onsite"), ("Worldwide", ""), ("Anywhere", None), ("Oslo", "Remote")], "location string, work_mode string"
    )
    got = [r["work_mode"] for r in market.with_work_mode(df).collect()]
    assert got == ["Onsite", "Remote", "Onsite", "Remote"]


def test_ranked_top_n_gives_n(spark):
    pairs = spark.range(100).select(F.col("id").alias("job_id"), F.concat(F.lit("s"), F.col("id") % 50).alias("skill"))
    assert skill_demand.ranked_top_n(pairs, 1).count() == 1
    assert skill_demand.ranked_top_n(pairs, 49).count() == 49
    with pytest.raises(ValueError):
        skill_demand.ranked_top_n(pairs, 0)
    first = skill_demand.ranked_top_n(pairs).first()
    assert (first["position"], first["skill"], first["demand"]) == (1, "S0", 2)


def test_pair_counts_add_up(spark):
    pairs = spark.range(3000).select(
        (F.col("id") % 70).alias("job_id"), F.concat(F.lit("s"), F.col("id") * 7 % 13).alias("skill")
    )
    sets = skill_demand.skill_sets(pairs)
    sizes = [len(r["skills"]) for r in sets.collect()]
    total = sum(r["count"] for r in skill_demand.skill_cooccurrence(sets, None).collect())
    assert total == sum(k * (k - 1) // 2 for k in sizes)


SAMPLES = {
    "one": [5.0],
    "two": [1.0, 2.0],
    "all equal": [3.5] * 40,
    "hot value": [100.0] * 500 + list(range(1, 400)),
    "outlier": [50000.01, 50000.02, 50000.03, 1e12],
    "close together": [100000 + i / 1024 for i in range(501)],
    "spread out": list(np.random.default_rng(3).lognormal(11, 2, 1000)),
    "signs": [-5.0, -1e-9, 0.0, 1e-9, 7.0, -1e6],
    "across buckets": [10.0] * 50 + [20.0] * 50,
}


@pytest.mark.parametrize("name", SAMPLES)
def test_medians_are_exact(spark, name):
    data = [float(v) for v in SAMPLES[name]]
    df = spark.createDataFrame([(v, None) for v in data] + [(None, data[0])], "a double, b double")
    got = {r["metric"]: r for r in medians.spread(medians.long_values(df, ["a", "b"])).collect()}
    a = got["a"]
    assert a["median"] == statistics.median(data)
    assert (a["count"], a["smallest"], a["largest"]) == (len(data), min(data), max(data))
    assert got["b"]["median"] == data[0]


@pytest.mark.parametrize("seed", range(3))
def test_histogram_matches_numpy(spark, seed):
    pick = np.random.default_rng(seed)
    low = pick.integers(1, 50, 300) * 1000.0
    high = np.where(pick.random(300) < 0.3, np.nan, low * 1.5)
    df = spark.createDataFrame(
        [(float(a), None if np.isnan(b) else float(b)) for a, b in zip(low, high)], "salary_min double, salary_max double"
    )
    known = high[~np.isnan(high)]
    _, edges = np.histogram(np.concatenate([low, known]), bins=12)
    got = salaries.salary_histogram(df).collect()
    assert [r["min_salary"] for r in got] == np.histogram(low, bins=edges)[0].tolist()
    assert [r["max_salary"] for r in got] == np.histogram(known, bins=edges)[0].tolist()
    assert [r["range"] for r in got] == [f"${int(a):,}–${int(b):,}" for a, b in zip(edges, edges[1:])]


def test_histograms_of_one_value(spark):
    df = spark.createDataFrame([(1000.0, None)] * 4, "salary_min double, salary_max double")
    shared = salaries.salary_histogram(df).collect()
    edges = np.histogram([1000.0] * 4, bins=12)[1]
    assert [r["min_salary"] for r in shared] == np.histogram([1000.0] * 4, bins=edges)[0].tolist()
    own = salaries.histogram_own_edges(df).collect()
    assert [tuple(r) for r in own] == [(0, "$1,000–$1,001", 4, 0)]


def test_bars_have_no_width_without_span(spark):
    df = spark.createDataFrame([("k", "t", "c", 10.0, 10.0)], "job_id string, title string, company string, salary_min double, salary_max double")
    bar = salaries.range_bars(df).first()
    assert bar["left_percent"] is None and bar["width_percent"] is None
