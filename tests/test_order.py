"""Results that are shown in order come in that order."""

import pytest

from tests.compare import _plain, connect
from workload import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ORDERS = {
    "A2_filter_options": "option",
    "A5_top_companies": "count desc, name",
    "A6_timeline": "date",
    "A7_skill_rankings": "demand desc, skill",
    "A8_ranked_top_50": "position",
    "A10_all_skill_pairs": "count desc, pair",
    "A12_salary_histogram": "bin",
    "A14_salary_ranges": "min",
    "A17_work_mode_split": "count desc, mode",
    "R2_run_state_summary": "runs desc, state",
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order(spark, name):
    answer = connect(SF).execute(f"select * from ({ORACLES[name]}) t order by {ORDERS[name]}")
    names = [column[0] for column in answer.description]
    expected = [tuple(map(_plain, row)) for row in answer.fetchall()]
    got = [tuple(_plain(row[n]) for n in names) for row in QUERIES[name](spark, SF).collect()]
    assert got == expected


@pytest.mark.parametrize("name", ["A16_salary_table_all", "A14_salary_ranges_missing_numbers"])
def test_salaries_in_order(spark, name):
    column, down = ("salary_min", True) if "table" in name else ("min", False)
    shown = [row[column] for row in QUERIES[name](spark, SF).collect()]
    assert shown == sorted(shown, reverse=down) and len(shown) > 10


def test_newest_runs_first(spark):
    shown = [row["start_date"] for row in QUERIES["R3_recent_runs"](spark, SF).collect()]
    assert shown == sorted(shown, reverse=True) and len(shown) == 50
