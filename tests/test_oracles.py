"""Every registered query against its SQL twin (TEST_SF_DIR, default sf0.001)."""

import os

import pytest

from __spark_entry__ import entry
from tests.compare import connect, difference
from workload import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# No Python worker and no join without keys in any plan.
UNWANTED = (
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct",
    "BroadcastNestedLoopJoin",
)


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in UNWANTED if bad in plan]
    problem = difference(frame, db, ORACLES[name])
    spark.catalog.clearCache()
    assert problem is None, problem


def test_entry(spark):
    assert entry(spark).columns == ["name", "count"]
