"""Registered queries over the given tables, and their SQL twins."""

from workload import (  # noqa: F401
    cleaning_queries,
    market_queries,
    run_queries,
    source_queries,
    warehouse_queries,
)
from workload.registry import ORACLES, QUERIES  # noqa: F401
from workload.views import view  # noqa: F401
