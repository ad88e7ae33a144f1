"""Compare registered queries with their SQL twins: names, row counts, every value.

    python tests/compare.py [sf_dir] [name part ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    from workload.views import TABLES

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


# Kinds of type that must agree between the engines.
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "decimal(12,2)": "DECIMAL(12,2)",
}


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value))
    if isinstance(value, (bool, int, str, decimal.Decimal, datetime.date)):
        return (1, str(value))
    raise TypeError(f"compare flat columns only, not {type(value)}")


def difference(frame, db: duckdb.DuckDBPyConnection, oracle: str) -> str | None:
    """None if both results are the same set of rows, else what differs."""
    answer = db.execute(oracle)
    names = [column[0] for column in answer.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    kinds = dict(zip(names, (str(column[1]) for column in answer.description)))
    for name, kind in frame.dtypes:
        if KINDS.get(kind) != kinds[name]:
            return f"type of {name}: {kind} against {kinds[name]}"
    order = sorted(names)
    places = [names.index(name) for name in order]
    expected = sorted(tuple(_plain(row[at]) for at in places) for row in answer.fetchall())
    got = sorted(tuple(_plain(row[name]) for name in order) for row in frame.select(*order).collect())
    if len(expected) != len(got):
        return f"{len(got)} rows against {len(expected)}"
    for mine, theirs in zip(got, expected):
        if mine != theirs:
            return f"columns {order}: {mine} against {theirs}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from jobloom.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = get_session(
        master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, oracles, failed = connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if parts and not any(part in name for part in parts):
            continue
        start = time.perf_counter()
        try:
            frame = run(spark, sf_dir)
            problem = difference(frame, db, oracles[name]) if name in oracles else f"no oracle, {frame.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None and not problem.startswith("no oracle")
        print(f"{name:34s} {time.perf_counter() - start:6.2f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
