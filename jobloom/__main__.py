"""Command line: the daily batch, the dashboard as JSON lines per section, skills of a stored table.

    python -m jobloom batch --feed-a PATH --feed-b PATH --base PATH [--lines]
    python -m jobloom dashboard --base PATH --out PATH [--location NAME ...] [--from DAY] [--to DAY]
    python -m jobloom enrich --table PATH [--out PATH] [--strip auto|yes|no]
    python -m jobloom runs --log PATH --out PATH [--dags PATH] [-n N] [--most N]
"""

from __future__ import annotations

import argparse
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession, functions as F

from jobloom import schemas
from jobloom.operators import runlog
from jobloom.operators.cleaning import enrich_table
from jobloom.plans.batch import run_batch
from jobloom.plans.dashboard import Sizes, dashboard, write_sections
from jobloom.session import get_session
from jobloom.sources import feeds, storage


def _batch(spark: SparkSession, args: argparse.Namespace) -> None:
    """A feed that is not there is skipped; the run fails only if none is.

    The landed files are kept as they are; those (with `--lines`: the lines) that are no JSON are counted.
    """
    whole = ((args.feed_a, feeds.read_feed_a, feeds.normalise_feed_a), (args.feed_b, feeds.read_feed_b, feeds.normalise_feed_b))
    framed = (
        (args.feed_a, feeds.read_lines, lambda lines: feeds.normalise_records_a(feeds.records(lines, "jobs"))),
        (args.feed_b, feeds.read_lines, lambda lines: feeds.normalise_records_b(feeds.records(lines))),
    )
    frames, corrupt, paths = [], 0, []
    for path, read, normalise in framed if args.lines else whole:
        landed = storage.open_if_present(lambda path=path, read=read: read(spark, path)) if path else None
        frames.append(None if landed is None else normalise(landed))
        if landed is not None:
            corrupt += (feeds.corrupt_lines if args.lines else feeds.corrupt_payloads)(landed).count()
            paths.append(path)
    payload = spark.read.text(paths, wholetext=not args.lines) if paths else None
    if payload is not None:
        payload = payload.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
    now = datetime.now(timezone.utc).replace(microsecond=0)
    for step, rows in run_batch(spark, frames, args.base, now, payload, corrupt=corrupt).items():
        print(f"{step}: {rows} rows")


def _dashboard(spark: SparkSession, args: argparse.Namespace) -> None:
    """One folder per section; a single error record where there are no postings."""
    clean = storage.read_clean(spark, f"{args.base}/clean/parquet", f"{args.base}/clean/csv", keep_month=True)
    sizes = Sizes(args.top, args.pairs, args.ranges, args.table)
    with dashboard(clean, args.location, args.date_from, args.date_to, sizes=sizes) as parts:
        write_sections(parts, args.out, sizes)


def _enrich(spark: SparkSession, args: argparse.Namespace) -> None:
    """Without `--out` the table itself is replaced, in its format and layout.

    The result is written beside the table and takes its place when it is finished, so
    a write that fails leaves the table as it was.
    """
    table = args.table.rstrip("/")
    as_csv = table.endswith("csv")
    stored = storage.read_clean(spark, None if as_csv else table, table if as_csv else None, required=True, keep_month=True)
    by_month = storage.MONTH in stored.columns
    enriched = enrich_table(stored.drop(storage.MONTH), strip={"auto": None, "yes": True, "no": False}[args.strip])
    out = args.out or f"{table}.new-{uuid.uuid4().hex}"
    if as_csv:
        storage.write_csv(enriched, out)
    elif by_month and args.out is None:
        storage.write_by_month(enriched, out)
    else:
        enriched.write.parquet(out)
    if args.out is None:
        storage.replace_folder(spark, out, table)


def _runs(spark: SparkSession, args: argparse.Namespace) -> None:
    """The run log as one overview: states, newest runs, and facts per workflow if given."""
    runs = spark.read.schema(schemas.RUN).json(args.log)
    parts = {"run_states": runlog.run_state_summary(runs), "recent_runs": runlog.recent_runs(runs, args.n, args.most)}
    if args.dags:
        parts["dags"] = runlog.dag_facts(spark.read.schema(schemas.DAG).json(args.dags))
    for name, part in parts.items():
        part.write.mode("overwrite").json(f"{args.out}/{name}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobloom", description=__doc__)
    commands = parser.add_subparsers(required=True)
    batch = commands.add_parser("batch")
    batch.add_argument("--feed-a")
    batch.add_argument("--feed-b")
    batch.add_argument("--base", required=True)
    batch.add_argument("--lines", action="store_true", help="the feeds hold a JSON value per line, read by many tasks")
    batch.set_defaults(run=_batch)
    board = commands.add_parser("dashboard")
    board.add_argument("--base", required=True)
    board.add_argument("--out", required=True)
    board.add_argument("--location", action="append", default=[])
    board.add_argument("--from", dest="date_from")
    board.add_argument("--to", dest="date_to")
    for name, size in (("top", 12), ("pairs", 15), ("ranges", 15), ("table", 50)):
        board.add_argument(f"--{name}", type=int, default=size, help=f"rows shown (default {size})")
    board.set_defaults(run=_dashboard)
    enrich = commands.add_parser("enrich")
    enrich.add_argument("--table", required=True)
    enrich.add_argument("--out")
    enrich.add_argument("--strip", choices=("auto", "yes", "no"), default="auto", help="strip HTML (auto: if any row has a tag)")
    enrich.set_defaults(run=_enrich)
    runs = commands.add_parser("runs")
    runs.add_argument("--log", required=True)
    runs.add_argument("--dags")
    runs.add_argument("--out", required=True)
    runs.add_argument("-n", type=int, default=5)
    runs.add_argument("--most", type=int)
    runs.set_defaults(run=_runs)
    args = parser.parse_args(argv)
    args.run(spark or get_session(), args)


if __name__ == "__main__":
    main()
