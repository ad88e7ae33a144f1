"""Run-log questions (R1 to R4) on runs and workflow records made from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom import schemas
from jobloom.operators import runlog
from workload.registry import register
from workload.views import sql, view, with_views

_MICROS = "(epoch_us(try_cast(end_date as timestamptz)) - epoch_us(try_cast(start_date as timestamptz)))"
# Half up to one decimal, in whole numbers: no run ends before it starts.
_SECONDS = f"(({_MICROS} + 50000) // 100000) / 10.0::double"


_ANY_DAYS = (
    "days as (select dag_run_id, state, run_type, substr(start_date, 1, 10) as start_date, substr(end_date, 1, 10) as end_date from runs)"
)


def runs(text: str) -> str:
    return with_views(text, "runs")


def on_runs(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "runs")


@register(
    "R1_run_durations",
    runs(f"select dag_run_id, state, run_type, start_date, end_date, {_SECONDS} as duration_seconds from runs"),
)
def r1(spark, sf_dir):
    return runlog.run_durations(on_runs(spark, sf_dir))


@register("R2_run_state_summary", runs("select coalesce(state, 'unknown') as state, count(*) as runs from runs group by 1"))
def r2(spark, sf_dir):
    return runlog.run_state_summary(on_runs(spark, sf_dir))


@register(
    "R1_run_durations_plain_days",
    with_views("", "runs").rstrip()
    + f", {_ANY_DAYS} select *, round(86400.0::double * (try_cast(end_date as date) - try_cast(start_date as date)), 1)"
    " as duration_seconds from days",
)
def r1_days(spark, sf_dir):
    """Days without a time."""
    days = {name: F.substring(name, 1, 10) for name in ("start_date", "end_date")}
    return runlog.run_durations(on_runs(spark, sf_dir).withColumns(days))


def _recent_sql(n: int) -> str:
    return runs(
        f"select dag_run_id, state, run_type, start_date, end_date, {_SECONDS} as duration_seconds from runs"
        f" order by try_cast(start_date as timestamptz) desc nulls last, dag_run_id limit {n}"
    )


@register("R3_recent_runs", _recent_sql(50))
def r3(spark, sf_dir):
    return runlog.recent_runs(on_runs(spark, sf_dir), 50)


@register("R3_recent_runs_at_most_20", _recent_sql(20))
def r3_most(spark, sf_dir):
    return runlog.recent_runs(on_runs(spark, sf_dir), 50, most=20)


@register(
    "R4_dag_facts",
    "select concat('dag_', o_orderkey) as dag_id, o_orderstatus = 'P' as is_paused,"
    " case when o_orderkey % 3 = 0 then '' else concat(o_orderpriority, ', ', o_orderstatus) end as tags,"
    " cast(case when o_orderkey % 5 = 0 then 0 else 3 end as integer) as task_count,"
    " case when o_orderkey % 5 = 0 then '' when o_orderkey % 2 = 0 then concat('extract_', o_custkey, ', load')"
    " else concat('extract_', o_custkey) end as task_ids from orders",
)
def r4(spark, sf_dir):
    """Workflow records as JSON text, one per order, parsed with the declared schema."""
    text = sql(
        spark,
        sf_dir,
        """
select to_json(named_struct(
  'dag_id', concat('dag_', o_orderkey),
  'is_paused', o_orderstatus = 'P',
  'tags', case when o_orderkey % 3 <> 0 then array(named_struct('name', o_orderpriority), named_struct('name', o_orderstatus)) end,
  'tasks', case when o_orderkey % 5 <> 0 then array(
     named_struct('task_id', concat('extract_', o_custkey)),
     named_struct('task_id', cast(null as string)),
     named_struct('task_id', case when o_orderkey % 2 = 0 then 'load' end)) end)) as record
from orders""",
    )
    parsed = text.select(F.from_json("record", schemas.DAG).alias("dag")).select("dag.*")
    facts = runlog.dag_facts(parsed.drop("is_active", "description", "owners"))
    return facts.withColumns({name: F.array_join(name, ", ") for name in ("tags", "task_ids")})
