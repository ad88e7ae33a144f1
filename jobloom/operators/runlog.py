"""Run-log questions over tables of run and workflow records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.functions.common import as_col, text_or_empty

# A day alone, or a day and a time with or without an offset.
_ISO_MOMENT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
_ISO_ZONE = r"(Z|[+-]\d{2}:?\d{2})$"


def moment(value: Column | str) -> Column:
    """Timestamp of ISO text, UTC where it names no offset; malformed text is null.

    The session's zone never counts: a plain day is its first moment in UTC.
    """
    text = as_col(value).cast("string")
    zoned = (
        F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .when(~text.rlike(_ISO_ZONE), F.concat(text, F.lit("Z")))
        .otherwise(text)
    )
    return F.when(text.rlike(_ISO_MOMENT), zoned.try_cast("timestamp"))


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Seconds from start to end to one decimal; null if either is missing or malformed."""
    micros = F.unix_micros(moment(end)) - F.unix_micros(moment(start))
    return F.round(micros / 1e6, 1)


def run_durations(runs: DataFrame) -> DataFrame:
    columns = ("dag_run_id", "state", "run_type", "logical_date", "start_date", "end_date")
    return runs.select(
        *[c for c in columns if c in runs.columns],
        duration_seconds("start_date", "end_date").alias("duration_seconds"),
    )


def run_state_summary(runs: DataFrame) -> DataFrame:
    """Runs by state; a missing state counts as `unknown`."""
    state = F.coalesce("state", F.lit("unknown"))
    return runs.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("runs")).orderBy(F.desc("runs"), "state")


def recent_runs(runs: DataFrame, n: int = 5, most: int | None = None) -> DataFrame:
    """The `n` newest runs by start with their durations; `most` is a limit a server may set."""
    if n < 1:
        raise ValueError(f"{n} runs cannot be shown")
    n = n if most is None else min(most, n)
    # Parsed in a projection of its own, or the sort would parse at every comparison.
    timed = runs.withColumn("_started", moment("start_date"))
    newest = timed.orderBy(F.desc_nulls_last("_started"), "dag_run_id").limit(n)
    return run_durations(newest)


def dag_facts(dags: DataFrame) -> DataFrame:
    """Per workflow: tag names, task count, and the ids of tasks that have one."""
    ids = F.filter(F.transform("tasks", lambda task: task["task_id"]), lambda name: text_or_empty(name) != "")
    tag_names = F.transform(F.filter("tags", lambda tag: tag.isNotNull()), lambda tag: tag["name"])
    none = F.array().cast("array<string>")
    optional = [c for c in ("is_paused", "is_active", "description", "owners") if c in dags.columns]
    return dags.select(
        "dag_id",
        *optional,
        F.coalesce(tag_names, none).alias("tags"),
        F.when(F.col("tasks").isNull(), F.lit(0)).otherwise(F.size("tasks")).alias("task_count"),
        F.coalesce(ids, none).alias("task_ids"),
    )
