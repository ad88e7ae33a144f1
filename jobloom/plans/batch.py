"""The daily batch: landed feeds to raw, clean and warehouse tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom import schemas
from jobloom.functions.skills import TECH_SKILLS
from jobloom.operators import cleaning, keyed, quality, warehouse
from jobloom.sources import buckets, feeds, storage


class EmptyStep(RuntimeError):
    """A step gave no rows, so later steps have nothing to do."""


def ingest(feed_frames: list[DataFrame | None], base: str, payload: DataFrame | None = None) -> int:
    """Combine, keep the first row per posting, store; the number of rows stored."""
    combined = feeds.combine_feeds(*feed_frames)
    unique = keyed.dedupe_first(combined, "job_id", feeds.ORDER_COLUMNS).select(*schemas.RAW_COLUMNS)
    watched, watch = quality.observed(unique, "ingest")
    storage.write_raw(watched, base, payload)
    return watch.get["row_count"]


def clean(spark: SparkSession, raw_base: str, clean_base: str, dictionary: tuple[str, ...] = TECH_SKILLS) -> int:
    """Clean the stored raw postings, which ingestion left unique."""
    raw = storage.read_raw(spark, f"{raw_base}/parquet", f"{raw_base}/csv")
    watched, watch = quality.observed(cleaning.clean_postings(raw, dictionary, unique=True), "clean")
    storage.write_clean(watched, clean_base)
    return watch.get["row_count"]


def load(spark: SparkSession, clean_base: str, warehouse_base: str, batch_time: datetime) -> int:
    """Upsert the accepted postings, their skills and links; the number of postings loaded.

    Postings the warehouse constraints refuse go to `rejected`, one folder per
    batch, with the reason; they bring no skills. The accepted rows are written
    once, and keys, skills and links all come from there. Postings and links lie in
    buckets by posting, of which only those that the batch touches are read and written.
    """
    stored = storage.read_clean(spark, f"{clean_base}/parquet", f"{clean_base}/csv")
    passed, rejected = warehouse.to_warehouse_types(stored, carry=("skills",))
    stamp = batch_time.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S")
    rejected.write.mode("overwrite").parquet(f"{warehouse_base}/rejected/batch={stamp}")
    watched, watch = quality.observed(passed, "load")
    path = storage.shared_folder(spark, "accepted")
    watched.write.parquet(path)
    accepted = spark.read.parquet(path)
    jobs = buckets.BucketedTable(spark, f"{warehouse_base}/jobs", "job_id")
    links = buckets.BucketedTable(spark, f"{warehouse_base}/job_skills", "job_id", filters=False)
    skills = storage.VersionedTable(spark, f"{warehouse_base}/skills")
    warehouse.upsert_buckets(jobs, accepted.drop("skills"), batch_time, unique=True, stored=True)
    dim = skills.write(warehouse.upsert_skill_dim(skills.read(), warehouse.skill_names(accepted)))
    warehouse.add_links(links, warehouse.link_job_skills(accepted, dim, unique=True), unique=True)
    return watch.get["row_count"]


def summarise(spark: SparkSession, base: str, run_id: str) -> None:
    """The summaries of the stored raw and clean tables, one appended row per run and summary."""
    raw = storage.read_raw(spark, f"{base}/raw/parquet", f"{base}/raw/csv")
    cleaned = storage.read_clean(spark, f"{base}/clean/parquet", f"{base}/clean/csv")
    parts = {
        "ingestion": quality.ingestion_summary(raw),
        "cleaning": quality.cleaning_summary(cleaned),
        "steps": quality.step_counters(cleaned),
        "skills": quality.skill_stats(cleaned),
    }
    for name, part in parts.items():
        part.withColumn("run_id", F.lit(run_id)).write.mode("append").parquet(f"{base}/summaries/{name}")


def record_steps(spark: SparkSession, log_path: str, run_id: str, counts: dict[str, int]) -> None:
    """Append one row per step to the table of step row counts."""

    def record(number: int, name: str, rows: int):
        return F.struct(
            F.lit(number).alias("step_no"), F.lit(name).alias("step"), F.lit(rows).cast("bigint").alias("row_count")
        )

    steps = F.array(*[record(number, *step) for number, step in enumerate(counts.items(), 1)])
    entry = spark.range(1).select(F.lit(run_id).alias("run_id"), F.inline(steps))
    entry.write.mode("append").parquet(log_path)


def run_batch(
    spark: SparkSession,
    feed_frames: list[DataFrame | None],
    base: str,
    batch_time: datetime,
    payload: DataFrame | None = None,
    dictionary: tuple[str, ...] = TECH_SKILLS,
    corrupt: int | None = None,
) -> dict[str, int]:
    """All steps in order; stops with `EmptyStep` when a step gives no rows.

    `corrupt` is the number of landed files that could not be parsed; it is
    recorded among the step counts. The summaries are stored once all steps ran.
    """
    steps = {
        "extract": lambda: ingest(feed_frames, f"{base}/raw", payload),
        "transform": lambda: clean(spark, f"{base}/raw", f"{base}/clean", dictionary),
        "load": lambda: load(spark, f"{base}/clean", f"{base}/warehouse", batch_time),
    }
    counts: dict[str, int] = {}
    run_id = batch_time.isoformat()
    try:
        if corrupt is not None:
            counts["corrupt_payloads"] = corrupt
        for name, step in steps.items():
            counts[name] = step()
            if not counts[name]:
                raise EmptyStep(name)
    finally:
        if counts:
            record_steps(spark, f"{base}/step_counts", run_id, counts)
    summarise(spark, base, run_id)
    return counts
