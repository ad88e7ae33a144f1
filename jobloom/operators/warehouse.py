"""Keyed warehouse tables: postings, skills and their links."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import schemas
from jobloom.functions.common import number_column
from jobloom.functions.skills import split_skills
from jobloom.operators.keyed import dedupe_last, number_by_name
from jobloom.sources.buckets import BucketedTable
from jobloom.sources.storage import shared_folder


def to_warehouse_types(clean: DataFrame, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Clean postings as (accepted, rejected) rows in warehouse types.

    Rejected are rows a constraint of the table would refuse: no key or title,
    a text longer than its column, or a salary beyond NUMERIC(12, 2); `reason`
    names the first column at fault. Accepted rows keep the columns in `carry`.
    """
    source = clean if "salary_raw" in clean.columns else clean.withColumnRenamed("salary", "salary_raw")
    source = source.withColumns(
        {f.name: F.lit(None).cast("string") for f in schemas.WAREHOUSE_JOBS if f.name not in source.columns}
    )

    def typed(field) -> Column:
        column = F.col(field.name)
        if field.name in ("salary_min", "salary_max"):
            column = number_column(source, field.name).try_cast(field.dataType)
        elif field.name == "is_remote":
            column = F.coalesce(column.try_cast("boolean"), F.lit(False))
        else:
            column = column.try_cast(field.dataType)
        return column.alias(field.name)

    faults = {name: F.col(name).isNull() for name in ("job_id", "title")}
    for name, limit in schemas.WAREHOUSE_TEXT_LIMITS.items():
        if limit:
            too_long = F.coalesce(F.length(F.col(name).cast("string")) > limit, F.lit(False))
            faults[name] = faults[name] | too_long if name in faults else too_long
    for name in ("salary_min", "salary_max"):
        number = number_column(source, name)
        faults[name] = number.isNotNull() & number.try_cast("decimal(12,2)").isNull()
    reason = F.coalesce(*[F.when(fault, F.lit(name)) for name, fault in faults.items()])
    judged = source.withColumn("reason", reason)
    accepted = judged.where(F.col("reason").isNull()).select(*[typed(field) for field in schemas.WAREHOUSE_JOBS], *carry)
    return accepted, judged.where(F.col("reason").isNotNull())


def _moment(batch_time: datetime | Column) -> Column:
    """The instant of a batch: a datetime has to name its offset, or the driver's zone would decide."""
    if isinstance(batch_time, Column):
        return batch_time.cast("timestamp")
    if batch_time.tzinfo is None:
        raise ValueError("the batch time has to name its offset")
    return F.lit(batch_time.isoformat()).cast("timestamp")


def upsert(
    target: DataFrame | None,
    batch: DataFrame,
    key: str,
    batch_time: datetime | Column,
    order: list[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """The target after inserting new keys and replacing the rows of known ones.

    `created_at` stays as first seen, `updated_at` is the batch time of the last
    change. If the batch itself repeats a key, the last row in `order` counts (where
    that does not decide, the row's content does); `unique=True` says that it does not, which saves a shuffle. Null is a key
    like any other. Columns only one side has are kept, null where a row lacks them.

    The batch without repeats is written once to the shared folder. The target
    meets only its keys: while Spark finds those small enough to broadcast, target
    rows are filtered where they lie, and they are never sorted through a window.
    """
    now = _moment(batch_time)
    fresh = batch if unique else dedupe_last(batch, key, order or [])
    if target is None:
        return fresh.withColumns({"created_at": now, "updated_at": now})
    if not unique:
        path = shared_folder(batch.sparkSession, "batch")
        fresh.write.parquet(path)
        fresh = batch.sparkSession.read.parquet(path)
    keys = fresh.select(F.col(key).alias("_key"))
    kept = target.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    known = target.select(F.col(key).alias("_key"), F.col("created_at").alias("_created")).join(
        keys.withColumnRenamed("_key", "_new"), F.col("_key").eqNullSafe(F.col("_new")), "left_semi"
    )
    changed = (
        fresh.drop("created_at", "updated_at")
        .join(known, F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumns({"created_at": F.coalesce("_created", now), "updated_at": now})
        .drop("_key", "_created")
    )
    return kept.unionByName(changed, allowMissingColumns=True)


def skill_names(postings: DataFrame, column: str = "skills") -> DataFrame:
    """Distinct lower-cased skill names of a table, without those too long for theirs."""
    names = postings.select(F.explode(split_skills(column)).alias("skill_name")).distinct()
    return names.where(F.length("skill_name") <= schemas.SKILL_NAME_LIMIT)


def upsert_skill_dim(dim: DataFrame | None, names: DataFrame) -> DataFrame:
    """Skill table with new names added; known ids stay, new ones continue in name order.

    `names` has distinct values in `skill_name`.
    """
    if dim is None:
        return number_by_name(names, "skill_name", "skill_id").select(
            F.col("skill_id").cast("int").alias("skill_id"), "skill_name"
        )
    new = number_by_name(names.join(dim, "skill_name", "left_anti"), "skill_name", "_number")
    last = F.coalesce(dim.agg(F.max("skill_id").alias("last")).scalar(), F.lit(0))
    return dim.select("skill_id", "skill_name").unionByName(
        new.select((F.col("_number") + last).cast("int").alias("skill_id"), "skill_name")
    )


def link_skills(pairs: DataFrame, dim: DataFrame, unique: bool = False) -> DataFrame:
    """(job_id, skill_id) of (job_id, skill) rows whose skill is known, each once.

    Repeats go before the join, so a skill that most postings name is matched on
    as few rows as possible; `unique=True` says that there are none. The join
    carries no hint: Spark broadcasts the dimension while it is small and splits
    skewed partitions when it is not.
    """
    named = pairs.select("job_id", F.lower(F.trim("skill")).alias("skill_name"))
    return (named if unique else named.distinct()).join(dim, "skill_name").select("job_id", "skill_id")


def link_job_skills(jobs: DataFrame, dim: DataFrame, column: str = "skills", unique: bool = False) -> DataFrame:
    """Links of postings with a `skills` column; `unique=True`: every posting comes once."""
    pairs = jobs.select("job_id", F.explode(F.array_distinct(split_skills(column))).alias("skill"))
    return link_skills(pairs, dim, unique)


def new_links(links: DataFrame | None, found: DataFrame) -> DataFrame:
    """Those of the links found (each once) that are not stored yet."""
    return found if links is None else found.join(links, ["job_id", "skill_id"], "left_anti")


def merge_links(links: DataFrame | None, new: DataFrame) -> DataFrame:
    """Stored links and new ones, each pair once."""
    return new.distinct() if links is None else links.unionByName(new).distinct()


def prune_orphans(links: DataFrame, jobs: DataFrame, dim: DataFrame) -> DataFrame:
    """Links whose posting and skill both still exist."""
    return links.join(dim.select("skill_id"), "skill_id", "left_semi").join(
        jobs.select("job_id"), "job_id", "left_semi"
    )


def upsert_buckets(
    table: BucketedTable,
    batch: DataFrame,
    batch_time: datetime | Column,
    order: list[str] | None = None,
    unique: bool = False,
    stored: bool = False,
) -> int:
    """`upsert` into a bucketed table: only the buckets of the batch's keys are read and written; the new generation.

    The batch without repeats is written once, unless it is `unique` and read from `stored` files as it is.
    Applying a batch again gives the same table.
    """
    fresh = batch if unique else dedupe_last(batch, table.key, order or [])
    if not (unique and stored):
        path = shared_folder(batch.sparkSession, "batch")
        fresh.write.parquet(path)
        fresh = batch.sparkSession.read.parquet(path)
    touched = table.touched(fresh)
    return table.replace(upsert(table.read(touched), fresh, table.key, batch_time, unique=True), touched)


def delete_keys(table: BucketedTable, keys: DataFrame) -> int:
    """Remove the rows of some keys (a column named as the table's key); the new generation."""
    path = shared_folder(keys.sparkSession, "deleted")
    keys.select(F.col(table.key).alias("_key")).distinct().write.parquet(path)
    gone = keys.sparkSession.read.parquet(path)
    touched = table.touched(gone, "_key")
    if table.generation() is None:
        raise ValueError("nothing has been stored yet")
    return table.replace(table.read(touched).join(gone, F.col(table.key).eqNullSafe(F.col("_key")), "left_anti"), touched)


def add_links(links: BucketedTable, found: DataFrame, unique: bool = False) -> int:
    """Store links of postings, each pair once; only the buckets of these postings are read and written.

    `unique=True` says that the links found hold few repeats: then stored and new ones meet in the one
    shuffle that writes them. Others are combined before it.
    """
    path = shared_folder(found.sparkSession, "links")
    found.select("job_id", "skill_id").write.parquet(path)
    found = found.sparkSession.read.parquet(path)
    touched = links.touched(found)
    stored = links.read(touched)
    if unique:
        return links.replace(found if stored is None else stored.unionByName(found), touched, distinct=True)
    return links.replace(merge_links(stored, found), touched)


def prune_links(links: BucketedTable, changes: DataFrame, gone_skills: DataFrame | None = None) -> int:
    """Remove links of deleted postings, and of deleted skills; the new generation.

    `changes` are those of the postings (`BucketedTable.changes`): the links' buckets of deleted keys alone
    are read and written. Skills lie in any bucket, so those that hold links of `gone_skills`
    (`skill_id`) are found by a scan of that column.
    """
    path = shared_folder(changes.sparkSession, "deleted")
    changes.where("change = 'deleted'").select(F.col("job_id").alias("_job")).write.parquet(path)
    gone = changes.sparkSession.read.parquet(path)
    touched = set(links.touched(gone, "_job"))
    if gone_skills is not None:
        gone_skills = gone_skills.select(F.col("skill_id").alias("_skill"))
        touched |= set(links.touched(links.read().join(gone_skills, F.col("skill_id") == F.col("_skill"), "left_semi")))
    left = links.read(sorted(touched)).join(gone, F.col("job_id").eqNullSafe(F.col("_job")), "left_anti")
    if gone_skills is not None:
        left = left.join(gone_skills, F.col("skill_id") == F.col("_skill"), "left_anti")
    return links.replace(left, sorted(touched))
