"""Bucketed tables: cost of a write, readers meanwhile, change sets, known keys."""

import random
import shutil
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobloom.operators import keyed, warehouse
from jobloom.sources.buckets import BucketedTable

DAY_1, DAY_2, DAY_3 = (datetime(2025, 3, day, 6, tzinfo=timezone.utc) for day in (1, 2, 3))


def files(table):
    """Every data file with its time and size."""
    root = Path(table._base) / "data"
    return {str(p.relative_to(root)): (p.stat().st_mtime_ns, p.stat().st_size) for p in root.rglob("*.parquet")}


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def jobs(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "jobs"), "job_id", buckets=16)
    first = spark.range(400).select(F.concat(F.lit("j"), F.col("id")).alias("job_id"), (F.col("id") * 2).alias("v"))
    warehouse.upsert_buckets(table, first, DAY_1)
    return table


def batch_of(spark, *rows):
    return spark.createDataFrame(list(rows), "job_id string, v long")


def test_a_batch_leaves_other_buckets_alone(spark, jobs):
    before = files(jobs)
    batch = batch_of(spark, ("j7", -1), ("new", -2))
    touched = jobs.touched(batch)
    assert 1 <= len(touched) <= 2
    assert warehouse.upsert_buckets(jobs, batch, DAY_2) == 2
    after = files(jobs)
    assert {name: after[name] for name in before} == before
    assert {name.split("/")[1] for name in set(after) - set(before)} == {f"bucket={b}" for b in touched}
    read = [f for f in jobs.read().inputFiles() if "generation=2" in f]
    assert read and len(jobs.read(touched).inputFiles()) == len(touched)
    assert jobs.read().count() == 401


def test_against_the_whole_table_upsert(spark, jobs):
    draw = random.Random(5)
    plain = jobs.read()
    for day in (DAY_2, DAY_3):
        rows = [(f"j{draw.randint(0, 600)}", draw.randint(0, 9)) for _ in range(60)] + [(None, 5), (None, 6)]
        batch = batch_of(spark, *rows)
        for _ in range(2):  # again: the same
            plain = warehouse.upsert(plain, batch, "job_id", day, order=["v"])
            warehouse.upsert_buckets(jobs, batch, day, order=["v"])
        assert rows_of(jobs.read(), *plain.columns) == rows_of(plain, *plain.columns)


def test_readers_meanwhile(spark, jobs):
    opened, seen = jobs.read(), rows_of(jobs.read(), "job_id", "v")
    batch = batch_of(spark, *[(f"j{i}", 0) for i in range(400)])
    warehouse.upsert_buckets(jobs, batch, DAY_2)
    assert rows_of(opened, "job_id", "v") == seen != rows_of(jobs.read(), "job_id", "v")
    assert rows_of(jobs.read(at=1), "job_id", "v") == seen
    boom = jobs.read().withColumn("v", F.when(F.col("job_id") == "j9", F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("long"))
    now = rows_of(jobs.read(), "job_id", "v")
    with pytest.raises(Exception, match="broken"):
        jobs.replace(boom)
    assert jobs.generation() == 2 and rows_of(jobs.read(), "job_id", "v") == now
    # What a failed write left behind does not show in the one that takes its number.
    assert jobs.replace(jobs.read()) == 3 and rows_of(jobs.read(), "job_id", "v") == now


def test_rows_of_other_buckets_are_refused(spark, jobs):
    with pytest.raises(ValueError, match="were not to be replaced"):
        jobs.replace(jobs.read(), buckets=[0, 1])
    assert jobs.generation() == 1 and jobs.read().count() == 400
    with pytest.raises(ValueError, match="no generation"):
        jobs.read(at=9)


def test_columns_grow_and_buckets_become_empty(spark, jobs):
    wide = batch_of(spark, ("j7", 1)).withColumn("note", F.lit("x"))
    warehouse.upsert_buckets(jobs, wide, DAY_2)
    assert jobs.read().where("note = 'x'").count() == 1 and jobs.read().where("note is null").count() == 399
    gone = jobs.read().where(jobs.bucket() == 3)
    size = gone.count()
    warehouse.delete_keys(jobs, gone)
    assert size and jobs.read().count() == 400 - size and jobs.read([3]).count() == 0
    everything = jobs.read()
    warehouse.delete_keys(jobs, everything)
    assert jobs.read().count() == 0 and jobs.read().columns == everything.columns
    warehouse.upsert_buckets(jobs, batch_of(spark, ("back", 1)), DAY_3)
    assert rows_of(jobs.read(), "job_id") == [("back",)]


def test_key_types_and_odd_keys(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), "job_id", buckets=4)
    assert table.read() is None and table.generation() is None
    assert table.unknown(spark.range(3).withColumnRenamed("id", "job_id")).count() == 3
    table.replace(spark.range(50).select(F.col("id").cast("int").alias("job_id")))
    again = BucketedTable(spark, str(tmp_path / "t"), "job_id", buckets=99)
    assert again.unknown(spark.range(40, 60).withColumnRenamed("id", "job_id")).count() == 10
    with pytest.raises(ValueError, match="nothing has been stored"):
        warehouse.delete_keys(BucketedTable(spark, str(tmp_path / "none"), "job_id"), spark.range(3).withColumnRenamed("id", "job_id"))
    plain = BucketedTable(spark, str(tmp_path / "plain"), "job_id", buckets=2, filters=False)
    plain.replace(spark.range(50).withColumnRenamed("id", "job_id"))
    assert not (tmp_path / "plain/filters").exists()
    assert BucketedTable(spark, str(tmp_path / "plain"), "job_id").unknown(spark.range(40, 60).withColumnRenamed("id", "job_id")).count() == 10
    empty = spark.range(0).withColumnRenamed("id", "job_id")
    assert plain.replace(empty, []) == 2 and plain.read().count() == 50
    assert warehouse.upsert_buckets(BucketedTable(spark, str(tmp_path / "first"), "job_id"), empty, DAY_1) == 1
    assert again.touched(spark.range(500).withColumnRenamed("id", "job_id")) == [0, 1, 2, 3]


def test_changes(spark, jobs):
    batch = batch_of(spark, ("j1", -5), ("j2", 4), ("n1", 1), (None, 2))
    warehouse.upsert_buckets(jobs, batch, DAY_2)
    warehouse.delete_keys(jobs, batch_of(spark, ("j3", 0), ("never", 0)))
    found = rows_of(jobs.changes(1, ignore=("updated_at", "created_at")), "job_id", "change")
    assert found == sorted([("j1", "changed"), ("n1", "inserted"), (None, "inserted"), ("j3", "deleted")], key=str)
    assert ("j2", "changed") in rows_of(jobs.changes(1, 2), "job_id", "change")  # its time moved
    assert rows_of(jobs.changes(2, 3), "job_id", "change") == [("j3", "deleted")]
    assert jobs.changes(3, 3).count() == 0 and jobs.changes(None, 1).count() == 400
    moved = {b for row in jobs._log()[1:] for b in [*row["filled"], *row["emptied"]]}
    assert len(moved) < 16 and len(jobs.changes(1).inputFiles()) <= 2 * len(moved)


def test_links_follow_the_change_set(spark, jobs, tmp_path):
    links = BucketedTable(spark, str(tmp_path / "links"), "job_id", buckets=16, filters=False)
    pairs = jobs.read().select("job_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("skill_id"))
    warehouse.add_links(links, pairs)
    warehouse.add_links(links, pairs.where("job_id = 'j5'"))  # known ones
    assert links.read().count() == 800
    warehouse.delete_keys(jobs, batch_of(spark, ("j5", 0), ("j6", 0)))
    before = files(links)
    warehouse.prune_links(links, jobs.changes(1))
    assert links.read().count() == 796 and links.read().where("job_id in ('j5', 'j6')").count() == 0
    new = set(files(links)) - set(before)
    assert {n.split("/")[1] for n in new} == {f"bucket={b}" for b in links.touched(batch_of(spark, ("j5", 0), ("j6", 0)))}
    warehouse.prune_links(links, jobs.changes(2, 2), spark.createDataFrame([(2,)], "skill_id int"))
    assert rows_of(links.read().select("skill_id").distinct(), "skill_id") == [(1,)] and links.read().count() == 398


def test_forget(spark, jobs):
    for day, value in ((DAY_2, 1), (DAY_3, 2)):
        warehouse.upsert_buckets(jobs, batch_of(spark, ("j7", value), ("j8", value)), day)
    touched, kept = len(jobs.touched(batch_of(spark, ("j7", 0), ("j8", 0)))), rows_of(jobs.read(), "job_id", "v")
    earlier = rows_of(jobs.read(at=2), "job_id", "v")
    assert jobs.forget(keep=2) == touched and rows_of(jobs.read(at=2), "job_id", "v") == earlier
    assert jobs.forget() == touched and jobs.forget() == 0
    assert rows_of(jobs.read(), "job_id", "v") == kept and jobs.unknown(batch_of(spark, ("j7", 0), ("zz", 0))).count() == 1


def test_unknown_keys_are_exact(spark, tmp_path):
    """A crowded filter says "maybe" to many unknown keys; the stored keys decide."""
    table = BucketedTable(spark, str(tmp_path / "t"), "job_id", buckets=2)
    stored = spark.range(0, 60_000, 3).select(F.concat(F.lit("key "), "id").alias("job_id"))
    table.replace(stored)
    asked = spark.range(20_000).select(F.concat(F.lit("key "), "id").alias("job_id"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([(None, -1), ("key 3", -2)], "job_id string, v long")
    )
    judged = table.possibly_known(asked)
    assert judged.where("not _maybe").join(stored, "job_id", "left_semi").count() == 0
    rate = judged.where("v % 3 <> 0 and _maybe").count() / (20_000 * 2 / 3)
    assert 0 <= rate < 0.02
    found = table.unknown(asked)
    assert found.columns == ["job_id", "v"]
    assert rows_of(found, "v") == sorted([(i,) for i in range(20_000) if i % 3] + [(-1,)], key=str)
    assert [tuple(r) for r in table.unknown(asked.limit(0)).collect()] == []


def test_stored_rows_are_not_shuffled_for_a_batch(spark, jobs):
    asked = batch_of(spark, ("j7", 0), ("zz", 0))
    found = jobs.unknown(asked)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert len([f for f in found.inputFiles() if "/data/" in f]) == 1  # the bucket of the one doubtful key


def test_the_row_that_stays_does_not_depend_on_partitions(spark):
    rows = spark.range(3000).select((F.col("id") % 40).alias("k"), F.col("id").alias("v"), F.array(F.col("id")).alias("a"))
    chosen = {tuple(map(str, r)) for r in keyed.dedupe(rows.repartition(7), "k").collect()}
    assert len(chosen) == 40
    for parts in (1, 3, 12):
        again = keyed.dedupe(rows.repartition(parts, F.rand(parts)), "k")
        assert {tuple(map(str, r)) for r in again.collect()} == chosen
        tied = keyed.dedupe_first(rows.repartition(parts, F.rand(parts)), "k", [F.lit(1)])
        assert {tuple(map(str, r)) for r in tied.collect()} == chosen
    target = warehouse.upsert(None, rows.select("k", "v"), "k", DAY_1)
    assert rows_of(target, "k", "v") == rows_of(warehouse.upsert(None, rows.select("k", "v").repartition(5), "k", DAY_1), "k", "v")


def test_a_filter_is_built_without_sorting_its_keys(spark, jobs):
    fresh = jobs.read().withColumn("bucket", jobs.bucket())
    bits = jobs._bits(fresh, 400)
    plan = bits._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan and "Generate" not in plan
    assert bits.agg(F.sum(F.size(F.array("word_0", "word_1", "word_2", "word_3")))).first()[0] <= 4 * 400


def test_filters_without_words_rule_out_nothing(spark, jobs, tmp_path):
    """Filters that an earlier form stored: a block number, and bits of another kind."""
    shutil.copytree(tmp_path / "jobs", tmp_path / "earlier")
    old = spark.read.parquet(str(tmp_path / "jobs/filters")).select("block", F.lit("?").cast("binary").alias("bits"), "blocks", "generation", "bucket")
    old.write.mode("overwrite").partitionBy("generation", "bucket").parquet(str(tmp_path / "earlier/filters"))
    asked = batch_of(spark, *[(f"j{i}", i) for i in range(500)], (None, -1))
    for name in ("jobs", "earlier"):
        found = BucketedTable(spark, str(tmp_path / name), "job_id").unknown(asked)
        assert rows_of(found, "v") == sorted([(i,) for i in range(400, 500)] + [(-1,)], key=str)


def test_a_bucket_is_dealt_over_several_tasks(spark, tmp_path):
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 7).alias("job_id"), F.col("id").alias("v"))
    table = BucketedTable(spark, str(tmp_path / "t"), "job_id", buckets=2)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        table.replace(rows)  # null is the key of half the rows
        files_of_null = table.read(table.touched(rows.where("job_id is null"))).inputFiles()
        assert len(files_of_null) > 4
        assert rows_of(table.read(), "job_id", "v") == rows_of(rows, "job_id", "v")
        warehouse.delete_keys(table, rows.where("job_id is null"))
        assert table.read().count() == 2000 and table.unknown(batch_of(spark, ("3", 0), (None, 0))).count() == 1
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_unique_links_are_merged_in_one_shuffle(spark, tmp_path):
    pairs = [("a", 1), ("a", 2), ("b", 1), ("b", 1), (None, 3), (None, 3)]
    later = [("a", 2), ("a", 3), ("c", 1), (None, 3), ("d", None)]
    first, second = (spark.createDataFrame(rows, "job_id string, skill_id int") for rows in (pairs, later))
    for unique, number in ((False, 4), (True, 4), (True, 16)):
        links = BucketedTable(spark, str(tmp_path / f"links{unique}{number}"), "job_id", buckets=number, filters=False)
        for found in (first, second, second):
            warehouse.add_links(links, found, unique=unique)
        assert rows_of(links.read(), "job_id", "skill_id") == sorted(set(pairs + later), key=str)
        plan = links._dealt(links.read().unionByName(second), True)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" in plan
