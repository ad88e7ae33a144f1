"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.operators import cleaning, keyed, market, quality, salaries, skill_demand, warehouse
from jobloom.sources import storage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "clean")
    spark.createDataFrame([], schemas.CLEAN).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(spark, clean):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    text = plan(market.top_values(market.filter_postings(clean, ["Oslo", "Rome"], "2025-01-01", "2025-02-01"), "company"))
    assert "In(location, [Oslo,Rome])" in text
    assert "GreaterThanOrEqual(posted_date,2025-01-01)" in text and "LessThanOrEqual(posted_date,2025-02-01)" in text
    assert "ReadSchema: struct<company:string,location:string,posted_date:date>" in text
    assert "GreaterThan(salary_min,0.0)" in plan(salaries.salary_table(clean))


def test_top_k_does_not_sort_everything(clean):
    for df in (market.top_values(clean, "company"), salaries.salary_table(clean), salaries.salary_ranges(clean),
               skill_demand.skill_cooccurrence(clean)):
        text = plan(df)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_first_row_is_chosen_before_the_shuffle(clean):
    text = plan(keyed.dedupe_first(clean, "job_id", ["posted_date"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_cleaning_shuffles_once_or_never(spark):
    raw = spark.createDataFrame([], schemas.RAW)
    assert plan(cleaning.clean_postings(raw, unique=True)).count("Exchange") == 0
    assert plan(cleaning.clean_postings(raw, order=["posted_date"])).count("Exchange") == 1


def test_counts_are_combined_before_the_shuffle(clean):
    for df in (market.timeline(clean), skill_demand.skill_cooccurrence(clean)):
        assert "partial_count" in plan(df)


def test_upsert_never_shuffles_the_target_for_a_small_batch(spark, clean, tmp_path):
    jobs, _ = warehouse.to_warehouse_types(clean)
    now = F.lit("2025-03-01").cast("timestamp")
    stored = jobs.withColumns({"created_at": now, "updated_at": now})
    text = plan(warehouse.upsert(stored, jobs, "job_id", now, unique=True))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_distinct_names_without_copies_of_rows(clean):
    for df in (market.headline_metrics(clean), quality.cleaning_summary(clean), quality.ingestion_summary(clean)):
        text = plan(df)
        assert "Expand" not in text and "collect_set" not in text


def test_upsert_with_broadcasts_off(spark, clean, tmp_path):
    """The repeated batch is made unique once, in the write; the rest reads what was written."""
    jobs, _ = warehouse.to_warehouse_types(clean)
    now = F.lit("2025-03-01").cast("timestamp")
    stored = jobs.withColumns({"created_at": now, "updated_at": now})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(warehouse.upsert(stored, jobs, "job_id", now, order=["posted_date"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Window" not in text and text.count("SortMergeJoin") == 3


def test_numbering_sorts_no_table_in_one_task(spark):
    names = spark.range(5000).select(F.concat(F.lit("name "), F.col("id")).alias("skill_name"))
    numbered = keyed.number_by_name(names, "skill_name", "n")
    assert "SinglePartition" not in plan(numbered.select("n").where("n > 3")).split("Window")[0]
    rows = numbered.orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1, 5001)) and [r["skill_name"] for r in rows] == sorted(r["skill_name"] for r in rows)


def test_one_line_csv_is_split(spark, tmp_path):
    frame = spark.range(20000).select(F.concat(F.lit("text\n"), F.col("id")).alias("text"))
    storage.write_csv(frame.coalesce(1), str(tmp_path / "csv"), one_line=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50_000)
    try:
        assert storage.read_csv(spark, str(tmp_path / "csv"), one_line=True).rdd.getNumPartitions() > 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
