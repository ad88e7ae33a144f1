"""Clean postings stored by month: what a filter reads, and replacements that fail."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobloom.__main__ import main
from jobloom.operators import market
from jobloom.plans import dashboard as board
from jobloom.sources import storage


@pytest.fixture(scope="module")
def postings(spark):
    days = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 700).cast("int"))
    return spark.range(6000).select(
        F.concat(F.lit("j"), F.col("id")).alias("job_id"), F.lit("t").alias("title"), F.concat(F.lit("c"), F.col("id") % 90).alias("company"),
        F.when(F.col("id") % 3 == 0, "Remote").otherwise(F.concat(F.lit("town "), F.col("id") % 50)).alias("location"),
        F.when(F.col("id") % 41 > 0, days).alias("posted_date"), (F.col("id") * 1.5).alias("salary_min"), (F.col("id") * 2.0).alias("salary_max"),
        F.lit("python, sql").alias("skills"), F.lit(2).alias("skill_count"), F.lit("<b>python</b> sql").alias("description"),
    )


@pytest.fixture
def stored(spark, postings, tmp_path):
    storage.write_by_month(postings, str(tmp_path / "clean"))
    return str(tmp_path / "clean")


def scanned(df):
    """(files, partition filters) of the one scan of a plan without exchanges."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    df._jdf.queryExecution().executedPlan().executeCollect()
    return leaf.metrics().apply("numFiles").value(), leaf.toString()


def test_date_bounds_choose_folders(spark, stored, postings):
    read = spark.read.parquet(stored)
    chosen = market.filter_postings(read, ["Remote", "town 7"], "2024-03-05", "2024-04-02")
    plain = market.filter_postings(postings, ["Remote", "town 7"], "2024-03-05", "2024-04-02")
    order = lambda df: sorted((tuple(r) for r in df.select(*postings.columns).collect()), key=str)
    assert order(chosen) == order(plain) != []
    all_files, _ = scanned(read.select("job_id"))
    files, text = scanned(chosen.select("job_id"))
    assert files < all_files / 5 and "PartitionFilters: [isnotnull(posted_month" in text.replace("\n", "")
    assert "In(location" in text
    assert market.filter_postings(read).count() == 6000
    assert read.where(F.col(storage.MONTH).isNull()).count() == postings.where("posted_date is null").count()


def test_locations_lie_in_order(spark, stored):
    """Within a month's files locations ascend, so that few row groups hold a chosen one."""
    for folder in list(Path(stored).glob("posted_month=2024*"))[:4]:
        for file in folder.glob("*.parquet"):
            places = [r["location"] for r in spark.read.parquet(str(file)).collect()]
            assert places == sorted(places)


def test_a_filtered_board_reads_less(spark, stored, postings):
    filters = (["Remote"], "2024-05-01", "2024-05-31")
    with board.Dashboard(spark.read.parquet(stored), *filters) as laid, board.Dashboard(postings, *filters) as plain:
        assert storage.MONTH not in laid.postings.columns
        text = laid.postings._jdf.queryExecution().optimizedPlan().toString()
        assert laid.sections["metrics"].collect() == plain.sections["metrics"].collect() and text
        for name in ("top_companies", "timeline", "salary_metrics"):
            assert laid.sections[name].collect() == plain.sections[name].collect()


def test_hidden_column(spark, stored, postings):
    assert storage.read_clean(spark, stored).columns == postings.columns
    assert storage.read_clean(spark, stored, keep_month=True).columns == [*postings.columns, storage.MONTH]


def test_enrich_in_place_keeps_the_layout(spark, stored):
    main(["enrich", "--table", stored], spark)
    read = storage.read_clean(spark, stored, keep_month=True)
    assert read.count() == 6000 and storage.MONTH in read.columns and read.first()["description"] == "python sql"
    assert sorted(p.name for p in Path(stored).parent.iterdir()) == ["clean"]


def test_a_failing_write_leaves_the_table(spark, postings, tmp_path, monkeypatch):
    for kind in ("parquet", "csv"):
        path = str(tmp_path / f"clean_{kind}")
        storage.write_by_month(postings.limit(50), path) if kind == "parquet" else storage.write_csv(postings.limit(50), path)
        read = lambda: storage.read_clean(spark, path) if kind == "parquet" else storage.read_csv(spark, path)  # noqa: E731, B023
        before = sorted((tuple(r) for r in read().collect()), key=str)
        broken = F.when(F.col("job_id") == F.max("job_id").over(board.Window.partitionBy(F.lit(1))), F.raise_error(F.lit("broken")))
        with monkeypatch.context() as patch:
            patch.setattr("jobloom.__main__.enrich_table", lambda df, **_: df.withColumn("description", F.coalesce(broken.cast("string"), "title")))
            with pytest.raises(Exception, match="broken"):
                main(["enrich", "--table", path], spark)
        assert sorted((tuple(r) for r in read().collect()), key=str) == before


def test_a_move_that_fails_is_undone(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/file").write_text("old")
    with pytest.raises(OSError):
        storage.replace_folder(spark, str(tmp_path / "absent"), str(tmp_path / "t"))
    assert (tmp_path / "t/file").read_text() == "old" and not (tmp_path / "t.replaced").exists()
    (tmp_path / "n").mkdir()
    (tmp_path / "n/file").write_text("new")
    storage.replace_folder(spark, str(tmp_path / "n"), str(tmp_path / "t"))
    assert (tmp_path / "t/file").read_text() == "new" and not (tmp_path / "n").exists() and not (tmp_path / "t.replaced").exists()


def test_positions_of_whole_sections(spark):
    options = spark.range(20_000).select(F.concat(F.lit("place "), F.lpad("id", 6, "0")).alias("option"), F.lit(1).alias("first_date"))
    placed = board.with_position("filter_options", options.repartition(9, F.rand(1)))
    rows = sorted((r["position"], r["option"]) for r in placed.collect())
    assert rows == [(i + 1, f"place {i:06}") for i in range(20_000)]
    pairs = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9)], "pair string, count long")
    for sizes in (board.Sizes(), board.Sizes(pairs=None)):
        assert [r["pair"] for r in board.with_position("skill_cooccurrence", pairs, sizes).orderBy("position").collect()] == ["c", "a", "b"]
