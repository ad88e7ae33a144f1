"""Landings framed by lines: the same rows as whole responses, many tasks, nothing lost."""

import json

import pytest
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.__main__ import main
from jobloom.operators import keyed
from jobloom.sources import feeds, storage
from tests.test_tables import FEED_A, FEED_B


def rows(df):
    return sorted((tuple(r) for r in df.select(*schemas.RAW_COLUMNS).collect()), key=str)


def test_same_rows_as_whole_responses(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(FEED_A))
    (tmp_path / "b.json").write_text(json.dumps(FEED_B))
    whole = [feeds.normalise_feed_a(feeds.read_feed_a(spark, str(tmp_path / "a.json"))), feeds.normalise_feed_b(feeds.read_feed_b(spark, str(tmp_path / "b.json")))]
    a, b = feeds.read_lines(spark, str(tmp_path / "a.json")), feeds.read_lines(spark, str(tmp_path / "b.json"))
    lines = [feeds.normalise_records_a(feeds.records(a, "jobs")), feeds.normalise_records_b(feeds.records(b))]
    for one, other in zip(whole, lines, strict=True):
        assert rows(one) == rows(other) != []
        assert one.columns == other.columns
    combined = [keyed.dedupe_first(feeds.combine_feeds(*frames), "job_id", feeds.ORDER_COLUMNS) for frames in (whole, lines)]
    assert rows(combined[0]) == rows(combined[1])
    texts = spark.createDataFrame([(json.dumps(FEED_A),), (json.dumps(FEED_B),), ("no\njson",)], "value string")
    feeds.frame_lines(texts, str(tmp_path / "framed"))
    framed = feeds.read_lines(spark, str(tmp_path / "framed"))
    assert framed.count() == len(FEED_A["jobs"]) + len(FEED_B) + 1 and feeds.corrupt_lines(framed).first()["line"] == "no json"


def test_odd_lines(spark, tmp_path):
    lines = [
        "", "  ", "no json", "3", "null", '"text"', "[]", '{"jobs": 5}', '{"legal": "x"}', '{"jobs": [1, null, "a", {"id": 1}]}',
        '{"id": 2, "title": {"deep": [1]}, "salary": 50.5, "tags": ["a", 7, null], "more": {"x": [1, {"y": "z"}]}}', '[{"id": 3}, {"id": 4, "title": null}]',
    ]
    (tmp_path / "a").write_text("\n".join(lines))
    read = feeds.read_lines(spark, str(tmp_path / "a"))
    assert [r["line"] for r in feeds.corrupt_lines(read).collect()] == ["no json"]
    found = feeds.normalise_records_a(feeds.records(read, "jobs"), keep_record=True)
    got = {r["job_id"]: r for r in found.withColumn("more", F.try_variant_get("record", "$.more.x[1].y", "string")).collect()}
    assert sorted(got) == ["remotive_1", "remotive_2", "remotive_3", "remotive_4"]
    odd = got["remotive_2"]
    assert (odd["title"], odd["salary"], odd["tags"], odd["more"]) == ('{"deep":[1]}', "50.5", "a, 7", "z")
    assert got["remotive_1"]["location"] == "Anywhere"
    order = [r["job_id"] for r in found.orderBy("payload_no", "place_no").collect()]
    assert order == ["remotive_1", "remotive_2", "remotive_3", "remotive_4"]


def test_one_file_goes_to_many_tasks_in_order(spark, tmp_path):
    with open(tmp_path / "big.jsonl", "w") as file:
        for i in range(4000):
            file.write(json.dumps({"id": i % 1500, "title": f"t{i}", "unknown": i}) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        read = feeds.read_lines(spark, str(tmp_path / "big.jsonl"))
        assert read.rdd.getNumPartitions() > 4
        found = feeds.normalise_records_a(feeds.records(read))
        first = keyed.dedupe_first(feeds.combine_feeds(found), "job_id", feeds.ORDER_COLUMNS)
        assert {(r["job_id"], r["title"]) for r in first.collect()} == {(f"remotive_{i}", f"t{i}") for i in range(1500)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(job) for job in FEED_A["jobs"]) + "\nbroken {")
    (tmp_path / "b.jsonl").write_text(json.dumps(FEED_B))
    base = str(tmp_path / "out")
    main(["batch", "--lines", "--feed-a", str(tmp_path / "a.jsonl"), "--feed-b", str(tmp_path / "b.jsonl"), "--base", base], spark)
    said = capsys.readouterr().out
    assert "corrupt_payloads: 1 rows" in said and "load: 4 rows" in said
    kept = spark.read.json(f"{base}/raw/json")
    assert kept.count() == 5 and kept.where("content = 'broken {'").count() == 1
    raw = storage.read_raw(spark, None, f"{base}/raw/csv")
    assert rows(raw) == rows(spark.read.parquet(f"{base}/raw/parquet")) and raw.count() == 4


@pytest.mark.parametrize("one_line", [True, False])
def test_raw_csv_with_line_breaks(spark, tmp_path, one_line):
    texts = [("a", 'x "q",\n\\n y\r'), ("b", "")]
    storage.write_csv(spark.createDataFrame(texts, "job_id string, description string"), str(tmp_path / "csv"), one_line)
    read = storage.read_raw(spark, None, str(tmp_path / "csv"), one_line)
    assert sorted((r["job_id"], r["description"]) for r in read.collect()) == texts
