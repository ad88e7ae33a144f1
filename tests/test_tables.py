"""Feeds from files, round trips, keyed maintenance and the whole batch."""

import json
import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.__main__ import main
from jobloom.operators import keyed, market, quality, runlog, warehouse
from jobloom.plans import batch
from jobloom.sources import buckets, feeds, storage

DAY_1, DAY_2 = (datetime(2025, 3, day, 6, tzinfo=timezone.utc) for day in (1, 2))

FEED_A = {
    "legal": "x",
    "jobs": [
        {"id": 7, "title": "Data Engineer", "company_name": "Acme", "candidate_required_location": "Worldwide",
         "salary": "$80,000 - $90,000", "job_type": "full_time", "category": "Data", "tags": ["python", "SQL"],
         "description": "<p>Spark &amp; Kafka</p>", "publication_date": "2025-03-01T10:00:00", "url": "u7"},
        {"id": 8, "title": "Dev", "company_name": "Globex", "publication_date": "bad"},
        {"id": 7, "title": "Repeat", "company_name": "Other"},
    ],
}
FEED_B = [
    {"legal": "notice"},
    {"id": "9", "position": "ML Engineer", "company": "Acme", "location": "Berlin", "salary_min": 60000,
     "salary_max": 0, "description": "PyTorch", "date": "2025-03-02T00:00:00+00:00", "url": "u9", "tags": ["nlp"]},
    {"id": "10", "position": "Ops", "company": "Initech", "salary_min": 50000, "salary_max": 70000, "date": "2025-03-03", "tags": None},
]


@pytest.fixture
def landed(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(FEED_A))
    (tmp_path / "b.json").write_text(json.dumps(FEED_B))
    return (
        feeds.normalise_feed_a(feeds.read_feed_a(spark, str(tmp_path / "a.json"))),
        feeds.normalise_feed_b(feeds.read_feed_b(spark, str(tmp_path / "b.json"))),
    )


def test_feeds(landed):
    a, b = ([r.asDict() for r in feed.orderBy("place_no").collect()] for feed in landed)
    assert [r["job_id"] for r in a] == ["remotive_7", "remotive_8", "remotive_7"]
    assert a[0]["tags"] == "python, SQL" and a[0]["location"] == "Worldwide"
    assert (a[1]["location"], a[1]["salary"], a[1]["tags"], a[1]["url"]) == ("Anywhere", "", "", "")
    assert [r["job_id"] for r in b] == ["remoteok_9", "remoteok_10"]
    assert [r["salary"] for r in b] == ["$60000+", "$50000 - $70000"]
    assert [r["location"] for r in b] == ["Berlin", "Remote"]
    assert {r["job_type"] for r in b} == {"remote"}


def moment(stored):
    """A stored time as an instant: collected in the zone of this machine."""
    return stored.astimezone(timezone.utc)


def test_payload_without_jobs(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"legal": "x"}')
    assert feeds.normalise_feed_a(feeds.read_feed_a(spark, str(tmp_path / "a.json"))).count() == 0


def test_first_posting_stays(landed):
    unique = keyed.dedupe_first(feeds.combine_feeds(landed[0], None, landed[1]), "job_id", feeds.ORDER_COLUMNS)
    got = {r["job_id"]: r["title"] for r in unique.collect()}
    assert got == {"remotive_7": "Data Engineer", "remotive_8": "Dev", "remoteok_9": "ML Engineer", "remoteok_10": "Ops"}
    with pytest.raises(ValueError):
        feeds.combine_feeds(None)


def test_batch_twice(spark, landed, tmp_path):
    base = str(tmp_path / "out")
    assert batch.run_batch(spark, list(landed), base, DAY_1) == {"extract": 4, "transform": 4, "load": 4}
    clean = {r["job_id"]: r for r in storage.read_clean(spark, f"{base}/clean/parquet").collect()}
    first = clean["remotive_7"]
    assert (first["location"], first["work_mode"], first["job_type"]) == ("Remote", "Remote", "Full-time")
    assert (first["salary_min"], first["salary_max"]) == (80000.0, 90000.0)
    assert (first["skills"], first["skill_count"]) == ("kafka, python, spark, sql", 4)
    assert first["description"] == "Spark & Kafka" and str(first["posted_date"]) == "2025-03-01"
    assert clean["remotive_8"]["posted_date"] is None
    assert storage.read_clean(spark, f"{base}/clean/parquet").columns == schemas.CLEAN_COLUMNS

    def tables():
        jobs, links = (buckets.BucketedTable(spark, f"{base}/warehouse/{n}", "job_id").read() for n in ("jobs", "job_skills"))
        read = {"jobs": jobs, "skills": storage.VersionedTable(spark, f"{base}/warehouse/skills").read(), "job_skills": links}
        return {n: sorted(map(tuple, t.collect()), key=str) for n, t in read.items()}

    before = tables()
    assert [len(rows) for rows in before.values()] == [4, 6, 6]
    assert [r[1] for r in before["skills"]] == ["kafka", "nlp", "python", "pytorch", "spark", "sql"]

    batch.run_batch(spark, list(landed), base, DAY_2)
    after = tables()
    assert after["skills"] == before["skills"] and after["job_skills"] == before["job_skills"]
    assert [r[:-1] for r in after["jobs"]] == [r[:-1] for r in before["jobs"]]
    assert {moment(r[-1]) for r in after["jobs"]} == {DAY_2} and {moment(r[-2]) for r in after["jobs"]} == {DAY_1}
    summaries = {n: spark.read.parquet(f"{base}/summaries/{n}") for n in ("ingestion", "cleaning", "steps", "skills")}
    assert all(df.count() == 2 for df in summaries.values())
    assert summaries["ingestion"].first()["total_records"] == 4
    steps = spark.read.parquet(f"{base}/step_counts")
    assert steps.count() == 6 and steps.where("step = 'load'").count() == 2


def test_accepted_postings_are_stored_once(spark, tmp_path, monkeypatch):
    made = []
    folder = storage.shared_folder
    for module in (storage, warehouse):
        monkeypatch.setattr(module, "shared_folder", lambda spark, purpose: made.append(purpose) or folder(spark, purpose))
    rows = [("k1", "Dev", "sql, go"), ("k2", "Ops", "go"), ("k3", None, "refused")]
    spark.createDataFrame(rows, "job_id string, title string, skills string").withColumn("salary", F.lit("$1")).write.parquet(str(tmp_path / "clean/parquet"))
    for day in (DAY_1, DAY_2):
        assert batch.load(spark, str(tmp_path / "clean"), str(tmp_path / "warehouse"), day) == 2
    assert made.count("accepted") == 2 and "batch" not in made
    jobs, links = (buckets.BucketedTable(spark, str(tmp_path / "warehouse" / name), "job_id").read() for name in ("jobs", "job_skills"))
    assert sorted(r["job_id"] for r in jobs.collect()) == ["k1", "k2"] and links.count() == 3
    assert {moment(r["created_at"]) for r in jobs.collect()} == {DAY_1} and {moment(r["updated_at"]) for r in jobs.collect()} == {DAY_2}


def test_batch_stops_at_an_empty_step(spark, landed, tmp_path):
    none = [feed.limit(0) for feed in landed]
    with pytest.raises(batch.EmptyStep):
        batch.run_batch(spark, none, str(tmp_path / "out"), DAY_1)


def test_read_raw_without_files(spark, tmp_path):
    empty = storage.read_raw(spark, str(tmp_path / "no"), str(tmp_path / "none"))
    assert empty.count() == 0 and set(schemas.CLEANING_INPUTS) <= set(empty.columns)
    assert storage.read_clean(spark, None).count() == 0


def test_csv_keeps_text(spark, tmp_path):
    texts = [("a", ' lead "quoted", comma\nnext line \\ '), ("b", ""), ("c", None), ("d", "\\")]
    df = spark.createDataFrame(texts, "id string, text string")
    storage.write_csv(df, str(tmp_path / "csv"))
    assert sorted(map(tuple, storage.read_csv(spark, str(tmp_path / "csv")).collect())) == texts


def test_upsert_is_idempotent_and_keeps_created_at(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "k int, v string, n int")
    stored = warehouse.upsert(None, old, "k", DAY_1)
    once = warehouse.upsert(stored, new, "k", DAY_2, order=["n"])
    twice = warehouse.upsert(once, new, "k", DAY_2, order=["n"])
    expected = [(1, "a", DAY_1, DAY_1, None), (2, "y", DAY_1, DAY_2, 2), (3, "z", DAY_2, DAY_2, 1)]
    for result in (once, twice):
        got = [(r["k"], r["v"], moment(r["created_at"]), moment(r["updated_at"]), r["n"]) for r in result.collect()]
        assert sorted(got) == expected
    nulls = spark.createDataFrame([(None, "n"), (1, "b")], "k int, w string")
    once = warehouse.upsert(stored, nulls, "k", DAY_2)
    twice = warehouse.upsert(once, nulls, "k", DAY_2)
    assert once.count() == twice.count() == 3 and set(once.columns) == {"k", "v", "w", "created_at", "updated_at"}


def test_batch_time_has_an_offset(spark):
    rows = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        warehouse.upsert(None, rows, "k", datetime(2025, 3, 1, 6))
    far = datetime(2025, 3, 1, 1, tzinfo=timezone(timedelta(hours=-5)))
    before, zone = os.environ.get("TZ"), spark.conf.get("spark.sql.session.timeZone")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        stored = warehouse.upsert(None, rows, "k", far).select(F.unix_micros("created_at")).first()[0]
        runs = spark.createDataFrame(
            [("a", "2025-03-01", "2025-03-01T00:00:10Z"), ("b", "2025-03-01", "2025-03-01+02:00")], "dag_run_id string, start_date string, end_date string"
        )
        seconds = [r["duration_seconds"] for r in runlog.run_durations(runs).orderBy("dag_run_id").collect()]
    finally:
        os.environ.pop("TZ") if before is None else os.environ.update(TZ=before)
        time.tzset()
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert stored == DAY_1.timestamp() * 1e6 and seconds == [10.0, None]


def test_skill_ids_stay(spark):
    def names(*values):
        return spark.createDataFrame([(v,) for v in values], "skill_name string")

    dim = warehouse.upsert_skill_dim(None, names("sql", "go", "spark", "a", "é", "spa"))
    assert sorted(map(tuple, dim.collect())) == [(1, "a"), (2, "go"), (3, "spa"), (4, "spark"), (5, "sql"), (6, "é")]
    more = warehouse.upsert_skill_dim(dim, names("sql", "rust", "aws"))
    assert sorted(map(tuple, more.collect()))[6:] == [(7, "aws"), (8, "rust")]
    jobs = spark.createDataFrame([("j1", "SQL, rust,sql,  , cobol"), ("j2", None)], "job_id string, skills string")
    links = warehouse.link_job_skills(jobs, more)
    assert sorted(map(tuple, links.collect())) == [("j1", 5), ("j1", 8)]
    for made, declared in ((more, schemas.WAREHOUSE_SKILLS), (links, schemas.WAREHOUSE_LINKS)):
        assert made.dtypes == spark.createDataFrame([], declared).dtypes
    assert warehouse.prune_orphans(links, jobs.where("job_id = 'j2'"), more).count() == 0
    assert warehouse.prune_orphans(links, jobs, more.where("skill_name = 'sql'")).count() == 1


def test_warehouse_types_from_text(spark):
    df = spark.createDataFrame(
        [("k1", "t", "", "NaN", "2025-03-01", "true"), ("k2", "t", "12.345", "1e3", "", None), ("k3", None, "1", "2", "x", "false")],
        "job_id string, title string, salary_min string, salary_max string, posted_date string, is_remote string",
    )
    accepted, rejected = warehouse.to_warehouse_types(df)
    got = {r["job_id"]: r for r in accepted.collect()}
    assert got["k1"]["salary_min"] is None and got["k1"]["salary_max"] is None and got["k1"]["is_remote"] is True
    assert str(got["k2"]["salary_min"]) == "12.35" and got["k2"]["posted_date"] is None and got["k2"]["is_remote"] is False
    assert accepted.dtypes == spark.createDataFrame([], schemas.WAREHOUSE_JOBS).dtypes
    assert [r["job_id"] for r in rejected.collect()] == ["k3"]


def test_snapshot(spark):
    loads = []
    snapshot = storage.Snapshot(lambda: loads.append(1) or spark.range(5))
    assert snapshot.get().count() == snapshot.get().count() == 5 and len(loads) == 1
    snapshot.reload()
    snapshot.get()
    assert len(loads) == 2
    snapshot.reload()


def test_observed_counts_on_the_side(spark):
    df, watch = quality.observed(spark.range(42), "side")
    df.write.format("noop").mode("overwrite").save()
    assert watch.get["row_count"] == 42


def test_run_log(spark):
    runs = spark.createDataFrame(
        [
            ("r1", "success", "manual", "2025-03-01T00:00:00+00:00", "2025-03-01T00:00:00+00:00", "2025-03-01T00:01:00+00:00"),
            ("r2", None, "manual", None, "2025-03-02T00:00:00Z", None),
            ("r3", "failed", "manual", None, "2025-03-02T02:00:00+02:00", "2025-03-02T00:00:01.250Z"),
            ("r4", "failed", "manual", None, "2025-03-01", "later"),
        ],
        schemas.RUN,
    )
    seconds = {r["dag_run_id"]: r["duration_seconds"] for r in runlog.run_durations(runs).collect()}
    assert seconds == {"r1": 60.0, "r2": None, "r3": 1.3, "r4": None}
    assert sorted(map(tuple, runlog.run_state_summary(runs).collect())) == [("failed", 2), ("success", 1), ("unknown", 1)]
    assert [r["dag_run_id"] for r in runlog.recent_runs(runs, 9, most=1).collect()] == ["r2"]
    with pytest.raises(ValueError):
        runlog.recent_runs(runs, 0)
    assert [r["dag_run_id"] for r in runlog.recent_runs(runs).collect()] == ["r2", "r3", "r1", "r4"]


def test_dag_facts(spark, tmp_path):
    record = {"dag_id": "d", "is_paused": False, "is_active": True, "tags": [{"name": "etl"}, None],
              "tasks": [{"task_id": "extract_jobs"}, {"task_id": None}, {"task_id": "transform_jobs"}]}
    (tmp_path / "dag.json").write_text(json.dumps(record) + '\n{"dag_id": "empty"}')
    facts = runlog.dag_facts(spark.read.schema(schemas.DAG).json(str(tmp_path / "dag.json")))
    got = {r["dag_id"]: (r["tags"], r["task_count"], r["task_ids"]) for r in facts.collect()}
    assert got == {"d": (["etl"], 3, ["extract_jobs", "transform_jobs"]), "empty": ([], 0, [])}


def test_hot_key(spark):
    """A third of all rows share one key; the first of them is kept."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("job_id"),
        F.col("id").alias("place"),
    ).repartition(8)
    first = keyed.dedupe_first(df, "job_id", ["place"])
    assert first.where("job_id = 'hot'").first()["place"] == 0
    expected = df.groupBy("job_id").agg(F.min("place").alias("place"))
    assert first.exceptAll(expected).isEmpty() and expected.exceptAll(first).isEmpty()
    counts = keyed.dedupe_counts(df).first()
    assert (counts["rows_before"], counts["rows_after"]) == (30000, expected.count())
    assert market.top_values(df, "job_id", 1).first()["count"] == 10000


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "a.json").write_text(json.dumps(FEED_A))
    base = str(tmp_path / "out")
    main(["batch", "--feed-a", str(tmp_path / "a.json"), "--feed-b", str(tmp_path / "missing.json"), "--base", base], spark)
    assert "load: 2 rows" in capsys.readouterr().out
    main(["dashboard", "--base", base, "--out", f"{base}/board", "--location", "Remote"], spark)
    assert spark.read.json(f"{base}/board/metrics").first()["total_jobs"] == 2
    assert "Widget" not in spark.read.text(f"{base}/raw/json").first()["value"] and "content" in spark.read.json(f"{base}/raw/json").columns
    for kind in ("parquet", "csv"):
        read = spark.read.parquet if kind == "parquet" else lambda path: storage.read_csv(spark, path)
        for out in (["--out", f"{base}/enriched_{kind}"], []):
            main(["enrich", "--table", f"{base}/clean/{kind}", *out], spark)
            got = {r["job_id"]: r["skills"] for r in read(out[1] if out else f"{base}/clean/{kind}").collect()}
            assert got == {"remotive_7": "kafka, python, spark, sql", "remotive_8": ""}
    with pytest.raises(FileNotFoundError):
        main(["enrich", "--table", f"{base}/nowhere", "--out", f"{base}/x"], spark)
    main(["dashboard", "--base", f"{base}/nowhere", "--out", f"{base}/none"], spark)
    assert spark.read.json(f"{base}/none/error").columns == ["error", "position"]


def test_cut_off_payload_is_counted(spark, tmp_path, capsys):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed/a.json").write_text(json.dumps(FEED_A))
    (tmp_path / "feed/b.json").write_text(json.dumps(FEED_A)[:-9])
    landed = feeds.read_feed_a(spark, str(tmp_path / "feed"))
    assert [r["path"].rsplit("/", 1)[1] for r in feeds.corrupt_payloads(landed).collect()] == ["b.json"]
    main(["batch", "--feed-a", str(tmp_path / "feed"), "--base", str(tmp_path / "out")], spark)
    assert "corrupt_payloads: 1 rows" in capsys.readouterr().out


def test_csv_of_one_line_rows(spark, tmp_path):
    texts = [("a", ' lead "quoted", comma\nnext\r line \\n \\'), ("b", ""), ("c", None), ("d", "\\"), ("e", "\\\n")]
    storage.write_csv(spark.createDataFrame(texts, "id string, text string"), str(tmp_path / "csv"), one_line=True)
    assert sorted(map(tuple, storage.read_csv(spark, str(tmp_path / "csv"), one_line=True).collect())) == texts
    assert spark.read.text(str(tmp_path / "csv")).where("value <> 'id,text'").count() == 5


def test_shared_folder_is_demanded_on_a_cluster():
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, name, default=None):
            return self.master if name == "spark.master" else default

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    assert storage.shared_folder(Session("local[4]"), "x")
    with pytest.raises(ValueError):
        storage.shared_folder(Session("spark://somewhere:7077"), "x")


def test_missing_numbers_in_steps(spark):
    df = spark.createDataFrame(
        [(1.0, "d", "x", True), (float("nan"), "dd", "y", False), (float("inf"), None, "x", None)],
        "salary_min double, description string, location string, is_remote boolean",
    ).withColumn("posted_date", F.lit(None).cast("date"))
    assert quality.step_counters(df).first()["with_salary"] == 1


def test_run_overview(spark, tmp_path):
    (tmp_path / "runs.json").write_text("\n".join(json.dumps({"dag_run_id": f"r{i}", "state": "success", "start_date": f"2025-03-0{i}"}) for i in range(1, 8)))
    (tmp_path / "dags.json").write_text(json.dumps({"dag_id": "d", "tasks": [{"task_id": "t"}]}))
    main(["runs", "--log", str(tmp_path / "runs.json"), "--dags", str(tmp_path / "dags.json"), "--out", str(tmp_path / "out"), "-n", "6"], spark)
    assert spark.read.json(f"{tmp_path}/out/run_states").first()["runs"] == 7
    assert {r["dag_run_id"] for r in spark.read.json(f"{tmp_path}/out/recent_runs").collect()} == {f"r{i}" for i in range(2, 8)}
    assert spark.read.json(f"{tmp_path}/out/dags").first()["task_count"] == 1
