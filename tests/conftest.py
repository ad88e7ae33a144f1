import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from jobloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a column function to literal texts: one result per text, in order."""

    def run(function, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "place int, text string")
        return [row["result"] for row in rows.select("place", function("text").alias("result")).orderBy("place").collect()]

    return run


@pytest.fixture(scope="session")
def three_postings(spark):
    return spark.createDataFrame(
        [
            ("a1", "Data Engineer", "Acme", "Remote", 90000.0, 130000.0, "2025-03-01", "python, sql, docker", 3, True, "remotive"),
            ("a2", "Backend Dev", "Globex", "New York", 110000.0, 150000.0, "2025-03-02", "python, java", 2, False, "remotive"),
            ("a3", "ML Engineer", "Acme", "Remote", None, None, "2025-03-03", "python, pytorch, docker", 3, True, "remoteok"),
        ],
        "job_id string, title string, company string, location string, salary_min double, salary_max double,"
        " posted_date string, skills string, skill_count int, is_remote boolean, source string",
    )
