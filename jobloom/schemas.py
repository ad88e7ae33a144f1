"""Declared schemas of every layer, so that no reader has to infer one."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# ---- fixed values: column names, kinds and limits of every layer ----------------
TEXT = T.StringType()
TEXTS = T.ArrayType(TEXT)

# One posting object of each landed feed. Salary bounds stay text so that the
# number is shown exactly as the feed wrote it.
FEED_A_JOB = _struct(
    ("id", TEXT),
    ("title", TEXT),
    ("company_name", TEXT),
    ("candidate_required_location", TEXT),
    ("salary", TEXT),
    ("job_type", TEXT),
    ("category", TEXT),
    ("description", TEXT),
    ("publication_date", TEXT),
    ("url", TEXT),
    ("tags", TEXTS),
)
FEED_B_JOB = _struct(
    ("id", TEXT),
    ("position", TEXT),
    ("company", TEXT),
    ("location", TEXT),
    ("salary_min", TEXT),
    ("salary_max", TEXT),
    ("description", TEXT),
    ("date", TEXT),
    ("url", TEXT),
    ("tags", TEXTS),
)
FEED_A_PAYLOAD = _struct(("jobs", T.ArrayType(FEED_A_JOB)))

RAW_COLUMNS = [
    "job_id", "title", "company", "location", "salary", "job_type",
    "category", "description", "posted_date", "url", "tags", "source",
]
RAW = _struct(*[(name, TEXT) for name in RAW_COLUMNS])

# Columns the cleaning steps read; absent ones are filled with "".
CLEANING_INPUTS = [
    "job_id", "description", "location", "job_type", "posted_date",
    "salary", "tags", "company", "title",
]

CLEAN = _struct(
    ("job_id", TEXT),
    ("title", TEXT),
    ("company", TEXT),
    ("location", TEXT),
    ("is_remote", T.BooleanType()),
    ("work_mode", TEXT),
    ("salary", TEXT),
    ("salary_min", T.DoubleType()),
    ("salary_max", T.DoubleType()),
    ("job_type", TEXT),
    ("category", TEXT),
    ("skills", TEXT),
    ("skill_count", T.IntegerType()),
    ("description", TEXT),
    ("posted_date", T.DateType()),
    ("url", TEXT),
    ("tags", TEXT),
    ("source", TEXT),
)
CLEAN_COLUMNS = CLEAN.fieldNames()

# Warehouse columns with the longest text each may hold (None: no limit).
WAREHOUSE_TEXT_LIMITS = {
    "job_id": 255, "title": 500, "company": 500, "location": 500,
    "salary_raw": None, "job_type": 100, "category": 200,
    "description": None, "url": None, "source": 50,
}
WAREHOUSE_JOBS = _struct(
    ("job_id", TEXT),
    ("title", TEXT),
    ("company", TEXT),
    ("location", TEXT),
    ("is_remote", T.BooleanType()),
    ("salary_raw", TEXT),
    ("salary_min", T.DecimalType(12, 2)),
    ("salary_max", T.DecimalType(12, 2)),
    ("job_type", TEXT),
    ("category", TEXT),
    ("description", TEXT),
    ("posted_date", T.DateType()),
    ("url", TEXT),
    ("source", TEXT),
)
WAREHOUSE_SKILLS = _struct(("skill_id", T.IntegerType()), ("skill_name", TEXT))
SKILL_NAME_LIMIT = 100
WAREHOUSE_LINKS = _struct(("job_id", TEXT), ("skill_id", T.IntegerType()))

RUN = _struct(
    ("dag_run_id", TEXT),
    ("state", TEXT),
    ("run_type", TEXT),
    ("logical_date", TEXT),
    ("start_date", TEXT),
    ("end_date", TEXT),
)
DAG = _struct(
    ("dag_id", TEXT),
    ("is_paused", T.BooleanType()),
    ("is_active", T.BooleanType()),
    ("description", TEXT),
    ("owners", TEXTS),
    ("tags", T.ArrayType(_struct(("name", TEXT)))),
    ("tasks", T.ArrayType(_struct(("task_id", TEXT)))),
)
# ---------------------------------------------------------------------------------
