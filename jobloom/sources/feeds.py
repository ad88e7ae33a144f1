"""Two landed posting feeds, unified to one twelve-column raw row."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobloom import schemas
from jobloom.functions.common import text_or_empty
from jobloom.functions.fields import salary_text

# ---- fixed values: feed names, also the prefixes of posting keys --------------
FEED_A, FEED_B = "remotive", "remoteok"
FEED_A_LOCATION, FEED_B_LOCATION = "Anywhere", "Remote"
FEED_B_JOB_TYPE = "remote"
# -------------------------------------------------------------------------------

_CORRUPT = T.StructField("corrupt", T.StringType())

# Arrival order of a raw row: feed, then payload within the feed, then place in it.
ORDER_COLUMNS = ["feed_no", "payload_no", "place_no"]


def read_feed_a(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses of feed A: one JSON object with a `jobs` list per file.

    A file that is no JSON has no jobs and keeps its text in `corrupt`.
    """
    return (
        spark.read.schema(T.StructType([*schemas.FEED_A_PAYLOAD.fields, _CORRUPT]))
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", _CORRUPT.name)
        .json(path)
        .select("jobs", _CORRUPT.name, F.col("_metadata.file_path").alias("payload_no"))
    )


def read_feed_b(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses of feed B: one JSON list of objects per file; `corrupt` as for feed A."""
    return (
        spark.read.schema(T.StructType([*schemas.FEED_B_JOB.fields, _CORRUPT]))
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", _CORRUPT.name)
        .json(path)
        .select(
            F.struct(*schemas.FEED_B_JOB.fieldNames()).alias("job"), _CORRUPT.name, F.col("_metadata.file_path").alias("payload_no")
        )
        .withColumn("place_no", F.monotonically_increasing_id())
    )


def corrupt_payloads(landed: DataFrame) -> DataFrame:
    """Landed files that could not be parsed (as a whole): path, their text, records found all the same."""
    body = "jobs" if "jobs" in landed.columns else "job"
    files = landed.groupBy(F.col("payload_no").alias("path")).agg(
        F.max(_CORRUPT.name).alias(_CORRUPT.name), F.count(body).alias("records")
    )
    # The records are named in the test: Spark does not answer questions about the corrupt text alone.
    return files.where(F.col(_CORRUPT.name).isNotNull() & (F.col("records") >= 0))


def _with_order(columns: list[Column], frame: DataFrame) -> list[Column]:
    """Carry the arrival order along; what the input does not tell is the same for all.

    Payload marks become text of one width, so that feeds marked by number and
    feeds marked by file name can be appended.
    """
    payload, place = F.lit(""), F.lit(0).cast("bigint")
    if "payload_no" in frame.columns:
        payload = F.col("payload_no").cast("string")
        if not isinstance(frame.schema["payload_no"].dataType, T.StringType):
            payload = F.lpad(payload, 20, "0")
    if "place_no" in frame.columns:
        place = F.col("place_no").cast("bigint")
    return [*columns, payload.alias("payload_no"), place.alias("place_no")]


def _or_default(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def _columns_a(job: Column, source: str) -> list[Column]:
    return [
        F.concat(F.lit(f"{source}_"), text_or_empty(job["id"])).alias("job_id"),
        text_or_empty(job["title"]).alias("title"),
        text_or_empty(job["company_name"]).alias("company"),
        _or_default(job["candidate_required_location"], FEED_A_LOCATION).alias("location"),
        text_or_empty(job["salary"]).alias("salary"),
        text_or_empty(job["job_type"]).alias("job_type"),
        text_or_empty(job["category"]).alias("category"),
        text_or_empty(job["description"]).alias("description"),
        text_or_empty(job["publication_date"]).alias("posted_date"),
        text_or_empty(job["url"]).alias("url"),
        text_or_empty(F.array_join(job["tags"], ", ")).alias("tags"),
        F.lit(source).alias("source"),
    ]


def _columns_b(job: Column, source: str) -> list[Column]:
    return [
        F.concat(F.lit(f"{source}_"), job["id"]).alias("job_id"),
        text_or_empty(job["position"]).alias("title"),
        text_or_empty(job["company"]).alias("company"),
        _or_default(job["location"], FEED_B_LOCATION).alias("location"),
        salary_text(job["salary_min"], job["salary_max"]).alias("salary"),
        F.lit(FEED_B_JOB_TYPE).alias("job_type"),
        F.lit("").alias("category"),
        text_or_empty(job["description"]).alias("description"),
        text_or_empty(job["date"]).alias("posted_date"),
        text_or_empty(job["url"]).alias("url"),
        text_or_empty(F.array_join(job["tags"], ", ")).alias("tags"),
        F.lit(source).alias("source"),
    ]


def normalise_feed_a(payloads: DataFrame, source: str = FEED_A) -> DataFrame:
    """Raw rows from payloads with a `jobs` list; a payload without one gives none."""
    order = [F.col("payload_no")] if "payload_no" in payloads.columns else []
    # The outer form: for the inner one Spark tests the list for emptiness below
    # the explode, and would parse a payload held as JSON text a second time.
    jobs = payloads.select(*order, F.posexplode_outer("jobs").alias("place_no", "job"))
    jobs = jobs.where(F.col("job").isNotNull())
    return jobs.select(*_with_order(_columns_a(F.col("job"), source), jobs))


def normalise_feed_b(records: DataFrame, source: str = FEED_B) -> DataFrame:
    """Raw rows from a `job` struct column; elements without an id are no postings."""
    job = F.col("job")
    return records.where(job["id"].isNotNull()).select(*_with_order(_columns_b(job, source), records))


# ---- landed lines ----------------------------------------------------------------------------
# A landing framed by lines (a JSON value per line) is read by as many tasks as it has blocks, however
# large a response was. Records stay VARIANT values, so fields that no schema names are kept.


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(payload_no, place_no, line, value) of the lines that are not blank; `value` is null where a line is no JSON."""
    lines = spark.read.text(path).select(
        F.concat(F.col("_metadata.file_path"), F.lit("#"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")).alias("payload_no"),
        F.monotonically_increasing_id().alias("place_no"), F.col("value").alias("line"),
    )
    return lines.where(F.trim("line") != "").withColumn("value", F.try_parse_json("line"))


def corrupt_lines(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON."""
    return lines.where(F.col("value").isNull()).select("payload_no", "place_no", "line")


def records(lines: DataFrame, list_at: str | None = None) -> DataFrame:
    """(payload_no, place_no, record): the records of every line, in order; `payload_no` names the line.

    A line holds a list of records, an object with a list in the field `list_at`, or a single
    record: an object without such a list, but with an `id`. Whatever is no object is no record.
    """
    many = F.try_variant_get("value", "$", "array<variant>")
    if list_at:
        many = F.coalesce(many, F.try_variant_get("value", f"$.{list_at}", "array<variant>"))
    single = F.when(F.try_variant_get("value", "$.id", "variant").isNotNull(), F.array("value"))
    line = F.concat("payload_no", F.lit("#"), F.lpad(F.col("place_no").cast("string"), 20, "0"))
    each = lines.select(line.alias("payload_no"), F.posexplode(F.coalesce(many, single)).alias("place_no", "record"))
    return each.where(F.try_variant_get("record", "$", "map<string,variant>").isNotNull())


def frame_lines(payloads: DataFrame, path: str, body: str = "value") -> None:
    """Land responses (JSON texts in a column) as lines, a record each: lists and lists in an object's only list field are taken apart.

    What a response holds beside its list is not kept; a text that is no JSON is kept as it is, on one line.
    """
    value = F.try_parse_json(body)
    lists = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.try_variant_get(value, "$.jobs", "array<variant>"))
    lines = F.coalesce(
        F.transform(lists, lambda record: F.to_json(record)),
        F.array(F.coalesce(F.to_json(value), F.regexp_replace(F.col(body), r"[\r\n]+", " "))),
    )
    payloads.select(F.explode(lines).alias("line")).write.mode("append").text(path)


def _typed(record: Column, schema: T.StructType) -> Column:
    """The fields of a schema out of a record; values that are no texts come as JSON."""

    def field(one: T.StructField) -> Column:
        path = f"$.{one.name}"
        if isinstance(one.dataType, T.ArrayType):
            return F.try_variant_get(record, path, one.dataType.simpleString()).alias(one.name)
        text = F.try_variant_get(record, path, "string")
        return F.coalesce(text, F.to_json(F.try_variant_get(record, path, "variant"))).alias(one.name)

    return F.struct(*[field(one) for one in schema.fields])


def normalise_records_a(found: DataFrame, source: str = FEED_A, keep_record: bool = False) -> DataFrame:
    """`normalise_feed_a` for records out of lines; with `keep_record`, the whole record goes along.

    Numbers come as VARIANT writes them: 50.10 as 50.1.
    """
    jobs = found.withColumn("job", _typed(F.col("record"), schemas.FEED_A_JOB))
    return jobs.select(*_with_order(_columns_a(F.col("job"), source), jobs), *(["record"] if keep_record else []))


def normalise_records_b(found: DataFrame, source: str = FEED_B, keep_record: bool = False) -> DataFrame:
    """`normalise_feed_b` for records out of lines; see `normalise_records_a`."""
    jobs = found.withColumn("job", _typed(F.col("record"), schemas.FEED_B_JOB)).where(F.col("job.id").isNotNull())
    return jobs.select(*_with_order(_columns_b(F.col("job"), source), jobs), *(["record"] if keep_record else []))


def combine_feeds(*feeds: DataFrame | None) -> DataFrame:
    """Append feeds in the given order; a feed that could not be read (None) is skipped.

    The place of the feed becomes `feed_no`, the first of `ORDER_COLUMNS`.
    """
    numbered = [
        feed.withColumn("feed_no", F.lit(number)) for number, feed in enumerate(feeds) if feed is not None
    ]
    if not numbered:
        raise ValueError("no feed could be read")
    return reduce(lambda done, feed: done.unionByName(feed, allowMissingColumns=True), numbered)
