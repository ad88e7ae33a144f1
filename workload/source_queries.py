"""Sources and sinks (S1 to S13): feeds derived from orders, and write-read round trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from jobloom import schemas
from jobloom.functions.common import coerce_number
from jobloom.functions.fields import salary_text
from jobloom.operators import keyed
from jobloom.sources import buckets, feeds, storage
from jobloom.sources.storage import shared_folder
from workload.cleaning_queries import chain, cleaned_pages
from workload.registry import register
from workload.views import sql, view, with_views

# ---- landed payloads -----------------------------------------------------------
# Feed A: one payload per order with two postings, its own and a repeat of the next
# key. Feed B: one record per customer; some lack an id. Absent keys are real gaps.


def payloads_a(spark, sf_dir) -> DataFrame:
    text = sql(
        spark,
        sf_dir,
        """
select o_orderkey as payload_no, to_json(named_struct('jobs', array(
  named_struct('id', o_orderkey, 'title', o_orderpriority, 'company_name', concat('Company ', o_custkey),
    'candidate_required_location', case when o_orderkey % 4 <> 0 then concat('Place ', o_custkey % 50) end,
    'salary', case when o_orderkey % 3 = 0 then '$50,000' end, 'job_type', 'full_time', 'category', o_orderstatus,
    'description', concat('<p>', o_orderpriority, '</p>'), 'publication_date', date_format(o_orderdate, 'yyyy-MM-dd'),
    'url', concat('https://jobs.example.com/', o_orderkey), 'tags', array(o_orderstatus, lower(o_orderpriority))),
  named_struct('id', o_orderkey + 1, 'title', 'again', 'company_name', null, 'candidate_required_location', null,
    'salary', null, 'job_type', null, 'category', null, 'description', null, 'publication_date', null,
    'url', null, 'tags', null)))) as payload
from orders""",
    )
    parsed = F.from_json("payload", schemas.FEED_A_PAYLOAD)
    return text.select("payload_no", parsed["jobs"].alias("jobs"), "payload")


_FEED_A = """feed_a as (
 select 'remotive_' || o_orderkey as job_id, o_orderpriority as title, 'Company ' || o_custkey as company,
  case when o_orderkey % 4 <> 0 then 'Place ' || (o_custkey % 50) else 'Anywhere' end as location,
  case when o_orderkey % 3 = 0 then '$50,000' else '' end as salary, 'full_time' as job_type, o_orderstatus as category,
  '<p>' || o_orderpriority || '</p>' as description, strftime(o_orderdate, '%Y-%m-%d') as posted_date,
  'https://jobs.example.com/' || o_orderkey as url, o_orderstatus || ', ' || lower(o_orderpriority) as tags,
  'remotive' as source, o_orderkey as payload_no, 0 as place_no from orders
 union all
 select 'remotive_' || (o_orderkey + 1), 'again', '', 'Anywhere', '', '', '', '', '', '', '', 'remotive', o_orderkey, 1 from orders)"""


def records_b(spark, sf_dir) -> DataFrame:
    text = sql(
        spark,
        sf_dir,
        """
select c_custkey as payload_no, to_json(named_struct(
  'id', case when c_custkey % 9 <> 0 then cast(c_custkey as string) end, 'position', c_mktsegment, 'company', c_name,
  'location', case when c_custkey % 2 = 0 then concat('Town ', c_nationkey) end,
  'salary_min', case c_custkey % 5 when 0 then 0 when 1 then null else cast(floor(abs(c_acctbal)) as bigint) + 1 end,
  'salary_max', case c_custkey % 3 when 0 then cast(2 * floor(abs(c_acctbal)) as bigint) + 2 when 1 then 0 end,
  'description', null, 'date', '2025-03-01T10:00:00+00:00', 'url', concat('https://b.example.com/', c_custkey),
  'tags', case when c_custkey % 2 = 1 then array(lower(c_mktsegment), 'b') end)) as record
from customer""",
    )
    return text.select("payload_no", F.from_json("record", schemas.FEED_B_JOB).alias("job"), "record")


_BOUND_LOW = "case c_custkey % 5 when 0 then 0 when 1 then null else cast(floor(abs(c_acctbal)) as bigint) + 1 end"
_BOUND_HIGH = "case c_custkey % 3 when 0 then cast(2 * floor(abs(c_acctbal)) as bigint) + 2 when 1 then 0 end"
_SALARY_TEXT = (
    f"case when coalesce({_BOUND_LOW}, 0) <> 0 and coalesce({_BOUND_HIGH}, 0) <> 0"
    f" then '$' || ({_BOUND_LOW}) || ' - $' || ({_BOUND_HIGH})"
    f" when coalesce({_BOUND_LOW}, 0) <> 0 then '$' || ({_BOUND_LOW}) || '+' else '' end"
)
_FEED_B = f"""feed_b as (
 select 'remoteok_' || c_custkey as job_id, c_mktsegment as title, c_name as company,
  case when c_custkey % 2 = 0 then 'Town ' || c_nationkey else 'Remote' end as location, {_SALARY_TEXT} as salary,
  'remote' as job_type, '' as category, '' as description, '2025-03-01T10:00:00+00:00' as posted_date,
  'https://b.example.com/' || c_custkey as url,
  case when c_custkey % 2 = 1 then lower(c_mktsegment) || ', b' else '' end as tags, 'remoteok' as source,
  c_custkey as payload_no, 0 as place_no from customer where c_custkey % 9 <> 0)"""

_RAW_LIST = ", ".join(schemas.RAW_COLUMNS)


def feed_a(spark, sf_dir) -> DataFrame:
    return feeds.normalise_feed_a(payloads_a(spark, sf_dir))


def feed_b(spark, sf_dir) -> DataFrame:
    return feeds.normalise_feed_b(records_b(spark, sf_dir))


@register("S1_normalise_feed_a", f"with {_FEED_A} select {_RAW_LIST} from feed_a")
def s1(spark, sf_dir):
    return feed_a(spark, sf_dir).select(*schemas.RAW_COLUMNS)


@register("S2_normalise_feed_b", f"with {_FEED_B} select {_RAW_LIST} from feed_b")
def s2(spark, sf_dir):
    return feed_b(spark, sf_dir).select(*schemas.RAW_COLUMNS)


@register("S1_normalise_landed_lines", f"with {_FEED_A} select {_RAW_LIST} from feed_a")
def s1_lines(spark, sf_dir):
    """The same responses landed a record per line and read as VARIANT values."""
    path = shared_folder(spark, "lines")
    feeds.frame_lines(payloads_a(spark, sf_dir), path, "payload")
    lines = feeds.records(feeds.read_lines(spark, path), "jobs")
    return feeds.normalise_records_a(lines).select(*schemas.RAW_COLUMNS)


@register("S2_normalise_landed_lines", f"with {_FEED_B} select {_RAW_LIST} from feed_b")
def s2_lines(spark, sf_dir):
    path = shared_folder(spark, "lines")
    feeds.frame_lines(records_b(spark, sf_dir), path, "record")
    return feeds.normalise_records_b(feeds.records(feeds.read_lines(spark, path))).select(*schemas.RAW_COLUMNS)


@register("S3_salary_text", f"select c_custkey, {_SALARY_TEXT} as salary from customer")
def s3(spark, sf_dir):
    records = records_b(spark, sf_dir)
    return records.select(
        F.col("payload_no").alias("c_custkey"), salary_text("job.salary_min", "job.salary_max").alias("salary")
    )


@register(
    "S4_combine_feeds",
    f"with {_FEED_A}, {_FEED_B} select {_RAW_LIST}, 0 as feed_no from feed_a"
    f" union all select {_RAW_LIST}, 2 as feed_no from feed_b",
)
def s4(spark, sf_dir):
    """The second feed failed and is skipped; its place stays free."""
    combined = feeds.combine_feeds(feed_a(spark, sf_dir), None, feed_b(spark, sf_dir))
    return combined.select(*schemas.RAW_COLUMNS, "feed_no")


@register(
    "S5_dedupe_first",
    f"with {_FEED_A}, {_FEED_B}, both_feeds as (select *, 0 as feed_no from feed_a union all select *, 1 from feed_b)"
    f" select {_RAW_LIST} from both_feeds"
    " qualify row_number() over (partition by job_id order by feed_no, payload_no, place_no) = 1",
)
def s5(spark, sf_dir):
    combined = feeds.combine_feeds(feed_a(spark, sf_dir), feed_b(spark, sf_dir))
    return keyed.dedupe_first(combined, "job_id", feeds.ORDER_COLUMNS).select(*schemas.RAW_COLUMNS)


@register(
    "S5_new_across_batches",
    f"with {_FEED_A}, {_FEED_B} select {_RAW_LIST} from (select * from feed_a"
    " qualify row_number() over (partition by job_id order by payload_no, place_no) = 1) first_rows"
    " where job_id not in (select 'remotive_' || o_orderkey from orders where o_orderdate < date '1997-01-01')",
)
def s5_across(spark, sf_dir):
    """Postings of a feed whose keys no earlier batch stored."""
    known = buckets.BucketedTable(spark, shared_folder(spark, "known"), "job_id")
    earlier = sql(spark, sf_dir, "select concat('remotive_', o_orderkey) as job_id, o_orderdate from orders")
    known.replace(earlier.where("o_orderdate < date '1997-01-01'"))
    rows = keyed.dedupe_first(feeds.combine_feeds(feed_a(spark, sf_dir)), "job_id", feeds.ORDER_COLUMNS)
    return known.unknown(rows.select(*schemas.RAW_COLUMNS))


# ---- files ----------------------------------------------------------------------


def _pages(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "page_postings")


@register(
    "S6_write_raw",
    with_views(
        "select f.form, p.* from page_postings p, (values ('csv'), ('json'), ('parquet')) f(form)", "page_postings"
    ),
)
def s6(spark, sf_dir):
    """Written once, read back from all three forms."""
    base = storage.shared_folder(spark, "raw")
    pages = _pages(spark, sf_dir)
    storage.write_raw(pages, base)
    forms = {
        "csv": storage.read_csv(spark, f"{base}/csv", one_line=True),
        "json": spark.read.schema(pages.schema).json(f"{base}/json"),
        "parquet": spark.read.parquet(f"{base}/parquet"),
    }
    return reduce(
        DataFrame.unionByName,
        [stored.select(F.lit(form).alias("form"), *pages.columns) for form, stored in forms.items()],
    )


@register("S7_read_raw", with_views("select *, '' as description, '' as tags from postings_raw", "postings_raw"))
def s7(spark, sf_dir):
    """Only CSV lies at the place, so the reader falls back to it."""
    base = storage.shared_folder(spark, "raw")
    storage.write_csv(view(spark, sf_dir, "postings_raw"), f"{base}/csv", one_line=True)
    return storage.read_raw(spark, f"{base}/parquet", f"{base}/csv")


@register(
    "S7_read_raw_line_breaks",
    with_views("select * exclude (description), replace(description, ' ', chr(10)) || '\\n' as description"
    " from page_postings", "page_postings"),
)
def s7_breaks(spark, sf_dir):
    """Texts with line breaks and backslashes come back out of a CSV with a row per line, and out of one without."""
    base = storage.shared_folder(spark, "raw")
    broken = _pages(spark, sf_dir).withColumn("description", F.concat(F.replace("description", F.lit(" "), F.lit("\n")), F.lit("\\n")))
    storage.write_csv(broken.where("job_id like '%1'"), f"{base}/lines", one_line=True)
    storage.write_csv(broken.where("job_id not like '%1'"), f"{base}/whole")
    read = [storage.read_raw(spark, None, f"{base}/lines"), storage.read_raw(spark, None, f"{base}/whole", one_line=False)]
    return read[0].unionByName(read[1]).select(*broken.columns)


@register(
    "S8_ensure_columns",
    with_views("select *, '' as category, '' as url from postings_raw", "postings_raw"),
)
def s8(spark, sf_dir):
    return storage.ensure_columns(view(spark, sf_dir, "postings_raw"), ["title", "category", "url"])


@register(
    "S9_order_columns",
    with_views(
        "select job_id, title, company, location, work_mode, salary_min, salary_max, skill_count, posted_date from postings_clean",
        "postings_clean",
    ),
)
def s9(spark, sf_dir):
    return storage.order_columns(view(spark, sf_dir, "postings_clean"))


@register("S10_write_clean", chain("select * from cleaned"))
def s10(spark, sf_dir):
    base = storage.shared_folder(spark, "clean")
    storage.write_clean(cleaned_pages(spark, sf_dir), base)
    return storage.read_clean(spark, f"{base}/parquet")


@register("S11_read_clean", chain("select * from cleaned"))
def s11(spark, sf_dir):
    """Only CSV lies at the place; it comes back in the types of the clean schema."""
    base = storage.shared_folder(spark, "clean")
    storage.write_csv(cleaned_pages(spark, sf_dir), f"{base}/csv")
    return storage.read_clean(spark, f"{base}/parquet", f"{base}/csv")


_NUMBER_TEXT = (
    "case event_id % 8 when 0 then '' when 1 then 'n/a' when 2 then 'NaN' when 3 then 'inf' when 4 then '12d'"
    " when 5 then concat('-', cast(value as varchar(30))) else cast(value as varchar(30)) end"
)


@register(
    "S13_coerce_numeric",
    f"select event_id, case when {_NUMBER_TEXT} in ('', 'n/a', 'NaN', 'inf', '12d') then null"
    " else case when event_id % 8 = 5 then -value else value end end as number from events",
)
def s13(spark, sf_dir):
    text = sql(spark, sf_dir, f"select event_id, {_NUMBER_TEXT} as text from events")
    return text.select("event_id", coerce_number("text").alias("number"))
