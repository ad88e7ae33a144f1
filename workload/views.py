"""Views that shape the given tables like postings, feeds and run logs.

The SQL runs on Spark and on DuckDB alike; each view reads whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_POSTING_ROWS = "orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"

VIEWS = {
    # Clean postings.
    "postings_clean": f"""
select o_orderkey as job_id, o_orderpriority as title, c_name as company, n_name as location,
 cast(o_orderdate as date) as posted_date,
 case when o_orderkey % 5 <> 0 then o_totalprice end as salary_min,
 case when o_orderkey % 5 <> 0 and o_orderkey % 3 <> 0 then o_totalprice * 1.25 end as salary_max,
 case when o_orderkey % 4 = 0 then 'Remote' else 'Onsite' end as work_mode,
 cast(o_orderkey % 12 as int) as skill_count
from {_POSTING_ROWS}""",
    # Clean postings, some with NaN or infinite salaries.
    "postings_nan": f"""
select o_orderkey as job_id, o_orderpriority as title, c_name as company, n_name as location,
 cast(o_orderdate as date) as posted_date,
 case when o_orderkey % 7 = 0 then cast('NaN' as double) when o_orderkey % 5 <> 0 then o_totalprice end as salary_min,
 case when o_orderkey % 11 = 0 then cast('Infinity' as double) when o_orderkey % 13 = 0 then cast('NaN' as double)
   when o_orderkey % 3 <> 0 then o_totalprice * 1.25 end as salary_max,
 cast(o_orderkey % 12 as int) as skill_count, 'text' as description, o_orderkey % 4 = 0 as is_remote
from {_POSTING_ROWS}""",
    # The same with nulls in their place.
    "postings_missing": f"""
select o_orderkey as job_id, o_orderpriority as title, c_name as company, n_name as location,
 cast(o_orderdate as date) as posted_date,
 case when o_orderkey % 7 <> 0 and o_orderkey % 5 <> 0 then o_totalprice end as salary_min,
 case when o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0 and o_orderkey % 3 <> 0 then o_totalprice * 1.25 end as salary_max,
 cast(o_orderkey % 12 as int) as skill_count, 'text' as description, o_orderkey % 4 = 0 as is_remote
from {_POSTING_ROWS}""",
    # One row per posting and skill.
    "posting_skills": """
select distinct l_orderkey as job_id, lower(p_brand) as skill
from lineitem join part on l_partkey = p_partkey""",
    # The same with repeats and mixed case, skills of two words.
    "posting_mentions": """
select l_orderkey as job_id, p_name as skill
from lineitem join part on l_partkey = p_partkey""",
    # Raw postings without text.
    "postings_raw": f"""
select concat(case when o_orderkey % 2 = 0 then 'a_' else 'b_' end, cast(o_orderkey as varchar(20))) as job_id,
 o_orderpriority as title, c_name as company,
 case o_orderkey % 10 when 0 then '' when 1 then concat('Remote - ', lower(n_name)) when 2 then concat(n_name, ' (Remote)')
   when 3 then concat(n_name, ' / remote') when 4 then concat(n_name, ', DE') when 5 then 'nyc' when 6 then 'Worldwide'
   when 7 then concat(n_name, '|Other') when 8 then 'Austin, TX' else n_name end as location,
 case o_orderkey % 8 when 0 then ''
   when 1 then concat('$', cast(cast(floor(o_totalprice) as bigint) as varchar(20)), ' - $', cast(2*cast(floor(o_totalprice) as bigint) as varchar(20)))
   when 2 then '$45/hr' when 3 then '8,500 per month' when 4 then '$90k - $120k' when 5 then 'USD 120,000+' when 6 then '$60.5 to $40' else 'competitive' end as salary,
 case o_orderkey % 7 when 0 then 'full_time' when 1 then 'Part Time' when 2 then 'contract' when 3 then 'remote' when 4 then '' when 5 then 'per_diem' else 'Internship' end as job_type,
 case when o_orderkey % 11 = 0 then 'soon' else cast(cast(o_orderdate as date) as varchar(20)) end as posted_date,
 case when o_orderkey % 2 = 0 then 'a' else 'b' end as source
from {_POSTING_ROWS}""",
    # Raw postings whose text is a web page.
    "page_postings": """
select concat('p_', cast(page_id as varchar(20))) as job_id, url as title,
 concat('Company ', cast(page_id % 17 as varchar(20))) as company,
 case page_id % 9 when 0 then 'Berlin' when 1 then 'Remote - oslo' when 2 then 'San Jose, CA' when 3 then 'lyon; paris'
   when 4 then 'Anywhere' when 5 then 'sf' when 6 then 'Toulouse France' when 7 then 'Leeds, UK' else 'Bern - Remote (EU)' end as location,
 case page_id % 5 when 0 then '$60.5' when 1 then '$70,000 - $95,000' when 2 then '25 an hour' when 3 then '4,000' else '' end as salary,
 case page_id % 4 when 0 then 'full_time' when 1 then 'Freelance ' when 2 then 'remote' else 'parttime' end as job_type,
 html as description,
 case when page_id % 13 = 0 then 'n/a' else concat('2025-03-', cast(10 + page_id % 19 as varchar(20)), 'T23:30:00+05:00') end as posted_date,
 url as url, case when page_id % 3 = 0 then 'REST, au' else '' end as tags, 'pages' as source
from pages""",
    # Runs: each event starts a run that lasts as many seconds as its value.
    "runs": """
select concat('run_', cast(event_id as varchar(20))) as dag_run_id,
 case when event_type = 'error' then null else event_type end as state,
 case when user_id % 2 = 0 then 'manual' else 'scheduled' end as run_type,
 concat(cast(ts as varchar(40)), '+00:00') as start_date,
 case when event_type = 'purchase' then null when event_id % 10 = 3 then 'not yet'
   else concat(cast(ts + cast(floor(value * 100) as int) * interval '10' millisecond as varchar(40)), '+00:00') end as end_date
from events""",
}



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run SQL over the given tables, each read with only the columns the query needs."""
    after_from = re.compile(r"\b(from|join)\s+(" + "|".join(TABLES) + r")\b")
    return spark.sql(after_from.sub(lambda m: f"{m[1]} parquet.`{sf_dir}/{m[2]}.parquet`", text))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sql(spark, sf_dir, VIEWS[name])


def with_views(text: str, *names: str) -> str:
    """DuckDB text with the named views in front."""
    return "with " + ",\n".join(f"{name} as ({VIEWS[name]})" for name in names) + "\n" + text
