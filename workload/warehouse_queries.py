"""Warehouse load (W1 to W6) on orders, parts and line items."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.operators import warehouse
from jobloom.plans import batch as batch_plan
from jobloom.sources import buckets, storage
from workload.registry import ORACLES, register
from workload.views import sql, table, view, with_views

FIRST_LOAD, SECOND_LOAD = "2025-03-01 06:00:00", "2025-03-02 06:00:00"

# The stored table holds orders up to a day; the batch brings those from another
# day on, so that the time between is updated and the rest is new. Orders of two
# priorities come twice in the batch, the later copy with another price.
STORED_TO, BATCH_FROM = "1998-12-31", "1997-01-01"

_STORED = f"stored as (select *, '2025-03-01 06:00:00' as created_at, '2025-03-01 06:00:00' as updated_at from orders where o_orderdate <= date '{STORED_TO}')"
_BATCH = (
    f"batch as (select * replace (case when o_orderpriority < '3' then o_totalprice + 2 else o_totalprice + 1 end as o_totalprice)"
    f" from orders where o_orderdate >= date '{BATCH_FROM}')"
)


def _at(time: str) -> Column:
    return F.lit(time).cast("timestamp")


def _as_text(df: DataFrame) -> DataFrame:
    shown = {name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in ("created_at", "updated_at")}
    return df.withColumns(shown).withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def stored_and_batch(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    stored = warehouse.upsert(
        None, orders.where(F.col("o_orderdate") <= F.lit(STORED_TO).cast("date")), "o_orderkey", _at(FIRST_LOAD), unique=True
    )
    recent = orders.where(F.col("o_orderdate") >= F.lit(BATCH_FROM).cast("date"))
    first = recent.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "copy_no": F.lit(1)})
    second = recent.where(F.col("o_orderpriority") < "3").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 2, "copy_no": F.lit(2)}
    )
    return stored, first.unionByName(second)


_UPSERTED = (
    f"with {_STORED}, {_BATCH} select * replace (cast(o_orderdate as date) as o_orderdate) from ("
    " select * from stored where o_orderkey not in (select o_orderkey from batch)"
    " union all select b.*, coalesce(s.created_at, '2025-03-02 06:00:00'), '2025-03-02 06:00:00'"
    " from batch b left join stored s on b.o_orderkey = s.o_orderkey)"
)


@register("W1_upsert", _UPSERTED)
def w1(spark, sf_dir):
    stored, batch = stored_and_batch(spark, sf_dir)
    return _as_text(warehouse.upsert(stored, batch, "o_orderkey", _at(SECOND_LOAD), order=["copy_no"]).drop("copy_no"))


@register("W1_upsert_stored_versions", _UPSERTED)
def w1_stored(spark, sf_dir):
    """The same through stored versions of the table; the batch is applied twice."""
    stored, batch = stored_and_batch(spark, sf_dir)
    orders = storage.VersionedTable(spark, storage.shared_folder(spark, "orders"))
    orders.write(stored)
    for _ in range(2):
        orders.write(warehouse.upsert(orders.read(), batch, "o_orderkey", _at(SECOND_LOAD), order=["copy_no"]))
    return _as_text(orders.read().drop("copy_no"))


@register("W1_upsert_buckets", _UPSERTED)
def w1_buckets(spark, sf_dir):
    """The same into key buckets; the batch is applied twice."""
    stored, batch = stored_and_batch(spark, sf_dir)
    orders = buckets.BucketedTable(spark, storage.shared_folder(spark, "orders"), "o_orderkey")
    orders.replace(stored)
    for _ in range(2):
        warehouse.upsert_buckets(orders, batch, _at(SECOND_LOAD), order=["copy_no"])
    return _as_text(orders.read().drop("copy_no"))


@register(
    "W1_changes_between_loads",
    f"with {_STORED}, {_BATCH}, result as ({_UPSERTED.removeprefix(f'with {_STORED}, {_BATCH} ')}),"
    " later as (select * from result where o_orderkey % 13 <> 0)"
    " select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, case when a.o_orderkey is null then 'inserted'"
    " when b.o_orderkey is null then 'deleted' else 'changed' end as change"
    " from stored a full join later b using (o_orderkey)"
    " where a.o_orderkey is null or b.o_orderkey is null or a.o_totalprice <> b.o_totalprice",
)
def w1_changes(spark, sf_dir):
    """Keys inserted, changed and deleted by a load and a deletion, out of the stored generations."""
    stored, batch = stored_and_batch(spark, sf_dir)
    orders = buckets.BucketedTable(spark, storage.shared_folder(spark, "orders"), "o_orderkey")
    first = orders.replace(stored)
    warehouse.upsert_buckets(orders, batch, _at(SECOND_LOAD), order=["copy_no"])
    warehouse.delete_keys(orders, orders.read().where(F.col("o_orderkey") % 13 == 0))
    return orders.changes(first, ignore=("created_at", "updated_at", "copy_no"))


@register(
    "W1_upsert_new_column",
    f"with {_STORED}, {_BATCH} select * replace (cast(o_orderdate as date) as o_orderdate) from ("
    " select *, null::varchar as note from stored where o_orderkey not in (select o_orderkey from batch)"
    " union all select b.*, coalesce(s.created_at, '2025-03-02 06:00:00'), '2025-03-02 06:00:00', 'batch'"
    " from batch b left join stored s on b.o_orderkey = s.o_orderkey)",
)
def w1_new_column(spark, sf_dir):
    """The batch has a column the table lacks, and lacks `created_at` and `updated_at`."""
    stored, batch = stored_and_batch(spark, sf_dir)
    batch = batch.withColumn("note", F.lit("batch"))
    return _as_text(warehouse.upsert(stored, batch, "o_orderkey", _at(SECOND_LOAD), order=["copy_no"]).drop("copy_no"))


@register(
    "W2_audit_columns",
    f"with result as ({_UPSERTED}) select created_at, updated_at, count(*) as row_count from result group by 1, 2",
)
def w2(spark, sf_dir):
    stored, batch = stored_and_batch(spark, sf_dir)
    loaded = _as_text(warehouse.upsert(stored, batch, "o_orderkey", _at(SECOND_LOAD), order=["copy_no"]))
    return loaded.groupBy("created_at", "updated_at").agg(F.count(F.lit(1)).alias("row_count"))


# Every third key has a wrong value of some kind; the rest is accepted.
_WAREHOUSE_INPUT = """
select concat('j_', cast(o_orderkey as varchar(20))) as job_id,
 case when o_orderkey % 21 = 0 then null else o_orderpriority end as title,
 case when o_orderkey % 21 = 3 then repeat('long name ', 60) else concat('Company ', cast(o_custkey as varchar(20))) end as company,
 'Remote' as location, case when o_orderkey % 2 = 0 then true end as is_remote, '$1' as salary,
 case when o_orderkey % 21 = 6 then o_totalprice * 1e9 when o_orderkey % 4 = 0 then cast('NaN' as double) else o_totalprice end as salary_min,
 case when o_orderkey % 5 = 0 then null else o_totalprice * 2 end as salary_max,
 'Full-time' as job_type, o_orderstatus as category, 'text' as description, cast(o_orderdate as date) as posted_date,
 'u' as url, 'orders' as source from orders"""

_TYPED = (
    "select job_id, title, company, location, coalesce(is_remote, false) as is_remote, salary as salary_raw,"
    " cast(case when isnan(salary_min) then null else salary_min end as decimal(12,2)) as salary_min,"
    " cast(salary_max as decimal(12,2)) as salary_max, job_type, category, description, posted_date, url, source"
    " from given where title is not null and length(company) <= 500 and (isnan(salary_min) or salary_min < 1e10)"
)


@register("W3_warehouse_types", f"with given as ({_WAREHOUSE_INPUT}) {_TYPED}")
def w3(spark, sf_dir):
    accepted, _ = warehouse.to_warehouse_types(sql(spark, sf_dir, _WAREHOUSE_INPUT))
    return accepted


@register(
    "W3_warehouse_rejects",
    f"with given as ({_WAREHOUSE_INPUT}) select job_id from given"
    " where title is null or length(company) > 500 or (not isnan(salary_min) and salary_min >= 1e10)",
)
def w3_rejects(spark, sf_dir):
    _, rejected = warehouse.to_warehouse_types(sql(spark, sf_dir, _WAREHOUSE_INPUT))
    return rejected.select("job_id")


_LOADED = (
    _WAREHOUSE_INPUT.replace("'u' as url", "concat('Sql, ', case when o_orderkey % 21 = 0 then 'refused, ' else '' end,"
    " 'tag', cast(o_orderkey % 40 as varchar(20)), ', ', o_orderpriority, ' ,sql') as skills, 'u' as url")
)


@register(
    "W5_load_with_refused_rows",
    f"with given as ({_LOADED}), accepted as ({_TYPED.replace('url, source', 'url, source, skills')}),"
    " links as (select distinct job_id, lower(trim(unnest(string_split(skills, ',')))) as skill from accepted)"
    " select cast((select count(*) from accepted) as bigint) as loaded, (select count(*) from accepted) as jobs,"
    " (select count(distinct skill) from links) as skills, (select count(*) from links) as links,"
    " (select count(*) from given) - (select count(*) from accepted) as refused,"
    " cast('2025-03-01 06:00:00|2025-03-02 06:00:00' as varchar) as times",
)
def w5_load(spark, sf_dir):
    """The load step twice over the same clean postings: accepted rows alone bring skills and links."""
    base = storage.shared_folder(spark, "load")
    sql(spark, sf_dir, _LOADED).write.parquet(f"{base}/clean/parquet")
    for day in (1, 2):
        loaded = batch_plan.load(spark, f"{base}/clean", f"{base}/warehouse", datetime(2025, 3, day, 6, tzinfo=timezone.utc))
    jobs, links = (buckets.BucketedTable(spark, f"{base}/warehouse/{name}", "job_id").read() for name in ("jobs", "job_skills"))
    skills = storage.VersionedTable(spark, f"{base}/warehouse/skills").read()
    refused = spark.read.parquet(f"{base}/warehouse/rejected").where("batch = '20250302T060000'")
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    times = F.array_join(F.array(*[F.date_format(F.min(name), "yyyy-MM-dd HH:mm:ss") for name in ("created_at", "updated_at")]), "|")
    return jobs.agg(F.count(F.lit(1)).alias("jobs"), times.alias("times")).select(
        F.lit(loaded).cast("bigint").alias("loaded"), "jobs", count(skills).alias("skills"), count(links).alias("links"),
        count(refused).alias("refused"), "times",
    )


def _names(spark, sf_dir, column: str) -> DataFrame:
    return warehouse.skill_names(table(spark, sf_dir, "part"), column)


def two_loads_of_skills(spark, sf_dir) -> DataFrame:
    """Part types first; then brands and part names, among types already known."""
    dim = storage.VersionedTable(spark, storage.shared_folder(spark, "skills"))
    first = dim.write(warehouse.upsert_skill_dim(None, _names(spark, sf_dir, "p_type")))
    later = [_names(spark, sf_dir, column) for column in ("p_brand", "p_type", "p_name")]
    return dim.write(warehouse.upsert_skill_dim(first, later[0].union(later[1]).union(later[2]).distinct()))


_DIM = """first_load as (select cast(row_number() over (order by n) as integer) as skill_id, n as skill_name
  from (select distinct lower(trim(p_type)) as n from part)),
 later as (select distinct lower(trim(n)) as n from (select p_brand as n from part union all select p_type from part union all select p_name from part)),
 dim as (select * from first_load union all
  select cast((select max(skill_id) from first_load) + row_number() over (order by n) as integer), n
  from later where n not in (select skill_name from first_load))"""


@register("W4_upsert_skill_dim", f"with {_DIM} select * from dim")
def w4(spark, sf_dir):
    return two_loads_of_skills(spark, sf_dir)


_LINKS = (
    "links as (select distinct job_id, skill_id from posting_mentions join dim on lower(trim(skill)) = skill_name)"
)


def mention_links(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    dim = two_loads_of_skills(spark, sf_dir)
    return warehouse.link_skills(view(spark, sf_dir, "posting_mentions"), dim), dim


@register(
    "W5_link_job_skills",
    with_views("", "posting_mentions").rstrip() + f", {_DIM}, {_LINKS} select job_id, skill_id from links",
)
def w5(spark, sf_dir):
    return mention_links(spark, sf_dir)[0]


@register(
    "W6_prune_orphans",
    with_views("", "posting_mentions").rstrip()
    + f", {_DIM}, {_LINKS} select job_id, skill_id from links"
    " where job_id in (select o_orderkey from orders where o_orderstatus <> 'P')"
    " and skill_id in (select skill_id from dim where skill_name not like 'red %')",
)
def w6(spark, sf_dir):
    """Postings in one status and skills of one kind were deleted; their links go too."""
    links, dim = mention_links(spark, sf_dir)
    jobs = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("job_id"))
    return warehouse.prune_orphans(links, jobs, dim.where(~F.col("skill_name").startswith("red ")))


@register("W6_prune_by_changes", ORACLES["W6_prune_orphans"])
def w6_changes(spark, sf_dir):
    """The same by the change set of the stored postings; links lie in buckets by posting."""
    found, dim = mention_links(spark, sf_dir)
    base = storage.shared_folder(spark, "warehouse")
    jobs, links = (buckets.BucketedTable(spark, f"{base}/{name}", "job_id") for name in ("jobs", "links"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("job_id"), "o_orderstatus")
    first = jobs.replace(orders)
    warehouse.add_links(links, found)
    warehouse.delete_keys(jobs, orders.where("o_orderstatus = 'P'"))
    warehouse.prune_links(links, jobs.changes(first), dim.where(F.col("skill_name").startswith("red ")))
    return links.read()
