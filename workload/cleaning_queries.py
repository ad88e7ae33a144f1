"""Cleaning steps (C1 to C12) and quality summaries (Q1 to Q6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom.functions import fields, markup, skills as skill_functions
from jobloom.operators import cleaning, keyed, quality, skill_demand, term_join
from workload import sqltext as q
from workload.registry import register
from workload.views import table, view, with_views


def raw(text: str) -> str:
    return with_views(text, "postings_raw")


def on_raw(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "postings_raw")


# ---- repeats: every posting of source `a` arrives once more from source `c` ----

_REPEATED = (
    "repeated as (select 0 as feed_no, * from postings_raw"
    " union all select 1, * replace ('c' as source, 'again' as title) from postings_raw where source = 'a')"
)


def repeated(spark, sf_dir) -> DataFrame:
    first = on_raw(spark, sf_dir)
    again = first.where(F.col("source") == "a").withColumns({"source": F.lit("c"), "title": F.lit("again")})
    return first.withColumn("feed_no", F.lit(0)).unionByName(again.withColumn("feed_no", F.lit(1)))


@register("C1_dedupe", raw("select * from postings_raw"))
def c1(spark, sf_dir):
    return keyed.dedupe(repeated(spark, sf_dir), "job_id", ["feed_no"]).drop("feed_no")


@register(
    "C1_dedupe_counts",
    raw("").rstrip()
    + f", {_REPEATED} select count(*) as rows_before, count(distinct job_id) as rows_after,"
    " count(*) - count(distinct job_id) as dropped from repeated",
)
def c1_counts(spark, sf_dir):
    return keyed.dedupe_counts(repeated(spark, sf_dir), "job_id")


# ---- single fields -----------------------------------------------------------


@register("C2_strip_html", f"select page_id, {q.strip_html('html')} as description from pages")
def c2(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markup.strip_html("html").alias("description"))


# References by name and number, one that is none, and one that is escaped twice.
_REFERENCES = "<i> &lt;b&gt; &euro;5 &#233; &#x41; &hellip; &eacute; &unknown; &amp;lt;</i>"
_DECODED = "<b> €5 é A … é &unknown; &lt;"


@register(
    "C2_strip_html_references",
    f"select page_id, trim(concat({q.strip_html('html')}, ' {_DECODED}')) as description from pages",
)
def c2_references(spark, sf_dir):
    html = F.concat("html", F.lit(_REFERENCES))
    return table(spark, sf_dir, "pages").select("page_id", markup.strip_html(html).alias("description"))


@register("C3_work_mode", raw(f"select job_id, {q.work_mode('location')} as work_mode from postings_raw"))
def c3(spark, sf_dir):
    return on_raw(spark, sf_dir).select("job_id", fields.work_mode("location").alias("work_mode"))


@register("C4_normalise_location", raw(f"select job_id, {q.location('location')} as location from postings_raw"))
def c4(spark, sf_dir):
    return on_raw(spark, sf_dir).select("job_id", fields.normalise_location("location").alias("location"))


@register(
    "C4_normalise_location_legacy",
    raw(f"select job_id, {q.location('location', True)} as location from postings_raw"),
)
def c4_legacy(spark, sf_dir):
    return on_raw(spark, sf_dir).select("job_id", fields.normalise_location("location", True).alias("location"))


@register(
    "C5_is_remote",
    raw(f"select job_id, {q.is_remote(q.location('location'), 'job_type')} as is_remote from postings_raw"),
)
def c5(spark, sf_dir):
    places = cleaning.clean_places(on_raw(spark, sf_dir))
    return places.select("job_id", "is_remote")


@register("C6_parse_posted_date", raw("select job_id, try_cast(posted_date as date) as posted_date from postings_raw"))
def c6(spark, sf_dir):
    return cleaning.clean_dates(on_raw(spark, sf_dir)).select("job_id", "posted_date")


_MIN, _MAX = q.salary("salary")


@register("C7_parse_salary", raw(f"select job_id, {_MIN} as salary_min, {_MAX} as salary_max from postings_raw"))
def c7(spark, sf_dir):
    return cleaning.clean_salaries(on_raw(spark, sf_dir)).select("job_id", "salary_min", "salary_max")


_K_MIN, _K_MAX = q.salary(r"regexp_replace(replace(salary, ',', ''), '(?i)([0-9]+)k\b', '\1000', 'g')")


@register("C7_parse_salary_k", raw(f"select job_id, {_K_MIN} as salary_min, {_K_MAX} as salary_max from postings_raw"))
def c7_k(spark, sf_dir):
    return cleaning.clean_salaries(on_raw(spark, sf_dir), k_suffix=True).select("job_id", "salary_min", "salary_max")


@register("C8_normalise_job_type", raw(f"select job_id, {q.job_type('job_type')} as job_type from postings_raw"))
def c8(spark, sf_dir):
    return cleaning.clean_job_types(on_raw(spark, sf_dir)).select("job_id", "job_type")


# ---- skills -------------------------------------------------------------------


def _documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("description"), F.lit("").alias("tags"))


def _found(terms, text: str = "text") -> str:
    return f"select doc_id, {q.skills(text, terms)} as skills from documents"


@register("C9_extract_skills", _found(q.DOC_TERMS))
def c9(spark, sf_dir):
    return cleaning.extract_skills(_documents(spark, sf_dir), q.DOC_TERMS).select("doc_id", "skills")


@register("C9_extract_skills_tech", _found(skill_functions.TECH_SKILLS))
def c9_tech(spark, sf_dir):
    return cleaning.extract_skills(_documents(spark, sf_dir)).select("doc_id", "skills")


def _with_term() -> tuple[str, int]:
    """Every text followed by a term of the dictionary, in turn and in either case, and the terms' number.

    It comes twice, before a letter and before a blank: terms that end in a sign
    are found in the first place, all others in the second.
    """
    names = ", ".join(f"'{term}'" for term in skill_functions.TECH_SKILLS)
    count = len(skill_functions.TECH_SKILLS)
    term = f"(array({names}))[{{place}}]"
    chosen = f"case when doc_id % 2 = 0 then upper({term}) else {term} end"
    return f"concat(text, ' ', {chosen}, 'x ', {chosen}, ' ')", count


@register(
    "C9_extract_skills_all_terms",
    f"select doc_id, {q.skills('text', skill_functions.TECH_SKILLS)} as skills from (select doc_id,"
    f" {_with_term()[0].replace('(array(', '([').replace('))[', '])[').format(place=f'doc_id % {_with_term()[1]} + 1')} as text from documents)",
)
def c9_all(spark, sf_dir):
    text, count = _with_term()
    documents = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{text.format(place=f'cast(doc_id % {count} as int)')} as description", "'' as tags")
    return cleaning.extract_skills(documents).select("doc_id", "skills")


# Terms that contain or continue one another need more than one scan.
_NESTED = ("de", "de la", "la", "le", "an the", "the", "the on", "on")


@register("C9_extract_skills_nested", _found(_NESTED))
def c9_nested(spark, sf_dir):
    return cleaning.extract_skills(_documents(spark, sf_dir), _NESTED).select("doc_id", "skills")


def _terms(spark, terms) -> term_join.TermTable:
    return term_join.TermTable(spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in terms])).alias("term")))


@register("C9_skills_by_term_table", _found(skill_functions.TECH_SKILLS))
def c9_join(spark, sf_dir):
    terms = _terms(spark, skill_functions.TECH_SKILLS)
    return term_join.extract_skills(_documents(spark, sf_dir), terms, "doc_id").select("doc_id", "skills")


@register("C9_skills_by_term_table_nested", _found(_NESTED))
def c9_join_nested(spark, sf_dir):
    return term_join.extract_skills(_documents(spark, sf_dir), _terms(spark, _NESTED), "doc_id").select("doc_id", "skills")


# A dictionary that grows with the data: every longer word of the benchmark's texts.
_LARGE = "[A-Za-z]{7,}"


@register(
    "C9_skills_by_large_term_table",
    f"with terms as (select distinct lower(unnest(regexp_extract_all(text, '{_LARGE}'))) as term from benchmark),"
    " words as (select distinct doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) as term from documents)"
    " select doc_id, coalesce(string_agg(terms.term, ', ' order by terms.term), '') as skills,"
    " cast(count(terms.term) as integer) as skill_count"
    " from documents left join words using (doc_id) left join terms using (term) group by doc_id",
)
def c9_join_large(spark, sf_dir):
    words = F.explode(F.regexp_extract_all("text", F.lit(_LARGE), F.lit(0))).alias("term")
    terms = term_join.TermTable(table(spark, sf_dir, "benchmark").select(words))
    return term_join.extract_skills(_documents(spark, sf_dir), terms, "doc_id").select("doc_id", "skills", "skill_count")


@register(
    "C10_skill_count",
    f"select doc_id, {q.skill_count('skills')} as skill_count from ({_found(q.DOC_TERMS)})",
)
def c10(spark, sf_dir):
    return cleaning.extract_skills(_documents(spark, sf_dir), q.DOC_TERMS).select("doc_id", "skill_count")


@register(
    "C11_enrich_table",
    f"select page_id, description, {q.skills('description')} as skills, {q.skill_count(q.skills('description'))} as skill_count"
    f" from (select page_id, {q.strip_html('html')} as description from pages)",
)
def c11(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("description"))
    return cleaning.enrich_table(pages, q.DOC_TERMS)


# ---- the whole chain ----------------------------------------------------------

_CHAIN = f"""
 stripped as (select * replace ({q.strip_html('html_text')} as html_text) from
   (select * rename (description as html_text) from page_postings)),
 cleaned as (select job_id, title, company, {q.location('location')} as location,
   {q.is_remote(q.location('location'), 'job_type')} as is_remote, {q.work_mode('location')} as work_mode,
   salary, {_MIN} as salary_min, {_MAX} as salary_max, {q.job_type('job_type')} as job_type,
   {q.skills("(html_text || ' ' || tags)")} as skills,
   {q.skill_count(q.skills("(html_text || ' ' || tags)"))} as skill_count,
   html_text as description, try_cast(posted_date[:10] as date) as posted_date, url, tags, source
   from stripped)"""


def chain(text: str) -> str:
    return with_views("", "page_postings").rstrip() + "," + _CHAIN + "\n" + text


def cleaned_pages(spark, sf_dir) -> DataFrame:
    """Page postings, each fetched twice, through the whole chain."""
    first = view(spark, sf_dir, "page_postings").withColumn("feed_no", F.lit(0))
    again = first.withColumns({"feed_no": F.lit(1), "title": F.lit("again")})
    return cleaning.clean_postings(first.unionByName(again), q.DOC_TERMS, order=["feed_no"]).drop("feed_no")


@register("C12_clean_postings", chain("select * from cleaned"))
def c12(spark, sf_dir):
    return cleaned_pages(spark, sf_dir)


# ---- summaries ----------------------------------------------------------------


@register(
    "Q1_ingestion_summary",
    raw(
        "select count(*) as total_records, (select string_agg(distinct source, ', ' order by source) from postings_raw) as sources,"
        " count(distinct company) as companies, count(distinct location) as locations,"
        " min(posted_date) as first_posted, max(posted_date) as last_posted from postings_raw"
    ),
)
def q1(spark, sf_dir):
    return quality.ingestion_summary(on_raw(spark, sf_dir))


@register(
    "Q2_cleaning_summary",
    chain(
        "select count(*) as records, count(salary_min) as with_salary, count_if(skill_count > 0)::bigint as with_skills,"
        " count(distinct location) as locations, count(distinct company) as companies from cleaned"
    ),
)
def q2(spark, sf_dir):
    return quality.cleaning_summary(cleaned_pages(spark, sf_dir))


@register(
    "Q3_step_counters",
    chain(
        "select cast(round(avg(length(description))) as bigint) as mean_description_length,"
        " count_if(posted_date is null)::bigint as bad_dates, min(posted_date) as first_posted, max(posted_date) as last_posted,"
        " count(salary_min) as with_salary, cast(round(count(salary_min) * 100.0::double / count(*)) as integer) as salary_percent,"
        " count(distinct location) as locations, cast(round(count_if(is_remote) * 100.0::double / count(*)) as integer) as remote_percent"
        " from cleaned"
    ),
)
def q3(spark, sf_dir):
    return quality.step_counters(cleaned_pages(spark, sf_dir))


@register(
    "Q4_work_mode_counts",
    raw(f"select {q.work_mode('location')} as name, count(*) as count from postings_raw group by 1"),
)
def q4_mode(spark, sf_dir):
    return quality.category_counts(on_raw(spark, sf_dir), fields.work_mode("location"))


@register(
    "Q4_job_type_counts",
    raw(f"select {q.job_type('job_type')} as name, count(*) as count from postings_raw group by 1"),
)
def q4_type(spark, sf_dir):
    return quality.category_counts(on_raw(spark, sf_dir), fields.normalise_job_type("job_type"))


@register(
    "Q5_skill_stats",
    f"select round(avg(c), 1) as mean_skills, max(c) as max_skills, count_if(c = 0)::bigint as zero_skill_jobs"
    f" from (select {q.skill_count('skills')} as c from ({_found(q.DOC_TERMS)}))",
)
def q5(spark, sf_dir):
    return quality.skill_stats(cleaning.extract_skills(_documents(spark, sf_dir), q.DOC_TERMS))


@register(
    "Q5_top_skills",
    f"select {q.initcap('skill')} as skill, demand from (select skill, count(*) as demand from"
    f" (select unnest(string_split(skills, ', ')) as skill from ({_found(q.DOC_TERMS)})) where skill <> ''"
    " group by 1 order by 2 desc, 1 limit 15)",
)
def q5_top(spark, sf_dir):
    found = cleaning.extract_skills(_documents(spark, sf_dir), q.DOC_TERMS).withColumnRenamed("doc_id", "job_id")
    return skill_demand.skill_rankings(skill_demand.posting_skills(found)).limit(15)


@register(
    "Q5_top_brands",
    with_views(
        f"select {q.initcap('skill')} as skill, demand from (select skill, count(*) as demand from posting_skills"
        " group by 1 order by 2 desc, 1 limit 15)",
        "posting_skills",
    ),
)
def q5_brands(spark, sf_dir):
    """More names than are shown."""
    return skill_demand.skill_rankings(view(spark, sf_dir, "posting_skills")).limit(15)


@register(
    "Q6_step_row_counts",
    raw("").rstrip()
    + f", {_REPEATED} select 1 as step_no, 'extract' as step, count(*) as row_count from repeated"
    " union all select 2, 'transform', count(distinct job_id) from repeated"
    f" union all select 3, 'load', count(distinct job_id) from repeated where {_MIN} is not null",
)
def q6(spark, sf_dir):
    arrived = repeated(spark, sf_dir)
    unique = keyed.dedupe(arrived, "job_id", ["feed_no"])
    priced = cleaning.clean_salaries(unique).where(F.col("salary_min").isNotNull())
    return quality.step_row_counts({"extract": arrived, "transform": unique, "load": priced})
