"""Pieces of DuckDB SQL used by several oracles."""

from __future__ import annotations

from jobloom.functions import fields

DOC_TERMS = ("the", "rest", "de", "le", "la", "au")

BLANKS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+"


def initcap(x: str) -> str:
    return f"array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split({x}, ' ')], ' ')"


def strip_html(x: str) -> str:
    """For the references that occur in the given pages; `&amp;` has to come last."""
    text = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for name, sign in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{sign}', 'g')"
    return f"trim(regexp_replace({text}, '{BLANKS}', ' ', 'g'))"


def work_mode(x: str, words: tuple[str, ...] = fields.REMOTE_LOCATION_WORDS) -> str:
    tests = " or ".join(f"contains(lower({x}), '{word}')" for word in words)
    return f"case when {tests} then 'Remote' else 'Onsite' end"


def _named(x: str, table: dict[str, str], rest: str) -> str:
    cases = " ".join(f"when '{name}' then '{value}'" for name, value in table.items())
    return f"case {x} {cases} else {rest} end"


def location(x: str, legacy: bool = False) -> str:
    head = f"trim(regexp_extract(coalesce({x}, ''), '^[^|;]*'))"
    named = _named(f"lower({head})", fields.LOCATION_ALIASES, head)
    places = ", ".join(f"nullif(regexp_extract({named}, '{pattern}', 1), '')" for pattern in fields.PLACE_IN_REMOTE_TEXT)
    place = f"coalesce({places}, {named})"
    lead = r",?\s*" if legacy else r"(?:^|,\s*|\s+)"
    codes = rf"(?i){lead}({fields.COUNTRY_CODES})\s*$"
    short = rf"trim(regexp_replace(regexp_replace({place}, '{fields.REGION_TAIL}', ''), '{codes}', ''))"
    return initcap(f"coalesce(nullif({short}, ''), 'Remote')")


def is_remote(place: str, job_type: str) -> str:
    return f"(contains(lower({place}), 'remote') or contains(lower({job_type}), 'remote'))"


def job_type(x: str) -> str:
    return _named(f"lower(trim({x}))", fields.JOB_TYPES, "'Other'")


def salary(x: str) -> tuple[str, str]:
    """(salary_min, salary_max) expressions."""
    text = f"replace({x}, ',', '')"
    a, b = (
        f"try_cast(nullif(regexp_extract({text}, '{pattern}', 1), '') as double)"
        for pattern in (fields.FIRST_NUMBER, fields.SECOND_NUMBER)
    )
    top = f"greatest({a}, {b})"
    factor = (
        f"case when {top} < {fields.HOURLY_BELOW} then {fields.HOURS_PER_YEAR}::double"
        f" when {top} < {fields.MONTHLY_BELOW} then {fields.MONTHS_PER_YEAR}::double else 1.0::double end"
    )
    return f"(least({a}, {b}) * {factor})", f"(case when {b} is not null then {top} * {factor} end)"


def skills(x: str, terms: tuple[str, ...] = DOC_TERMS) -> str:
    """Sorted, joined names of the whole words found; names end in letters or in signs."""
    edge = r"[^\p{L}\p{N}_]"

    def test(term: str) -> str:
        literal = "".join(c if c.isalnum() or c == " " else "\\" + c for c in term)
        right = f"({edge}|$)" if term[-1].isalnum() else r"[\p{L}\p{N}_]"
        return f"case when regexp_matches({x}, '(?i)(^|{edge}){literal}{right}') then '{term}' end"

    return "concat_ws(', ', " + ", ".join(test(term) for term in sorted(terms)) + ")"


def skill_count(joined: str) -> str:
    return f"cast(case when {joined} = '' then 0 else len(string_split({joined}, ', ')) end as integer)"


# ---- dashboard sections over a source of clean postings ----------------------


def headline(source: str) -> str:
    return (
        "select count(*) as total_jobs, count(distinct company) as companies, count(distinct location) as locations,"
        " coalesce(round(avg(skill_count), 1), 0) as avg_skills, count(salary_min) as with_salary"
        f" from {source}"
    )


def top_values(source: str, column: str, n: int = 12) -> str:
    return (
        f"select {column} as name, count(*) as count from {source} where {column} is not null"
        f" group by {column} order by count(*) desc, {column} limit {n}"
    )


def timeline(source: str) -> str:
    return f"select posted_date as date, count(*) as count from {source} where posted_date is not null group by 1"


def mode_split(source: str) -> str:
    return (
        "select work_mode as mode, count(*) as count, round(count(*) * 100.0::double / sum(count(*)) over (), 1) as share"
        f" from {source} group by work_mode"
    )


def rankings(source: str) -> str:
    return f"select {initcap('skill')} as skill, demand from (select lower(trim(skill)) as skill, count(*) as demand from {source} group by 1)"


def totals(source: str) -> str:
    return f"select count(*) as total_mentions, count(distinct lower(trim(skill))) as unique_skills from {source}"


def cooccurrence(source: str, n: int = 15) -> str:
    """Self-join of distinct (job_id, skill) rows."""
    return (
        f"select {initcap('a')} || ' + ' || {initcap('b')} as pair, count from ("
        f"select x.skill as a, y.skill as b, count(*) as count from {source} x join {source} y"
        f" on x.job_id = y.job_id and x.skill < y.skill group by 1, 2 order by 3 desc, 1, 2 limit {n})"
    )


def salary_metrics(source: str) -> str:
    return f"""
select (select count(*) from {source} where salary_min > 0) as count,
 (select (min(v) + max(v)) / 2 from (select salary_min as v, row_number() over (order by salary_min) as r, count(*) over () as c
   from {source} where salary_min > 0) where r in ((c + 1) // 2, (c + 2) // 2)) as median_min,
 coalesce((select (min(v) + max(v)) / 2 from (select salary_max as v, row_number() over (order by salary_max) as r, count(*) over () as c
   from {source} where salary_min > 0 and salary_max is not null) where r in ((c + 1) // 2, (c + 2) // 2)), 0) as median_max,
 (select min(salary_min) from {source} where salary_min > 0) as full_min,
 (select greatest(max(salary_min), max(salary_max)) from {source} where salary_min > 0) as full_max"""


def dollars(x: str) -> str:
    return f"'$' || format('{{:,}}', cast(trunc({x}) as bigint))"


def histogram(source: str, bins: int = 12) -> str:
    """Count per bin by comparing every value with both edges."""
    edge = f"case when {{0}} >= {bins} then hi else {{0}} * ((hi - lo) / {bins}) + lo end"
    inside = f"{{0}} >= e.l and ({{0}} < e.r or e.i = {bins - 1})"
    return f"""
select cast(e.i as integer) as bin, {dollars('e.l')} || '–' || {dollars('e.r')} as range,
 (select count(*) from {source} where salary_min > 0 and {inside.format('salary_min')}) as min_salary,
 (select count(*) from {source} where salary_min > 0 and {inside.format('salary_max')}) as max_salary
from (select i, {edge.format('i')} as l, {edge.format('(i + 1)')} as r from range({bins}) g(i),
  (select min(least(salary_min, salary_max)) as lo, max(greatest(salary_min, salary_max)) as hi from {source} where salary_min > 0)) e"""


def own_histogram(source: str, bins: int = 12) -> str:
    def place(column: str) -> str:
        low, high = (f"(select {f}({column}) from {source} where salary_min > 0)" for f in ("min", "max"))
        bin_ = f"least(cast(floor(({column} - {low}) / (({high} - {low}) / {bins})) as bigint), {bins - 1})"
        # least() skips nulls: a missing salary belongs to no bin.
        return f"case when {column} is not null then {bin_} end"

    edge = f"case when {{0}} >= {bins} then hi else {{0}} * ((hi - lo) / {bins}) + lo end"
    return f"""
select cast(i as integer) as bin, {dollars(edge.format('i'))} || '–' || {dollars(edge.format('(i + 1)'))} as range,
 (select count(*) from {source} where salary_min > 0 and {place('salary_min')} = i) as min_salary,
 (select count(*) from {source} where salary_min > 0 and {place('salary_max')} = i) as max_salary
from range({bins}) g(i),
  (select min(least(salary_min, salary_max)) as lo, max(greatest(salary_min, salary_max)) as hi from {source} where salary_min > 0)"""


def ranges(source: str, n: int = 15, key: bool = False) -> str:
    return (
        f"select {'job_id, ' if key else ''}title[1:28] || ' — ' || company[1:12] as label, salary_min as min, salary_max as max"
        f" from {source} where salary_min > 0 and salary_max is not null order by salary_min desc, job_id limit {n}"
    )


def bars(source: str, n: int = 15) -> str:
    return f"""
select label, min, max, (min - lo) / (hi - lo) * 100 as left_percent,
 greatest((max - min) / (hi - lo) * 100, 1.5) as width_percent
from ({ranges(source, n)}) r,
 (select min(salary_min) as lo, max(greatest(salary_min, salary_max)) as hi from {source} where salary_min > 0)"""


def salary_table(source: str, n: int | None = 50, key: bool = False) -> str:
    return (
        f"select {'job_id, ' if key else ''}title, company, location, salary_min, salary_max from {source} where salary_min > 0"
        " order by salary_min desc, job_id" + (f" limit {n}" if n else "")
    )
