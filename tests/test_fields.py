"""Single-field rules on example tables."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from jobloom.functions import common, fields, markup


@pytest.mark.parametrize("legacy", [False, True])
def test_locations(evaluate, legacy):
    cases = {
        # text: (default, legacy)
        "": ("Remote", "Remote"),
        None: ("Remote", "Remote"),
        "SF": ("San Francisco", "San Francisco"),
        "nyc": ("New York", "New York"),
        "dc": ("Washington D.c.", "Washington D.c."),
        "Worldwide": ("Remote", "Remote"),
        "global": ("Remote", "Remote"),
        "Remote - oslo": ("Oslo", "Oslo"),
        "remote — New york": ("New York", "New York"),
        "Lima (Remote)": ("Lima", "Lima"),
        "Rome – remote within EU": ("Rome", "Rome"),
        "Quito / remote": ("Quito", "Quito"),
        "Remote": ("Remote", "Remote"),
        "lyon; paris": ("Lyon", "Lyon"),
        "oslo | bergen": ("Oslo", "Oslo"),
        "Austin, TX": ("Austin", "Aust"),
        "Berlin": ("Berlin", "Berl"),
        "South Africa": ("South Africa", "South Afri"),
        "Leeds, UK": ("Leeds", "Leeds"),
        "Paris FR": ("Paris", "Paris"),
        "USA": ("Remote", "Remote"),
        "Boston, USA": ("Boston", "Boston"),
    }
    got = evaluate(lambda c: fields.normalise_location(c, legacy), list(cases))
    assert dict(zip(cases, got)) == {text: pair[legacy] for text, pair in cases.items()}


def test_work_mode_and_remote_flag(spark, evaluate):
    texts = ["Remote - EU", "WORLDWIDE", "anywhere", "Oslo", "", None]
    assert evaluate(fields.work_mode, texts) == ["Remote", "Remote", "Remote", "Onsite", "Onsite", "Onsite"]
    row = spark.sql("select 'Oslo' as place, 'REMOTE' as kind")
    assert row.select(fields.is_remote("place", "kind")).first()[0] is True


def test_posted_dates(evaluate):
    texts = ["2025-03-01", "2025-03-01T23:30:00+05:00", "2025-03-01 10:00:00", "soon", "", None]
    got = [str(day) if day else None for day in evaluate(fields.posted_date, texts)]
    assert got == ["2025-03-01", "2025-03-01", "2025-03-01", None, None, None]


def test_salaries(evaluate):
    cases = {
        "": (None, None),
        None: (None, None),
        "competitive": (None, None),
        "$45/hr": (45 * 2080, None),
        "8,500 per month": (8500 * 12, None),
        "$80,000 - $120,000": (80000, 120000),
        "$120,000 - $80,000": (80000, 120000),
        "USD 120,000+": (120000, None),
        "$90k - $120k": (90 * 2080, 120 * 2080),
        # The second number may start inside the first: a lone decimal reads as two.
        "$60.5": (5 * 2080, 60.5 * 2080),
        "$60.5 to $40": (40 * 2080, 60.5 * 2080),
    }
    got = evaluate(fields.salary_bounds, list(cases))
    assert {text: tuple(pair) for text, pair in zip(cases, got)} == cases


def test_salaries_in_thousands(evaluate):
    texts = ["$90k - $120k", "62.5K", "1.25k", "$70,000", "10k per month"]
    got = evaluate(lambda c: fields.salary_bounds(c, k_suffix=True), texts)
    assert [tuple(pair) for pair in got] == [
        (90000, 120000), (62500, None), (15000, None), (70000, None), (10000, None),
    ]


def test_job_types(evaluate):
    texts = ["full_time", "Full Time", "fulltime", "remote", "part_time", " parttime ", "contract", "freelance", "Internship", "", None, "per_diem"]
    assert evaluate(fields.normalise_job_type, texts) == [
        "Full-time", "Full-time", "Full-time", "Full-time", "Part-time", "Part-time", "Contract", "Freelance",
        "Internship", "Unknown", "Unknown", "Other",
    ]


def test_salary_text(spark):
    rows = spark.createDataFrame(
        [("90", "120"), ("90", None), ("90", "0"), ("0", "120"), (None, None), ("", "5")], "low string, high string"
    )
    got = [row[0] for row in rows.select(fields.salary_text("low", "high")).collect()]
    assert got == ["$90 - $120", "$90+", "$90+", "", "", ""]


def test_numbers(evaluate):
    texts = ["1.5", " -2e3 ", ".5", "7.", "", "n/a", "NaN", "inf", "12d", "0x10", None]
    assert evaluate(common.coerce_number, texts) == [1.5, -2000.0, 0.5, 7.0] + [None] * 7


def test_title_case(evaluate):
    names = ["python", "node.js", "ci/cd", "c++", "machine learning", "éa ÉB", "3d-art", "it's", "ß1x"]
    got = evaluate(common.title_case, names[:-1])
    assert got == [name.title() for name in names[:-1]]


def expected_text(text):
    if not text:
        return ""
    return re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", text))).strip()


EDGES = [
    None, "", "plain", "<p>a</p>", "a &amp; b", "AT&ampT", "&notit;", "&notin;", "&lt;b&gt;", "&#65;&#x41;&#X41;",
    "&#0;", "&#x80;", "&#129;", "&#1;", "&#xD800;", "&#x110000;", "&#99999999999;", "&#00000000065;", "&#xFFFE;", "&#x1F600;",
    "&;", "&#;", "&#x;", "& amp;", "&unknown;", "&ampamp;", "a&nbsp;b", " x y\x1cz\x85", "&CounterClockwiseContourIntegral;",
    "&lt", "&ltx", "&copy2024", "&hellip;&mdash;&eacute;&Eacute", "<a\nhref='x'>t</a>", "a < b > c", "&acE;", "1&frac12;", "&&amp;&",
]


def test_strip_html_edges(evaluate):
    got = evaluate(markup.strip_html, EDGES)
    assert dict(zip(EDGES, got)) == {text: expected_text(text) for text in EDGES}


def test_strip_html_random(evaluate):
    pick = random.Random(7)
    parts = ["&", "#", "x", ";", "amp", "lt", "copy", "not", "<b>", "</", ">", " ", "\n", "8364", "41", "é", "q", "&nbsp;", "&para"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(1, 14))) for _ in range(1500)]
    got = evaluate(markup.strip_html, texts)
    wrong = [(t, g, expected_text(t)) for t, g in zip(texts, got) if g != expected_text(t)]
    assert not wrong, wrong[:5]


def test_strip_html_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for row in pages.select("html", markup.strip_html("html").alias("text")).collect():
        assert row["text"] == expected_text(row["html"])


def test_map_literal_is_folded(spark):
    plan = spark.range(1).select(fields.normalise_job_type(F.col("id").cast("string")))
    assert "from_json" not in plan._jdf.queryExecution().optimizedPlan().toString()
