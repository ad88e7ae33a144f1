"""Rules for single posting fields: location, work mode, date, salary, job type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobloom.functions.common import as_col, blank_to_null, map_literal, mentions_any, text_or_empty

# ---- fixed values: must equal the published ones for right results ----------
REMOTE_LOCATION_WORDS = ("remote", "worldwide", "anywhere")
FALLBACK_LOCATION_WORDS = ("remote", "worldwide")

LOCATION_ALIASES = {
    "": "Remote",
    "sf": "San Francisco",
    "nyc": "New York",
    "ny": "New York",
    "la": "Los Angeles",
    "dc": "Washington D.C.",
    "worldwide": "Remote",
    "anywhere": "Remote",
    "global": "Remote",
}
PLACE_IN_REMOTE_TEXT = (
    r"(?i)^remote\s*[-–—]\s*(.+)$",
    r"(?i)^(.+?)\s*\(\s*remote\s*\)$",
    r"(?i)^(.+?)\s*[-–—]\s*remote.*$",
    r"(?i)^(.+?)\s*/\s*remote$",
)
REGION_TAIL = r",\s*[A-Za-z]{2}$"
COUNTRY_CODES = "USA|US|UK|CA|DE|FR|AU|IN"

JOB_TYPES = {
    "full_time": "Full-time",
    "full time": "Full-time",
    "fulltime": "Full-time",
    "remote": "Full-time",
    "part_time": "Part-time",
    "part time": "Part-time",
    "parttime": "Part-time",
    "contract": "Contract",
    "freelance": "Freelance",
    "internship": "Internship",
    "": "Unknown",
}

FIRST_NUMBER = r"(\d+\.?\d*)"
SECOND_NUMBER = r"\d+\.?\d*\D+(\d+\.?\d*)"
HOURLY_BELOW, HOURS_PER_YEAR = 200, 2080.0
MONTHLY_BELOW, MONTHS_PER_YEAR = 10000, 12.0
# -----------------------------------------------------------------------------


def work_mode(location: Column | str) -> Column:
    """`Remote` or `Onsite`, judged on the location as the feed wrote it."""
    remote = mentions_any(text_or_empty(location), REMOTE_LOCATION_WORDS)
    return F.when(remote, F.lit("Remote")).otherwise(F.lit("Onsite"))


def normalise_location(location: Column | str, legacy_suffix: bool = False) -> Column:
    """One tidy place name, `Remote` where none is given.

    A trailing country code is dropped when it stands alone or after a comma or
    blank. `legacy_suffix=True` drops the letters wherever the text ends in
    them, so that `Berlin` becomes `Berl`, as older result sets have it.
    """
    head = F.trim(F.regexp_extract(text_or_empty(location), r"^[^|;]*", 0))
    named = F.coalesce(
        F.try_element_at(map_literal(LOCATION_ALIASES, "map<string,string>"), F.lower(head)), head
    )
    places = [blank_to_null(F.regexp_extract(named, pattern, 1)) for pattern in PLACE_IN_REMOTE_TEXT]
    # All four patterns ask for the word, so most rows skip them.
    place = F.when(F.lower(named).contains("remote"), F.coalesce(*places, named)).otherwise(named)
    lead = r",?\s*" if legacy_suffix else r"(?:^|,\s*|\s+)"
    country_tail = rf"(?i){lead}({COUNTRY_CODES})\s*$"
    short = F.trim(F.regexp_replace(F.regexp_replace(place, REGION_TAIL, ""), country_tail, ""))
    return F.initcap(F.coalesce(blank_to_null(short), F.lit("Remote")))


def is_remote(normalised_location: Column | str, raw_job_type: Column | str) -> Column:
    return mentions_any(text_or_empty(normalised_location), ("remote",)) | mentions_any(
        text_or_empty(raw_job_type), ("remote",)
    )


def posted_date(value: Column | str) -> Column:
    """Calendar day as written (no shift to UTC); null if the text is no date."""
    return as_col(value).try_cast("date")


def _numbers(value: Column | str, k_suffix: bool) -> tuple[Column, Column]:
    text = F.regexp_replace(text_or_empty(value), ",", "")
    if k_suffix:
        # Thousands shorthand: 90k -> 90000, 62.5k -> 62500.
        for decimals in (3, 2, 1):
            shape = rf"(?i)(\d+)\.(\d{{{decimals}}})k\b"
            text = F.regexp_replace(text, shape, "$1$2" + "0" * (3 - decimals))
        text = F.regexp_replace(text, r"(?i)(?<![\d.])(\d+)k\b", "$1000")
    # No match is the empty text: made null first, since a failing cast is slow.
    first, second = (
        blank_to_null(F.regexp_extract(text, pattern, 1)).try_cast("double")
        for pattern in (FIRST_NUMBER, SECOND_NUMBER)
    )
    return first, second


def salary_bounds(value: Column | str, k_suffix: bool = False) -> Column:
    """Struct (salary_min, salary_max) in money per year.

    The larger number tells the period: hourly, monthly or yearly. A lone
    number is a minimum without maximum. With the default, `$90k` reads as 90.
    """
    first, second = _numbers(value, k_suffix)
    # Bind the two extracted numbers once; later steps only read the struct.
    pair = F.array(F.struct(first.alias("a"), second.alias("b")))

    def scale(p: Column) -> Column:
        larger = F.greatest(p["a"], p["b"])
        factor = (
            F.when(larger < HOURLY_BELOW, F.lit(HOURS_PER_YEAR))
            .when(larger < MONTHLY_BELOW, F.lit(MONTHS_PER_YEAR))
            .otherwise(F.lit(1.0))
        )
        return F.struct(
            (F.least(p["a"], p["b"]) * factor).alias("salary_min"),
            F.when(p["b"].isNotNull(), larger * factor).alias("salary_max"),
        )

    return F.element_at(F.transform(pair, scale), 1)


def normalise_job_type(value: Column | str) -> Column:
    key = F.lower(F.trim(text_or_empty(value)))
    return F.coalesce(F.try_element_at(map_literal(JOB_TYPES, "map<string,string>"), key), F.lit("Other"))


def salary_text(lower: Column | str, upper: Column | str) -> Column:
    """Display text of two numeric bounds; zero and missing count as absent."""

    def present(bound: Column) -> Column:
        return F.coalesce(bound.cast("string") != "", F.lit(False)) & (
            F.coalesce(bound.try_cast("double"), F.lit(1.0)) != 0
        )

    low, high = as_col(lower), as_col(upper)
    text_low, text_high = low.cast("string"), high.cast("string")
    return (
        F.when(present(low) & present(high), F.concat(F.lit("$"), text_low, F.lit(" - $"), text_high))
        .when(present(low), F.concat(F.lit("$"), text_low, F.lit("+")))
        .otherwise(F.lit(""))
    )
