"""Small helpers shared by the column expressions."""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_or_empty(value: Column | str) -> Column:
    return F.coalesce(as_col(value).cast("string"), F.lit(""))


def blank_to_null(value: Column) -> Column:
    return F.when(value != "", value)


def map_literal(table: dict, kind: str) -> Column:
    """A constant map of any depth: one literal that Catalyst folds at plan time."""
    return F.from_json(F.lit(json.dumps(table)), kind)


def mentions_any(value: Column, words: tuple[str, ...]) -> Column:
    """True where the lower-cased text contains at least one of the words."""
    lowered = F.lower(value)
    return reduce(or_, [lowered.contains(word) for word in words])


def finite(number: Column) -> Column:
    """The number, or null for NaN and infinities."""
    return F.when(F.abs(number) < float("inf"), number)


def coerce_number(value: Column | str) -> Column:
    """Number of a text, or null: unparsable text, NaN and infinities count as missing."""
    raw = as_col(value)
    # The shape test keeps out suffixes such as "12d" that a plain cast accepts.
    number_shape = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
    return finite(F.when(raw.cast("string").rlike(number_shape), raw.try_cast("double")))


def number_column(df: DataFrame, name: str) -> Column:
    """`coerce_number` of a stored column; one that holds numbers needs no parsing."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return finite(F.col(name).cast("double"))
    return coerce_number(name)


def title_case(value: Column | str) -> Column:
    """Capital after every non-letter, so `node.js` becomes `Node.Js`."""
    runs = F.regexp_extract_all(
        as_col(value), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1)
    )
    return F.array_join(F.transform(runs, F.initcap), "")


def dollars(value: Column) -> Column:
    """`$1,234`, fraction cut off."""
    return F.concat(F.lit("$"), F.format_number(value.cast("bigint"), 0))
