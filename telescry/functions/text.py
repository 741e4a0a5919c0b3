"""Strings, JSON, safe casts and ISO times."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def short_hostname(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def truthy(c: Column) -> Column:
    """Text that is present and not empty."""
    return F.coalesce(c != "", F.lit(False))


def non_empty(c: Column) -> Column:
    """Empty text becomes null."""
    return F.nullif(c, F.lit(""))


def strip_trailing_slashes(c: Column) -> Column:
    return F.rtrim(c, F.lit("/"))


def last_segment(uri: Column) -> Column:
    """Last path segment after trailing slashes are dropped; null for empty input."""
    return F.when(truthy(uri), F.substring_index(strip_trailing_slashes(uri), "/", -1))


def clean_url(url: Column) -> Column:
    """URL without its query string and without trailing slashes."""
    return strip_trailing_slashes(F.substring_index(url, "?", 1))


def to_long(c: Column) -> Column:
    return c.try_cast("bigint")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_flag(c: Column) -> Column:
    """True only for true / 'true' / 'True' / 1 / '1'; anything else, also a missing value, is false."""
    return F.coalesce(c.cast("string").isin("true", "True", "1"), F.lit(False))


def int_or_zero(c: Column) -> Column:
    """Whole number; bad text becomes 0, null stays null."""
    return F.when(c.isNotNull(), F.coalesce(to_long(c), F.lit(0)))


def string_array(c: Column) -> Column:
    """JSON text of an array; null and bad JSON become an empty array."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def parsed_once(c: Column) -> Column:
    """A parse result as a generator's output, to be aliased and selected from in the next step.

    Field accesses and predicates after it then share one parse per row; without it the optimizer
    copies the parse into every one of them.
    """
    return F.explode(F.array(c))


def canonical_json(c: Column) -> Column:
    """JSON text with sorted keys at every level (a variant stores object keys in order)."""
    return F.to_json(F.try_parse_json(c))


class _Number(str):
    """A number as its text."""


def _written(value) -> str:
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_written(v)}" for k, v in sorted(value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_written, value)) + "]"
    return str(value) if isinstance(value, _Number) else json.dumps(value, ensure_ascii=False)


def _no_number(text: str):
    raise ValueError(f"{text} is not JSON")


def _sorted_text(text: str | None) -> str | None:
    try:
        return None if text is None else _written(json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_no_number))
    except (ValueError, RecursionError):
        return None


def sorted_json(c: Column) -> Column:
    """JSON text with sorted keys at every level and numbers as they were written; null if it is not JSON.

    A variant would turn ``1.0`` into ``1`` and long numbers into doubles, so this one runs in Python, by Arrow batches.
    """
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(_sorted_text, na_action="ignore")

    return run.asNondeterministic()(c)  # one call per row, also under a filter


def ext_or_default(c: Column) -> Column:
    return F.coalesce(F.coalesce(canonical_json(c), c), F.lit("{}"))


def content_hash(columns: Sequence[str]) -> Column:
    """MD5 of the key-sorted JSON of the columns, nulls included."""
    ordered = F.struct(*[F.col(f"`{name}`").alias(name) for name in sorted(columns)])
    return F.md5(F.to_json(ordered, {"ignoreNullFields": "false"}))


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text -> timestamp; bad text -> null."""
    return F.try_to_timestamp(c)


def day_or_epoch(c: Column) -> Column:
    """``Y-m-d`` text -> date; missing or bad -> 1970-01-01."""
    parsed = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.to_date(F.try_to_timestamp(c, F.lit("y-M-d"))))
    return F.coalesce(parsed, F.lit("1970-01-01").cast("date"))


def epoch_or_null(c: Column) -> Column:
    """Epoch seconds -> timestamp; negative or bad -> null."""
    seconds = to_long(c)
    return F.when(seconds >= 0, F.timestamp_seconds(seconds))


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in sorted(mapping.items()) for part in pair])


def mapped(c: Column, mapping: Mapping[str, str]) -> Column:
    """Value of a small literal map, null when the key is unknown."""
    if not mapping:
        return F.lit(None).cast("string")
    return F.element_at(literal_map(mapping), c)


def duration_seconds(c: Column) -> Column:
    """``[D:]HH:MM:SS`` -> seconds; any bad part -> null."""
    parts = F.transform(F.split(c, ":"), lambda p: p.try_cast("bigint"))
    size = F.size(parts)
    hms = F.element_at(parts, -3) * 3600 + F.element_at(parts, -2) * 60 + F.element_at(parts, -1)
    return F.when(size == 3, hms).when(size == 4, F.element_at(parts, 1) * 86400 + hms)
