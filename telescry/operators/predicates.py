"""Presence predicates and routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telescry.functions.text import clean_url


def any_present(paths: Sequence[str]) -> Column:
    """B1: true when no path is configured or at least one path is not null."""
    if not paths:
        return F.lit(True)
    return F.coalesce(*[F.when(F.col(p).isNotNull(), F.lit(True)) for p in paths], F.lit(False))


def all_present(paths: Sequence[str]) -> Column:
    """B2: true when every path is not null."""
    present = F.lit(True)
    for path in paths:
        present = present & F.col(path).isNotNull()
    return present


def missing_paths(paths: Sequence[str]) -> Column:
    """Comma list of the required paths that are null ('' when complete)."""
    return F.concat_ws(",", *[F.when(F.col(p).isNull(), F.lit(p)) for p in paths])


def split_required(df: DataFrame, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """B2: rows that have every path, and the rejected rows with a ``reject_reason``."""
    rejected = df.filter(~all_present(paths)).withColumn(
        "reject_reason", F.concat(F.lit("missing "), missing_paths(paths)))
    return df.filter(all_present(paths)), rejected


def route_table(name: str, column: str = "table") -> Column:
    return F.col(column) == name


def route_url(pattern: str, column: str = "url") -> Column:
    """Pattern found in the URL without query string and trailing slashes."""
    url = clean_url(F.col(column))
    return F.coalesce((url != "") & url.rlike(pattern), F.lit(False))


def route_contains(text: str, column: str = "url", present: str | None = None) -> Column:
    """Text occurs in the URL and, if asked, a payload path is there."""
    hit = F.coalesce(F.col(column).contains(text), F.lit(False))
    return hit & F.col(present).isNotNull() if present else hit


def route_metric(name: str, metrics: Sequence[str], fields: str = "fields") -> Column:
    """Metric name matches and at least one known metric is in the ``fields`` map."""
    known = F.coalesce(*[F.element_at(F.col(fields), F.lit(m)) for m in metrics])
    return F.coalesce(F.col("name") == name, F.lit(False)) & known.isNotNull()


def route_type(kind: str, column: str = "type") -> Column:
    return F.coalesce(F.col(column) == kind, F.lit(False))


def route_targets(routes: Mapping[str, Column]) -> Column:
    """Names of all routes a message takes, for one explode instead of one scan per route."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in routes.items()]))
