"""Registered queries: each runs library operators over whole tables, with the oracle SQL beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn

    return add


def load_all() -> None:
    from telescry.plans.registered import entities, flows, inputs, lookups, metrics, predicates, rollups, stores, versions  # noqa: F401
