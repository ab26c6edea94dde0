"""Registry of driver keys: each key has a Spark query and, when the result
is expressible in SQL, a DuckDB oracle over the same fixture views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from perfscore.plans.fixtures import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def key(name: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir)`` under ``name`` with an optional oracle."""
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate key {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_fixtures(oracle, *views) if views else oracle
        return fn
    return deco
