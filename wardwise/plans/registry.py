"""Named queries and, where SQL can state the result, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardwise.plans.views import Clinic, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, build: Callable[[Clinic], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = lambda spark, folder: build(Clinic(spark, folder))
    if sql is not None:
        ORACLES[name] = oracle(sql)


def load() -> None:
    """Import every module that registers queries."""
    from wardwise.plans import (  # noqa: F401
        balance_queries,
        clinical_queries,
        learning_queries,
        model_queries,
        source_queries,
        suite_queries,
        table_queries,
    )
