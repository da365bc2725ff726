"""Registry of named queries (Spark callables) and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables.  Oracle SQL is registered next to the query that it checks; a
query without SQL gets a rows-only check plus pytest properties.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries (idempotent)."""
    import importlib
    for mod in MODULES:
        importlib.import_module(f"ranklift.plans.{mod}")


MODULES = ["q_eda", "q_metrics", "q_splits", "q_features", "q_audit", "q_runs", "q_text", "q_models", "q_derive"]
