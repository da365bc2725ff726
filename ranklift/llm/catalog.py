"""Registry of this subpackage: query name -> (spark, sf_dir) callable, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
MODULES = ("quality", "topk", "ngram_join", "toxicity", "langid", "substring", "licenses", "chat", "bpe_codec", "mixing",
           "decontam", "prefix_trie", "repair")


def register(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its oracle on DuckDB."""
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def load_all() -> None:
    """Import every operator module (idempotent)."""
    for m in MODULES:
        importlib.import_module(f"ranklift.llm.{m}")
