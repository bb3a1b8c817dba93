"""Registered queries: each is (spark, sf_dir) -> DataFrame, with its DuckDB oracle SQL.

Every query reads the driver's tables (``documents``, ``conversations``,
``pages``) or views Spark derives from them (``fixtures``), over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import (  # noqa: F401
        queries_archives, queries_datasets, queries_figures, queries_interleave, queries_sinks, queries_text,
    )
