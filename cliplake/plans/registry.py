"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cliplake.plans import clip_queries, core_queries, model_queries, stream_queries, table_queries

_MODULES = (core_queries, clip_queries, table_queries, model_queries, stream_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in _MODULES for name, text in module.SQL.items()}
