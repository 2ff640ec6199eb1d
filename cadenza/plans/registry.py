"""All queries of the core."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.plans import data_queries, event_queries

_MODULES = (data_queries, event_queries)


def flagship(spark: SparkSession, directory: str) -> DataFrame:
    return event_queries.publish_upcoming(spark, directory)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for m in _MODULES for name, q in m.SQL.items()}
