"""Query registry shared by the query groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query (and its DuckDB oracle SQL when SQL can express it)."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def s6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) as {alias}"


def big(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)
