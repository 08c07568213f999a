"""Names to queries and to their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from splicedf.sources import projection

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, more: str = ""):
    """Register a function of Tables under its name; sql follows the projection's common table expressions and `more`."""

    def add(f: Callable[[projection.Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(projection.Tables(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[f.__name__] = f"{projection.SQL}{', ' + more if more else ''} {sql}"
        return f

    return add
