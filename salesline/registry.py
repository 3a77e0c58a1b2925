"""Registered queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return keep


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named columns, so that results compare exactly."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.round(F.col(c).cast("double"), d) for c, d in digits.items()})
