"""Registry of runnable queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tiersmith.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the equivalent SQL where there is one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query '{name}' registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
