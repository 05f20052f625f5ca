"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` under its own name; ``sql`` is the DuckDB text of the same result."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register
