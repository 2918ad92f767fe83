"""Registration of named queries and of their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clientele.sources.adapter import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
REFERENCE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            REFERENCE_SQL[name] = sql
        return build

    return register
