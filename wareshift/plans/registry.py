"""Registry of the queries run on the driver tables: each entry is a
``(spark, sf_dir) -> DataFrame`` callable plus, when the result is
SQL-expressible, the equivalent DuckDB SQL used as the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}
COVERS: dict[str, str] = {}


def register(name: str, sql: str | None = None, covers: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        COVERS[name] = covers
        return fn

    return deco
