"""The registered queries of the library's own operators, and DuckDB SQL for each that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
MODULES = ["rows_queries", "field_queries", "fact_queries", "audit_queries", "chain_queries", "relation_queries", "stream_queries", "opening_queries", "rule_queries", "business_queries", "measure_queries", "silver_queries"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with the SQL that gives its rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    for m in MODULES:
        import_module(f"revlake.plans.{m}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
