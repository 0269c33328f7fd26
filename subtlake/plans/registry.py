"""Register of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subtlake.session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        name = f"q_{function.__name__}"
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of texts, for heavy work per row."""
    return spread(table(spark, sf_dir, name))
