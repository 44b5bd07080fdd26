"""Where plan modules put their queries: a builder (spark, sf_dir) -> DataFrame, and SQL for DuckDB where it can express the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Builder], Builder]:
    """Registers a builder under its own name."""

    def put(f: Builder) -> Builder:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
