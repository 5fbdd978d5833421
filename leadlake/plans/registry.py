"""The registered queries by name, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function of (table reader) under its name, with its SQL."""

    def register(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
