"""Registry of runnable queries, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import spread

TEXT_HEAVY = ("documents", "pages", "conversations")  # long texts: the work is per row, not per byte read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The test tables of one scale factor, read lazily by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return spread(table) if name in TEXT_HEAVY else table

    def values(self, rows: str, schema: str) -> DataFrame:
        """A curated table written out in the query."""
        return self.spark.sql(f"SELECT * FROM VALUES {rows} AS v({schema})")


def query(name: str, sql: str | None = None):
    """Register `fn(tables) -> DataFrame` under `name`."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap
