"""Parquet table scans (A2, A3).

Reads are lazy; Catalyst prunes columns and pushes filters into the Parquet
scan, so callers select only what they use and filter on raw columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One table of a warehouse folder (``<base>/<name>.parquet``).

    Every call lists the files anew, so a table that grew is read whole.
    """
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


class Warehouse:
    """Lazy accessors for the tables of one warehouse folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One listing per table and warehouse object (a query builds its own)."""
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.base, name)
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def names(self) -> tuple[str, ...]:
        return TABLES


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A3: a table registered in the session catalog (``db.table`` names)."""
    return spark.table(name)
