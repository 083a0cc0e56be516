"""Cleaning (T4-T8, T12, D15-D17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def mode_value(df: DataFrame, col: str) -> Column:
    """Most frequent non-NULL value, smallest on ties, as a scalar.

    Counted by value with map-side combine, then the top row is taken: no
    per-group value map in a single task, and the result is one value.
    """
    counts = (df.filter(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("__n")))
    return counts.orderBy(F.desc("__n"), F.asc(col)).limit(1).select(col).scalar()


def fill_mode(df: DataFrame, col: str) -> DataFrame:
    """NULL -> the column's mode."""
    return df.withColumn(col, F.coalesce(F.col(col), mode_value(df, col)))


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """NULL -> a constant per column."""
    return df.fillna(values)


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """T5: drop rows with any NULL (NaN is not NULL in Spark; see D-rules)."""
    return df.dropna(how="any", subset=subset)


def dedupe(df: DataFrame) -> DataFrame:
    """T4: drop exact duplicate rows (NULLs compare equal, as in pandas)."""
    return df.dropDuplicates()


def null_sentinels(col, values: list) -> Column:
    """Sentinel values -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~c.isin(*values), c)
