"""Aggregations and derived measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.numeric import pct


def count_rows(df: DataFrame, by: list[str] | None = None, out: str = "n") -> DataFrame:
    """Row count, grouped or global; a NULL group is kept (SQL rule)."""
    agg = F.count(F.lit(1)).alias(out)
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def attach_total(df: DataFrame, measure: str, out: str, source: DataFrame | None = None) -> DataFrame:
    """Add the grand total of ``measure`` to every row.

    The total is a scalar subquery (a one-row aggregate planned once and
    broadcast as a value): no single-partition window, no cross join.
    """
    src = df if source is None else source
    return df.withColumn(out, src.select(F.sum(measure)).scalar())


def share_of_total(df: DataFrame, measure: str, out: str, scale: int = 2,
                   precision: int = 5) -> DataFrame:
    """M1: ``measure / total * 100`` as DECIMAL(precision, scale)."""
    total = df.select(F.sum(measure)).scalar()
    return df.withColumn(out, pct(F.col(measure), total, scale, precision))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order``.

    Callers add the key as the last sort column so ties never depend on
    partitioning (D11); Spark plans ``TakeOrderedAndProject`` (per-partition
    top-k, then a merge of k rows per partition).
    """
    return df.orderBy(*order).limit(k)


def distinct_list(col: str, sep: str = ", ") -> Column:
    """Sorted distinct values joined by ``sep`` (order fixed for determinism)."""
    return F.array_join(F.array_sort(F.collect_set(F.col(col))), sep)


def filtered_distinct(col: str, flag: Column) -> Column:
    """Distinct count of ``col`` over rows where ``flag`` holds."""
    return F.count_distinct(F.when(flag, F.col(col)))


def hit_rate(col: str, flag: Column) -> Column:
    """Filtered distinct / distinct, 0 when there is nothing."""
    return F.coalesce(F.try_divide(filtered_distinct(col, flag), F.count_distinct(F.col(col))),
                      F.lit(0.0))


def distinct_count(col: str, approx: bool = False, count_null: bool = False, rsd: float = 0.01) -> Column:
    """Distinct count; ``approx`` uses a HyperLogLog++ sketch (fixed
    size per group); ``count_null`` counts NULL as one more value, as a BI
    tool's distinct count of a column with blanks does."""
    c = F.col(col)
    base = F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)
    if count_null:
        base = base + F.coalesce(F.max(F.when(c.isNull(), 1).otherwise(0)), F.lit(0))
    return base


def distinct_by_flags(df: DataFrame, col: str, flags: dict[str, Column], by: list[str] | None = None, out: str = "distinct") -> DataFrame:
    """Per group the distinct values of ``col`` (``out``) and those with a
    row where a flag holds (a column per flag).

    One aggregate by value, with the flags or-ed together, and one over the values:
    rows are not copied per distinct count (no Expand).
    """
    by = list(by or [])
    per_value = df.where(F.col(col).isNotNull()).groupBy(*by, F.col(col).alias("__v")).agg(
        *[F.coalesce(F.bool_or(f), F.lit(False)).alias(n) for n, f in flags.items()] or [F.lit(True).alias("__any")])
    return per_value.groupBy(*by).agg(F.count(F.lit(1)).alias(out), *[F.count_if(F.col(n)).alias(n) for n in flags])


def key_bitmaps(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """The integer keys of every group as bitmaps: ``by`` columns, ``bucket`` (32768
    neighbouring keys) and ``bits`` (4 KB), combined map-side.  For keys that lie
    close together; NULL keys are left out."""
    known = df.where(F.col(col).isNotNull())
    return (known.groupBy(*by, F.bitmap_bucket_number(F.col(col)).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(col))).alias("bits")))


def bitmap_distinct(bitmaps: DataFrame, by: list[str], out: str = "n") -> DataFrame:
    """Exact distinct keys per ``by`` (any part of the bitmaps' groups): bitmaps are
    or-ed together, so months add up to quarters without reading rows again."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(out))
