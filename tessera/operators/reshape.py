"""Pivot, unpivot and category reshaping."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.recode import ordinal
from tessera.operators.joins import bounded


def unpivot_named(df: DataFrame, ids: list[str], name_pattern: str, name: str,
                  value: str, blanks: tuple = ("-",)) -> DataFrame:
    """Wide sheet -> (ids, name, value), blank cells dropped.

    Value columns are those whose name matches ``name_pattern`` (so the sheet
    can grow without code changes).  ``DataFrame.unpivot`` keeps NULL cells,
    so NULL and the ``blanks`` placeholders are filtered explicitly.  Plans
    as an ``Expand``: no shuffle.
    """
    rx = re.compile(name_pattern)
    cols = [c for c in df.columns if rx.search(c) and c not in ids]
    if not cols:  # a sheet without value columns has no cells
        return df.select(*ids, F.lit(None).cast("string").alias(name),
                         F.lit(None).cast("string").alias(value)).limit(0)
    long = df.unpivot(ids, cols, name, value)
    keep = F.col(value).isNotNull()
    for b in blanks:
        keep = keep & (F.col(value) != F.lit(b))
    return long.filter(keep)


def cross_tab(df: DataFrame, rows: list[str], col: str, values: list,
              agg: Column | None = None, names: list[str] | None = None,
              fill=None) -> DataFrame:
    """Pivot ``col`` into one column per listed value.

    The value list is explicit, so Spark needs no extra job to find it and
    the output schema is fixed.  ``agg`` defaults to a row count; absent
    cells are NULL (D19) unless ``fill`` is given.
    """
    agg = agg if agg is not None else F.count(F.lit(1))
    if not values:  # no listed values: one row per key, no value columns
        return df.select(*rows).distinct()
    out = df.groupBy(*rows).pivot(col, values).agg(agg)
    if names:
        out = out.withColumnsRenamed({str(v): n for v, n in zip(values, names)})
    if fill is not None:
        cols = names or [str(v) for v in values]
        out = out.fillna(fill, subset=cols)
    return out


def row_total(cols: list[str]) -> Column:
    """NULL-skipping sum across columns (pandas ``sum(axis=1)``)."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return total


def row_shares(df: DataFrame, cols: list[str], total: str = "sum") -> DataFrame:
    """Each listed column divided by the row total (NULL stays NULL)."""
    return df.withColumns({c: F.try_divide(F.col(c), F.col(total)) for c in cols})


def force_columns(df: DataFrame, keep: list[str], cols: list[str], dtype: str = "bigint") -> DataFrame:
    """Exactly ``keep + cols`` in that order; missing ones become NULL."""
    present = set(df.columns)
    return df.select(*keep, *[F.col(c) if c in present else F.lit(None).cast(dtype).alias(c)
                              for c in cols])


def level_frame(spark, name: str, levels: list) -> DataFrame:
    """An ordered level list as a small frame ``(name, name_order)``."""
    return spark.createDataFrame([(v, i) for i, v in enumerate(levels)],
                                 f"{name} string, {name}_order int")


def count_levels(df: DataFrame, col: str, levels: list, out: str = "n") -> DataFrame:
    """Counts per level of an ordered category, absent levels as 0.

    Counts are aggregated first; the level list (bounded by its definition)
    is then joined to the small aggregate and ordered by level position.
    Values outside the levels are not counted (pandas makes them NaN).
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(out))
    lv = bounded(level_frame(df.sparkSession, col, levels), len(levels))
    return (lv.join(counts, col, "left")
            .select(col, F.coalesce(F.col(out), F.lit(0)).alias(out), F.col(f"{col}_order"))
            .orderBy(f"{col}_order").drop(f"{col}_order"))


def order_by_levels(df: DataFrame, col: str, levels: list) -> DataFrame:
    """Sort by the position of ``col`` in ``levels`` (outside -> NULL, first)."""
    return df.orderBy(ordinal(col, levels))


def transpose_small(df: DataFrame, index: str) -> DataFrame:
    """Transpose of a small result (Spark 4 ``DataFrame.transpose``)."""
    return df.transpose(F.col(index))
