"""Date helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Full English month and day names, in calendar order.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """first day of the month as DATE (``trunc`` keeps DATE, D31)."""
    return F.trunc(F.to_date(_c(c)), "MM")


def month_name(c) -> Column:
    """Full month name (``monthname`` would give 'Sep')."""
    return F.date_format(_c(c), "MMMM")


def day_name(c) -> Column:
    """Full day name."""
    return F.date_format(_c(c), "EEEE")


def fiscal_year(c, start_month: int = 7) -> Column:
    """Fiscal year that starts in ``start_month`` and is named by its end year."""
    c = _c(c)
    if start_month == 1:
        return F.year(c)
    return F.year(c) + F.when(F.month(c) >= start_month, 1).otherwise(0)


def in_range(c, start: str, end: str, half_open: bool = False) -> Column:
    """``start <= c <= end`` (BETWEEN, D6) or ``start <= c < end``.

    Literals are typed as the column's timestamp/date by Catalyst, so the
    predicate reaches the Parquet scan (D7: filter the raw column).
    """
    c = _c(c)
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end).cast("timestamp_ntz")
    return (c >= lo) & ((c < hi) if half_open else (c <= hi))


def date_dim_rows(start: str, end: str) -> int:
    """Row count of ``date_dim(start, end)``, known without reading data."""
    return (_dt.date.fromisoformat(end) - _dt.date.fromisoformat(start)).days + 1


def date_dim(spark: SparkSession, start: str, end: str,
             fiscal_start_month: int = 7) -> DataFrame:
    """C4: a generated calendar, one row per day in ``[start, end]``.

    Its size is the number of days in the range (2,557 for seven years), a
    bound known before any data is read, so joins may broadcast it.
    """
    _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)  # validate
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"),
                             F.expr("interval 1 day"))).alias("date"))
    d = F.col("date")
    return days.select(
        d,
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"),
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("month_number_of_year"),
        month_name(d).alias("month_name"),
        day_name(d).alias("day_name"),
        fiscal_year(d, fiscal_start_month).alias("fiscal_year"),
    )


def fiscal_month_range(fiscal_year_: int, month: int, start_month: int = 7) -> tuple[str, str]:
    """Half-open ``[start, end)`` dates of one month of a fiscal year."""
    year = fiscal_year_ - 1 if (start_month > 1 and month >= start_month) else fiscal_year_
    nxt_y, nxt_m = (year + 1, 1) if month == 12 else (year, month + 1)
    return f"{year}-{month:02d}-01", f"{nxt_y}-{nxt_m:02d}-01"


def fiscal_year_range(fiscal_year_: int, start_month: int = 7) -> tuple[str, str]:
    """Half-open ``[start, end)`` dates of a whole fiscal year."""
    if start_month == 1:
        return f"{fiscal_year_}-01-01", f"{fiscal_year_ + 1}-01-01"
    return (f"{fiscal_year_ - 1}-{start_month:02d}-01", f"{fiscal_year_}-{start_month:02d}-01")


def any_range(c, ranges: list[tuple[str, str]]) -> Column:
    """OR of half-open ranges on a raw column, so the scan can prune row groups."""
    out = None
    for lo, hi in ranges:
        cond = in_range(c, lo, hi, half_open=True)
        out = cond if out is None else out | cond
    return out
