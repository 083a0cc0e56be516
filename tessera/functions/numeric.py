"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Amounts as DECIMAL so sums do not depend on summation order."""
    return _c(c).cast(MONEY)


def safe_ratio(num, den) -> Column:
    """Ratio that is NULL (not an error under ANSI) when ``den`` is 0."""
    return F.try_divide(_c(num), _c(den))


def pct(num, den, scale: int = 2, precision: int = 5) -> Column:
    """M1/M3: ``num / den * 100`` as DECIMAL(precision, scale).

    ``precision`` defaults to 5 so that 100.00 fits (R6).
    """
    return (F.try_divide(_c(num).cast("decimal(38,10)"), _c(den)) * 100).cast(
        f"decimal({precision},{scale})")


def dummy_measure(key, lo: int = 20, hi: int = 100) -> Column:
    """A stable integer in ``[lo, hi]`` derived from an integer key.

    ``rand()`` changes with partitioning; arithmetic on the key does not.
    The key is folded below 1,000,003 first so the product cannot overflow.
    """
    span = hi - lo + 1
    folded = F.pmod(_c(key), F.lit(1000003)) * 7919
    return (F.pmod(folded, F.lit(span)) + lo).cast("int")
