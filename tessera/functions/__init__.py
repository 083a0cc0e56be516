"""Scalar column helpers (F-series).  All are built-in Spark expressions."""

from tessera.functions.dates import (
    DAY_NAMES, MONTH_NAMES, any_range, date_dim, date_dim_rows, day_name, fiscal_month_range,
    fiscal_year, fiscal_year_range, in_range, month_name, month_start,
)
from tessera.functions.numeric import dummy_measure, money, pct, safe_ratio
from tessera.functions.recode import bucket, ordinal, recode
from tessera.functions.text import collated, concat_nullsafe, first_item, sprint_key

__all__ = [
    "DAY_NAMES", "MONTH_NAMES", "any_range", "date_dim", "date_dim_rows", "day_name",
    "fiscal_month_range", "fiscal_year", "fiscal_year_range", "in_range", "month_name", "month_start",
    "dummy_measure", "money", "pct", "safe_ratio", "bucket", "ordinal", "recode",
    "collated", "concat_nullsafe", "first_item", "sprint_key",
]
