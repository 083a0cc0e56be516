"""Cohort retention of customers by month of first order (Q29-Q32).

Fixture roles: subject = ``o_custkey``, date = ``o_orderdate``, year 1997.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.dates import MONTH_NAMES
from tessera.operators.cohort import cohort, retention_matrix
from tessera.sources.tables import Warehouse

YEAR = 1997
START, END = f"{YEAR}-01-01", f"{YEAR}-12-31"
MONTH_COLS = [m[:3].lower() for m in MONTH_NAMES]
MONTH_KEYS = [f"{YEAR}-{m:02d}-01" for m in range(1, 13)]


def _cohort(spark: SparkSession, base: str):
    orders = Warehouse(spark, base).orders
    return cohort(orders, "o_custkey", "o_orderdate", START, END)


def cohort_first_month(spark, base) -> DataFrame:
    c = _cohort(spark, base)
    return c.first.select(F.col("subject").alias("customer_key"), "first_month")


def cohort_new(spark, base) -> DataFrame:
    return _cohort(spark, base).new.orderBy("first_month")


def cohort_retained(spark, base) -> DataFrame:
    return _cohort(spark, base).retained


def cohort_long(spark, base) -> DataFrame:
    return _cohort(spark, base).long


def cohort_retention_matrix(spark, base) -> DataFrame:
    return retention_matrix(_cohort(spark, base), MONTH_KEYS, MONTH_COLS).orderBy("first_month")


QUERIES = {
    "cohort_first_month": cohort_first_month,
    "cohort_new": cohort_new,
    "cohort_retained": cohort_retained,
    "cohort_long": cohort_long,
    "cohort_retention_matrix": cohort_retention_matrix,
}

# One pass over distinct (customer, month) pairs; a cohort's size is its count
# in its own first month.
_GRID = f"""
pairs AS (
  SELECT who, m, MIN(m) OVER (PARTITION BY who) AS m0
  FROM (SELECT DISTINCT o_custkey AS who, date_trunc('month', o_orderdate)::DATE AS m FROM orders
        WHERE o_orderdate >= DATE '{START}' AND o_orderdate <= DATE '{END}')
),
grid AS (
  SELECT m0, m, COUNT(*) AS kept, FIRST(COUNT(*)) OVER (PARTITION BY m0 ORDER BY m) AS joined FROM pairs GROUP BY m0, m
)"""
_RATE = "CAST(kept * 1.0 / joined AS DECIMAL(5,3))"

_MATRIX_COLS = ", ".join(f"ANY_VALUE({_RATE}) FILTER (WHERE m = DATE '{k}') AS {n}" for k, n in zip(MONTH_KEYS, MONTH_COLS))

ORACLE = {
    "cohort_first_month": f"WITH {_GRID} SELECT who AS customer_key, ANY_VALUE(m0) AS first_month FROM pairs GROUP BY who",
    "cohort_new": f"WITH {_GRID} SELECT m0 AS first_month, kept AS new_subjects FROM grid WHERE m = m0",
    "cohort_retained": f"WITH {_GRID} SELECT m0 AS first_month, m AS retention_month, kept AS retained_subjects FROM grid",
    "cohort_long": f"""WITH {_GRID}
SELECT m0 AS first_month, m AS retention_month, joined AS new_subjects, kept AS retained_subjects, {_RATE} AS retention_rate FROM grid""",
    "cohort_retention_matrix": f"WITH {_GRID} SELECT m0 AS first_month, {_MATRIX_COLS} FROM grid GROUP BY m0",
}
