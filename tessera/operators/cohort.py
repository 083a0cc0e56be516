"""Cohort retention (Q29-Q32).

One scan of the fact, months as bits.  A subject's months are one number (or
several, of 62 months each): ``bit_or`` of its months' bits, combined map-side
like a sum.  The first month is the lowest bit.

    fact --bit_or(month bit) by subject--> masks          (shuffle 1)
    masks --count by mask, months of the mask--> retained (shuffle 2; at most one
                                     row per mask and task)
    retained --diagonal (month = first month)--> new subjects (window on the
                                     tiny frame; no join back)
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from tessera.functions.dates import in_range, month_start
from tessera.operators.reshape import cross_tab


#: Months in one mask: bits of a long.
MONTHS = 62


@dataclass
class Cohort:
    first: DataFrame      # subject, first_month
    new: DataFrame        # first_month, new_subjects
    retained: DataFrame   # first_month, retention_month, retained_subjects
    long: DataFrame       # first_month, retention_month, new_subjects, retained_subjects, retention_rate


def cohort(df: DataFrame, subject: str, date: str, start: str, end: str,
           half_open: bool = False) -> Cohort:
    """Monthly acquisition cohorts of ``subject`` over ``[start, end]``.

    ``half_open=False`` keeps the BETWEEN bounds of the original (D6).
    """
    lo, hi = (dt.date.fromisoformat(str(d)[:10]) for d in (start, end))
    n_months = max(1, (hi.year - lo.year) * 12 + hi.month - lo.month + 1)
    origin = F.lit(dt.date(lo.year, lo.month, 1))
    month = ((F.year("__m") - lo.year) * 12 + F.month("__m") - lo.month).alias("__at")
    active = (df.filter(in_range(date, start, end, half_open))
              .select(F.col(subject).alias("subject"), month_start(date).alias("__m")).select("subject", month))
    words = [f"__w{i}" for i in range(-(-n_months // MONTHS))]
    masks = active.groupBy("subject").agg(*[
        F.coalesce(F.bit_or(F.when(F.floor(F.col("__at") / MONTHS) == i, F.expr(f"shiftleft(1L, cast(__at % {MONTHS} as int))"))), F.lit(0).cast("long"))
        .alias(w) for i, w in enumerate(words)])
    # the months of the masks, in order
    bits = [f"filter(sequence({i * MONTHS}, {min(n_months, (i + 1) * MONTHS) - 1}), m -> ({w} & shiftleft(1L, m % {MONTHS})) <> 0)"
            for i, w in enumerate(words)]
    held = F.expr(f"concat({', '.join(bits)})")
    day = lambda m: F.add_months(origin, m)
    first = masks.select("subject", day(F.get(held, F.lit(0))).alias("first_month"))
    retained = (masks.groupBy(*words).agg(F.count("subject").alias("__n"))
                .select("__n", held.alias("__held")).select("__n", F.get("__held", F.lit(0)).alias("__first"), F.explode("__held").alias("__at"))
                .groupBy(day(F.col("__first")).alias("first_month"), day(F.col("__at")).alias("retention_month"))
                .agg(F.sum("__n").alias("retained_subjects")))
    # a subject is active in its own first month, so the cohort size is the diagonal
    diagonal = F.when(F.col("retention_month") == F.col("first_month"), F.col("retained_subjects"))
    long = (retained
            .withColumn("new_subjects", F.max(diagonal).over(Window.partitionBy("first_month")))
            .withColumn("retention_rate",
                        F.try_divide(F.col("retained_subjects").cast("decimal(20,0)"),
                                     F.col("new_subjects")).cast("decimal(5,3)"))
            .select("first_month", "retention_month", "new_subjects", "retained_subjects", "retention_rate"))
    new = long.filter(F.col("retention_month") == F.col("first_month")).select("first_month", "new_subjects")
    return Cohort(first, new, retained, long)


def retention_matrix(c: Cohort, months: list[str], names: list[str]) -> DataFrame:
    """One row per first month, one column per calendar month (max rate)."""
    return cross_tab(c.long.withColumn("retention_month", F.col("retention_month").cast("string")),
                     ["first_month"], "retention_month", months,
                     agg=F.max("retention_rate"), names=names)
