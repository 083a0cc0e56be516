"""Exploratory statistics.

All statistics are aggregates with map-side combine.  Whole-frame values
(min, max, quartiles) are scalar subqueries planned once.  Exact quartiles come
from ``tessera.operators.quantiles`` (no group is ever gathered into one task);
``exact=False`` switches to ``percentile_approx`` (a mergeable sketch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.operators.joins import bounded
from tessera.operators.quantiles import at_ranks, compacted, exact_quantiles, intervals, values

QUARTILES = [0.25, 0.5, 0.75]


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for every column, one pass."""
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_count")


def schema_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, non_null_count), one pass."""
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column_name", "non_null_count")
    types = F.create_map(*[x for f in df.schema.fields
                           for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    return long.select("column_name", types[F.col("column_name")].alias("data_type"), "non_null_count")


def describe(df: DataFrame, col: str, by: list[str] | None = None, exact: bool = True,
             accuracy: int = 10000, buckets: int = 128) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear), max.

    Moments are one aggregate.  Exact quartiles come from
    ``exact_quantiles`` (value ranges split across tasks, so a very large
    group is never sorted by one task); ``exact=False`` uses the
    ``percentile_approx`` sketch instead.
    """
    by = by or []
    v = F.col(col)
    moments = df.groupBy(*by).agg(F.count(v).alias("count"), F.avg(v).alias("mean"),
                                  F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
                                  F.max(v).alias("max"))
    if exact:
        q = exact_quantiles(df, col, QUARTILES, by, buckets, out="__q")
    else:
        q = df.groupBy(*by).agg(F.percentile_approx(v, QUARTILES, accuracy).alias("__q"))
    if by:
        out = moments.join(q, by, "left")
    else:
        out = moments.withColumn("__q", q.select("__q").scalar())
    return out.select(*by, "count", "mean", "std", "min",
                      F.col("__q")[0].alias("p25"), F.col("__q")[1].alias("p50"),
                      F.col("__q")[2].alias("p75"), "max")


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for every ordered pair, pairwise-complete rows.

    ``r = covar_samp / (std_x * std_y)`` over the rows where both are present;
    a constant column gives NULL instead of a division error, also with
    itself.  One pass.
    """
    exprs, pairs = [F.stddev_samp(c).alias(f"{c}|") for c in cols], []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
            r = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
            exprs.append(r.alias(f"{a}|{b}"))
            pairs.append((a, b))
    row = df.agg(*exprs)
    parts = []
    for a, b in pairs:
        val = F.col(f"`{a}|{b}`")
        parts.append(F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"), val.alias("r")))
        parts.append(F.struct(F.lit(b).alias("var_x"), F.lit(a).alias("var_y"), val.alias("r")))
    for a in cols:
        has = F.when(F.col(f"`{a}|`") > 0, F.lit(1.0))  # a variable with itself
        parts.append(F.struct(F.lit(a).alias("var_x"), F.lit(a).alias("var_y"), has.alias("r")))
    return row.select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """``bins`` equal-width bins over [min, max], last bin closed.

    Every bin is listed, empty ones with 0 (a generated frame of ``bins``
    rows).  If min = max every value falls in the first bin.  The range is
    one scalar subquery, attached once and read through its fields.
    """
    v = F.col(col).cast("double")
    rng = df.select(F.struct(F.min(v).alias("mn"), F.max(v).alias("mx"))).scalar()
    mn, mx = F.col("__r.mn"), F.col("__r.mx")
    idx = F.when(mx == mn, F.lit(1)).otherwise(
        F.least(F.floor((v - mn) / (mx - mn) * bins) + 1, F.lit(bins))).cast("int")
    counts = (df.filter(v.isNotNull()).withColumn("__r", rng)
              .groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (mx - mn) / bins
    return (bounded(frame, known_rows=bins).join(counts, "bin", "left").withColumn("__r", rng)
            .select("bin", (mn + width * (F.col("bin") - 1)).alias("lower"),
                    (mn + width * F.col("bin")).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count"))
            .orderBy("bin"))


def box_stats(df: DataFrame, col: str, by: list[str] | None = None, whis: float = 1.5,
              exact: bool = True) -> DataFrame:
    """Quartiles, whiskers at ``whis`` x IQR clipped to the data, outliers.

    Everything is read from the compacted rows of ``quantiles``: the bounds of
    the quartiles bound the fences too, so values near a fence are kept one by
    one, and all others count by gap.  ``exact=False`` takes the quartiles from
    the ``percentile_approx`` sketch instead.
    """
    by = list(by or [])
    base = values(df, col, by)
    rows = compacted(base, intervals(base, by, QUARTILES, fences=(0, 2, whis)), by)
    group = Window.partitionBy(*by)
    found, quartiles = at_ranks(QUARTILES)
    rows = rows.withColumn("__total", F.sum("__n").over(group))
    if exact:
        rows = rows.select("*", *[c.over(group).alias(n) for n, c in found.items()])
    else:
        approx = base.groupBy(*by).agg(F.percentile_approx("__v", QUARTILES, 10000).alias("__approx"))
        rows = rows.join(approx, by) if by else rows.withColumn("__approx", approx.scalar())
        quartiles = [F.col("__approx")[i] for i in range(3)]
    fences = rows.select(*by, "__n", "__min", "__max", *[q.alias(n) for q, n in zip(quartiles, ("p25", "p50", "p75"))]).selectExpr(
        "*", f"p25 - {whis}D * (p75 - p25) as lo_fence", f"p75 + {whis}D * (p75 - p25) as hi_fence")
    return (fences.groupBy(*by, "p25", "p50", "p75", "lo_fence", "hi_fence")
            .agg(F.expr("min(if(__min >= lo_fence, __min, null))").alias("whisker_low"),
                 F.expr("max(if(__max <= hi_fence, __max, null))").alias("whisker_high"),
                 F.expr("coalesce(sum(if(__max < lo_fence or __min > hi_fence, __n, null)), 0)").alias("outliers"),
                 F.sum("__n").alias("n")))
