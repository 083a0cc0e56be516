"""Exact quantiles without gathering a group into one task.

``percentile`` keeps every distinct value of a group in one aggregation
buffer, so a group holding a third of the data would be sorted by a single
task.  Here a sketch bounds where each wanted rank can be, and only values
within these bounds are kept one by one:

1. one aggregate per group gives the row count and, from a mergeable quantile
   sketch, the values at the wanted probability plus and minus ``MARGIN`` times
   the sketch's rank error: an interval that holds the wanted ranks
   (``intervals``; a group of few rows has one interval, all values);
2. rows are counted by (group, value) inside the intervals, and by group and
   gap outside them, with the gap's least and greatest value (``compacted``);
   both are combined map-side, so a gap is one row per task;
3. running counts over these few rows, in order of value, give the exact value
   at every wanted rank, with linear interpolation between two ranks (the
   ``percentile`` / pandas rule).  A rank that fell outside its interval would
   be seen here and raises.

Interval bounds reach the rows by group *and* a salt taken from the value, so a
hot group is spread over ``SALTS`` keys.  Nothing is written in between; the
rows are read twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

SALTS = 64
#: Accuracy of the sketch per bucket asked for, and how many times its rank error an interval takes in.
ACCURACY, MARGIN = 32, 4
#: Open ends of an interval: NaN is the greatest double in Spark.
LEAST, GREATEST = "double('-Infinity')", "double('NaN')"


def values(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """``by`` columns and ``__v`` (the value as double), NULL values and NULL groups left out."""
    return df.select(*by, F.col(col).cast("double").alias("__v")).dropna(subset=[*by, "__v"])


def intervals(base: DataFrame, by: list[str], probs: list[float], buckets: int = 128, fences: tuple[int, int, float] | None = None,
              more: list[Column] | None = None) -> DataFrame:
    """Per group ``__n`` and bounds ``__lo<i>`` / ``__hi<i>`` of the values at ``probs``
    (closed intervals), and the aggregates ``more``.

    ``fences`` (a, b, w) adds two intervals, for the values at ``probs[a]`` less,
    and ``probs[b]`` plus, w times the distance of these two.
    """
    accuracy = ACCURACY * buckets
    eps = MARGIN / accuracy
    cuts = [c for q in probs for c in (max(0.0, q - eps), min(1.0, q + eps))]
    got = base.groupBy(*by).agg(F.count("__v").alias("__n"), F.percentile_approx("__v", cuts, accuracy).alias("__c"), *(more or []))
    few = f"__n <= {accuracy}"  # all values are kept; beyond that the margin is several ranks
    named = {}
    for i, q in enumerate(probs):
        named[f"__lo{i}"] = f"if({few} or {q <= eps}, {LEAST}, __c[{2 * i}])"
        named[f"__hi{i}"] = f"if({few} or {q + eps >= 1}, {GREATEST}, __c[{2 * i + 1}])"
    got = got.selectExpr(*[f"`{c}`" for c in got.columns if c != "__c"], *[f"{e} as {n}" for n, e in named.items()])
    if fences:
        a, b, w, k = *fences, len(probs)
        most, least = f"{w}D * (__hi{b} - __lo{a})", f"{w}D * (__lo{b} - __hi{a})"  # of the distance
        slack = f"1e-9D * (abs(__lo{a}) + abs(__hi{b}) + abs({most}))"
        lows = f"__lo{a} - {most} - {slack}", f"__lo{b} + {least} - {slack}"
        highs = f"__hi{a} - {least} + {slack}", f"__hi{b} + {most} + {slack}"
        got = got.selectExpr("*", *[f"if({few} or isnan({e}), {LEAST}, {e}) as __lo{k + i}" for i, e in enumerate(lows)],
                             *[f"if({few}, {GREATEST}, {e}) as __hi{k + i}" for i, e in enumerate(highs)])
    return got


def compacted(base: DataFrame, bounds: DataFrame, by: list[str]) -> DataFrame:
    """``by`` columns, ``__v`` (a value inside an interval, or NULL: a gap), ``__n`` (rows),
    ``__min``, ``__max``, ``__upto`` (rows of the group up to here, in order of value)."""
    edges = [c for c in bounds.columns if c.startswith(("__lo", "__hi"))]
    if by:
        salt = F.pmod(F.xxhash64("__v"), F.lit(SALTS)).cast("int")
        other = bounds.select(*by, *edges, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
        rows = base.withColumn("__salt", salt).join(other, [*by, "__salt"])
    else:
        rows = base.withColumn("__x", bounds.select(F.struct(*edges).alias("__x")).scalar()).select("__v", "__x.*")
    n = range(len(edges) // 2)
    inside = " or ".join(f"(__v >= __lo{i} and __v <= __hi{i})" for i in n)
    # how many intervals end below: two values outside them with one number have none between
    gap = " + ".join(f"int(__v > __hi{i})" for i in n)
    few = (rows.selectExpr(*[f"`{c}`" for c in by], "__v", f"{gap} as __gap", f"if({inside}, __v, null) as __kept").groupBy(*by, "__gap", "__kept")
           .agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__min"), F.max("__v").alias("__max")))
    run = Window.partitionBy(*by).orderBy("__min").rowsBetween(Window.unboundedPreceding, 0)
    return few.select(*by, F.col("__kept").alias("__v"), "__n", "__min", "__max", F.sum("__n").over(run).alias("__upto"))


def at_ranks(probs: list[float]) -> tuple[dict[str, Column], list[Column]]:
    """(named aggregates of compacted rows with ``__total``, the group's rows; the value
    at every probability from these): the values at both ranks around it, interpolated."""
    found, out = {}, []
    for i, q in enumerate(probs):
        p = f"({float(q)!r}D * (__total - 1))"
        for end, name in (("floor", "below"), ("ceil", "above")):
            r = f"{end}{p}"
            found[f"__{name}{i}"] = F.expr(f"max(if(__upto - __n <= {r} and __upto > {r}, "
                                           "coalesce(__v, double(raise_error('a rank lies outside its interval'))), null))")
        out.append(F.expr(f"if(floor{p} = ceil{p}, __below{i}, (ceil{p} - {p}) * __below{i} + ({p} - floor{p}) * __above{i})"))
    return found, out


def exact_quantiles(df: DataFrame, col: str, probs: list[float], by: list[str] | None = None,
                    buckets: int = 128, out: str = "quantiles") -> DataFrame:
    """``by`` columns + ``out`` (array of doubles, one per ``probs``).

    Groups with no non-NULL value are absent from the result.  More ``buckets``:
    a finer sketch, and fewer values kept.
    """
    by = list(by or [])
    base = values(df, col, by)
    return quantiles_of(base, intervals(base, by, probs, buckets), probs, by, out)


def quantiles_of(base: DataFrame, bounds: DataFrame, probs: list[float], by: list[str], out: str = "quantiles") -> DataFrame:
    found, quantiles = at_ranks(probs)
    rows = compacted(base, bounds, by).withColumn("__total", F.sum("__n").over(Window.partitionBy(*by)))
    return rows.groupBy(*by, "__total").agg(*[c.alias(n) for n, c in found.items()]).select(*by, F.array(*quantiles).alias(out))
