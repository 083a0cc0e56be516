"""Exact distributed quantiles agree with Spark's ``percentile``."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def _reference(df, by):
    agg = F.percentile("x", F.array(*[F.lit(p) for p in PROBS])).alias("q")
    return {tuple(r[:-1]): [round(v, 9) for v in r[-1]] for r in (df.groupBy(*by).agg(agg) if by else df.agg(agg)).collect()}


def _ours(df, by, buckets):
    res = exact_quantiles(df, "x", PROBS, by, buckets)
    return {tuple(r[:-1]): [round(v, 9) for v in r[-1]] for r in res.collect()}


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_matches_percentile_with_hot_group_and_ties(spark, buckets):
    rnd = random.Random(7)
    data = [("hot", float(rnd.randint(0, 50))) for _ in range(3000)]          # many ties
    data += [("cold", rnd.random() * 100) for _ in range(200)]
    data += [("one", 4.5), ("flat", 2.0), ("flat", 2.0), ("nulls", None)]
    df = spark.createDataFrame(data, "g string, x double")
    got, ref = _ours(df, ["g"], buckets), _reference(df.filter(F.col("x").isNotNull()), ["g"])
    assert got == ref


def test_whole_column(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 10]], "x double")
    assert _ours(df, [], 4) == {(): [1.0, 1.75, 2.5, 4.75, 10.0]}


def test_null_groups_infinities_and_large_groups(spark):
    rnd = random.Random(8)
    odd = [float("inf"), float("-inf"), float("nan")]
    data = [(None, 5.0), ("mid", 2.0)] + [("mid", rnd.gauss(0, 1)) for _ in range(2500)] + [("big", rnd.choice([rnd.gauss(0, 9), 1.0, *odd])) for _ in range(2500)]
    df = spark.createDataFrame(data + [("none", None)], "g string, x double").repartition(7)
    probs = [0.05, 0.3, 0.5, 0.9]
    got = {r.g: r.quantiles for r in exact_quantiles(df, "x", probs, ["g"], 4).collect()}
    ref = {r.g: r.q for r in df.dropna().groupBy("g").agg(F.percentile("x", F.array(*map(F.lit, probs))).alias("q")).collect()}
    assert set(got) == {"mid", "big"}  # NULL groups are left out
    for g in got:
        assert [repr(round(v, 9)) for v in got[g]] == [repr(round(v, 9)) for v in ref[g]]


def test_box_of_large_groups_reads_fences_exactly(spark):
    from tessera.operators.stats import box_stats
    rnd = random.Random(9)
    data = [(g, rnd.gauss(0, 1) ** 3) for g in "ab" for _ in range(40000)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: r for r in box_stats(df, "x", ["g"]).collect()}
    for g in "ab":
        x = sorted(v for k, v in data if k == g)
        at = lambda q: (lambda p: x[int(p)] + (p - int(p)) * (x[min(int(p) + 1, len(x) - 1)] - x[int(p)]))(q * (len(x) - 1))
        lo, hi = at(0.25) - 1.5 * (at(0.75) - at(0.25)), at(0.75) + 1.5 * (at(0.75) - at(0.25))
        r = got[g]
        assert (r.p25, r.p50, r.p75) == pytest.approx((at(0.25), at(0.5), at(0.75)))
        assert (r.whisker_low, r.whisker_high) == (min(v for v in x if v >= lo), max(v for v in x if v <= hi))
        assert (r.outliers, r.n) == (sum(v < lo or v > hi for v in x), len(x))


def test_few_exchanges_and_nothing_written(spark):
    """At most five shuffles for grouped box statistics, and values inside the intervals only are kept."""
    from tessera.operators.quantiles import compacted, intervals, values
    from tessera.operators.stats import box_stats
    df = spark.range(200000).selectExpr("id % 2 as g", "cast(hash(id) as double) as x")
    plan = box_stats(df, "x", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition") <= 5
    assert "Scan ExistingRDD" not in plan
    base = values(df, "x", ["g"])
    assert compacted(base, intervals(base, ["g"], [0.25, 0.5, 0.75]), ["g"]).count() < 0.02 * 200000
