"""Skewed keys, uniqueness, prefilters, distinct counts by bits, cohorts by bits, versioned tables, samples."""

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tessera.operators.aggregates import bitmap_distinct, distinct_by_flags, key_bitmaps
from tessera.operators.cohort import cohort
from tessera.operators.joins import Link, enrich, hot_keys, semi, unique_by
from tessera.operators.windows import sample_per_group
from tessera.sources import files

from conftest import SMALL, rows


def _same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def no_broadcast(spark):
    """Every join by shuffle unless hinted, and no coalescing that would hide an uneven task."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# C1-C3, C6, C10 ---------------------------------------------------------------
def test_hot_key_is_spread_and_rows_stay_equal(spark, no_broadcast):
    """Half of the fact on one key, a tenth without a key: no task has over twice the median."""
    fact = spark.range(40000, numPartitions=8).selectExpr("if(id % 2 = 0, 7L, if(id % 10 = 1, null, id % 5000)) as k", "id")
    dim = spark.range(4000).selectExpr("id as k", "concat('n', id) as name")

    def sizes(skewed):
        out = enrich(fact, [Link(dim, "k", "k", ["name"], skewed=skewed)])
        return sorted(r[1] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()), out

    (plain, a), (even, b) = sizes(False), sizes(True)
    assert _same(a, b) and b.count() == 40000
    # the two branches have tasks of their own: scans (hot keys) and shuffle partitions (the others)
    assert plain[-1] > 10 * statistics.median(plain)
    hot, cold = [n for n in even if n > 2000], [n for n in even if n <= 2000]
    assert max(hot) <= 2 * statistics.median(hot) and max(cold) <= 2 * statistics.median(cold)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plan


def test_skewed_inner_join_and_wrong_use(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "k long, v string")
    dim = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k long, n string")
    for how in ("left", "inner"):
        assert _same(enrich(fact, [Link(dim, "k", "k", ["n"], how, skewed=True)]), enrich(fact, [Link(dim, "k", "k", ["n"], how)]))
    empty = fact.limit(0)
    assert enrich(empty, [Link(dim, "k", "k", ["n"], skewed=True)]).count() == 0
    with pytest.raises(ValueError):
        enrich(fact, [Link(dim, "k", "k", ["n"], "full", skewed=True)])


def test_skewed_keys_of_two_columns(spark, no_broadcast):
    fact = spark.range(6000).selectExpr("if(id % 2 = 0, 1, cast(id % 40 as int)) as a", "if(id % 6 < 4, 'x', if(id % 6 = 4, null, 'y')) as b", "id")
    dim = spark.range(80).selectExpr("id div 2 as a", "if(id % 2 = 0, 'x', 'y') as b", "id as n")  # the number is a long here
    for how in ("left", "inner"):
        got, want = (enrich(fact, [Link(dim, ["a", "b"], ["a", "b"], ["n"], how, skewed=s)]) for s in (True, False))
        assert _same(got, want)


def test_hot_keys_come_from_a_sketch(spark):
    df = spark.range(100000).selectExpr("if(id % 4 = 0, -1L, id) as k")
    assert df.select(hot_keys(df, "k").alias("h")).first().h == [-1]


# C13 ----------------------------------------------------------------------------
def test_a_repeated_key_fails_the_job(spark):
    dim = spark.createDataFrame([(1, "a", 5), (2, "b", None), (None, "c", 1), (None, "d", 1)], "k int, v string, w int")
    assert sorted(rows(unique_by(dim, ["k"])), key=str) == sorted(rows(dim), key=str)
    again = dim.union(dim.where("k = 2"))
    fact = spark.createDataFrame([(1,), (2,)], "k int")
    for broken in (unique_by(again, ["k"]), enrich(fact, [Link(again, "k", "k", ["v"], unique=True)]), unique_by(again.select("k"), ["k"])):
        with pytest.raises(Exception, match="repeated key: .*=2"):
            broken.collect()
    assert unique_by(again, ["k", "v", "w"]).count() == 5  # a key with a NULL part joins nothing
    # one shuffle, that of the join itself
    plan = unique_by(dim, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_current_status_is_checked_for_repeated_packages(spark, monkeypatch):
    from tessera.plans import status
    real = status._current
    assert status.status_flags(spark, SMALL).count() > 0
    monkeypatch.setattr(status, "_current", lambda joined: real(joined).union(real(joined)))
    with pytest.raises(Exception, match="repeated key: package_name="):
        status.status_flags(spark, SMALL).collect()


# B11, C9 --------------------------------------------------------------------------
def test_prefilter_reaches_the_fact_scan(spark, no_broadcast):
    from tessera.plans import sales
    plan = sales.order_totals_and_overall(spark, SMALL)._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("- Filter" in x and "xxhash64(l_partkey" in x and "ubquery" in x for x in plan)
    # the scan itself has the filter: nothing lies between
    scans = [x for x in plan if "FileScan" in x and "lineitem.parquet" in x and "l_partkey" in x]
    assert scans and all("ubquery" in x.split("DataFilters: [")[1].split("Format:")[0] for x in scans)


def test_prefilter_keeps_the_rows_of_a_semi_join(spark):
    df = spark.range(5000).selectExpr("cast(id as int) as k", "id")
    keys = spark.range(0, 5000, 37).selectExpr("id as k").union(spark.sql("select cast(null as long)"))
    assert _same(semi(df, keys, "k", prefilter=True), semi(df, keys, "k"))
    assert semi(df, keys.limit(0), "k", prefilter=True).count() == 0
    with pytest.raises(ValueError):
        semi(df, keys, "k", anti=True, prefilter=True)


# G4, G29, G30 -----------------------------------------------------------------------
def test_distinct_counts_without_expand(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.choice([None, *range(-40000, 90000, 999)]), rng.random() < 0.3) for _ in range(3000)] + [("c", None, True)]
    df = spark.createDataFrame(data, "g string, k long, f boolean")
    got = {r.g: (r["distinct"], r.hit) for r in distinct_by_flags(df, "k", {"hit": F.col("f")}, ["g"]).collect()}
    want = {g: (len({k for x, k, _ in data if x == g and k is not None}), len({k for x, k, f in data if x == g and f and k is not None})) for g in "ab"}
    assert got == want
    bits = key_bitmaps(df, "k", ["g", "f"])
    assert {r.g: r.n for r in bitmap_distinct(bits, ["g"]).collect()} == {g: n for g, (n, _) in want.items()}
    assert bitmap_distinct(bits, []).first()[0] == len({k for _, k, _ in data if k is not None})
    from tessera.plans import sales, status
    for q in (status.hit_target_rate, sales.active_customers_by_period, sales.active_customers_in_month):
        # an Expand for distinct counts numbers its groups (unpivoted sheets expand too)
        assert "gid#" not in q(spark, SMALL)._jdf.queryExecution().executedPlan().toString()


# Q29-Q32 ---------------------------------------------------------------------------
@pytest.mark.parametrize("start,end", [("2020-11-15", "2021-02-03"), ("2012-01-01", "2023-12-31")])
def test_cohorts_by_bits_equal_the_pairs(spark, start, end):
    """Over one mask and over several (144 months)."""
    rng = random.Random(4)
    data = [(rng.choice([None, *range(30)]), f"{rng.randint(2011, 2024)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}") for _ in range(1500)]
    df = spark.createDataFrame(data, "who int, day string").selectExpr("who", "cast(day as date) as day")
    c = cohort(df, "who", "day", start, end)
    months = {}
    for who, d in data:
        if start <= d <= end:
            months.setdefault(who, set()).add(d[:7])
    first = {who: min(m) for who, m in months.items()}
    kept = {}
    for who, m in months.items():
        for x in m:
            kept[first[who], x] = kept.get((first[who], x), 0) + (who is not None)
    assert {(r.subject, str(r.first_month)[:7]) for r in c.first.collect()} == set(first.items())
    assert {(str(r[0])[:7], str(r[1])[:7]): r[2] for r in c.retained.collect()} == kept
    assert {str(r.first_month)[:7]: r.new_subjects for r in c.new.collect()} == {m: kept[m, m] for m in set(first.values())}


def test_cohort_plan_has_one_exchange_less(spark):
    from tessera.plans import cohorts
    plan = cohorts.cohort_long(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    # by subject, by mask, by month, by first month: the last three on a few rows
    assert "distinct" not in plan and plan.count("Exchange hashpartitioning(subject") == 1 and "bit_or" in plan


# A6 ---------------------------------------------------------------------------------
def test_replace_publishes_whole_versions_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    files.replace_table(spark.range(3), path)
    old = files.load_table(spark, path)
    broken = spark.range(1000).selectExpr("if(id = 700, raise_error('killed'), id) as id")
    with pytest.raises(Exception, match="killed"):
        files.replace_table(broken, path)
    assert files.load_table(spark, path).count() == 3
    with monkeypatch.context() as m:  # stopped after the write, before it is published
        m.setattr(files, "_publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            files.replace_table(spark.range(9), path)
    assert files.load_table(spark, path).count() == 3
    files.replace_table(spark.range(5), path)
    assert files.load_table(spark, path).count() == 5 and old.count() == 3  # a reader that had begun goes on
    files.replace_table(spark.range(6), path)
    assert files.load_table(spark, path).count() == 6
    left = sorted(p.name for p in (tmp_path / "table").iterdir() if not p.name.endswith(".crc"))
    assert len(left) == 3 and left[0] == files.POINTER  # the pointer, this version and the one before


def test_files_without_a_pointer_are_read_as_they_are(spark, tmp_path):
    files.save_table(spark.range(4), str(tmp_path / "t"))
    assert files.load_table(spark, str(tmp_path / "t")).count() == 4


# Q72 --------------------------------------------------------------------------------
def test_samples_are_exact_and_the_same_in_any_partitioning(spark):
    df = spark.range(5000).selectExpr("case when id % 50 = 0 then 'rare' when id < 4 then null else 'often' end as g", "id", "id * 2 as x")
    one = rows(sample_per_group(df.repartition(1), ["g"], 120, ["id"]))
    assert one == rows(sample_per_group(df.repartition(13, "x"), ["g"], 120, ["id"]))
    assert {g: sum(r[0] == g for r in one) for g in ("rare", "often", None)} == {"rare": 100, "often": 120, None: 3}
    assert one != rows(sample_per_group(df, ["g"], 120, ["id"], seed=1))
    plan = sample_per_group(df, ["g"], 120, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
