"""Operators on tiny frames: joins, windows, reshaping, cleaning, statistics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators.aggregates import attach_total, distinct_list, hit_rate, share_of_total, top_k
from tessera.operators.clean import dedupe, drop_incomplete, fill_mode, mode_value, null_sentinels
from tessera.operators.cohort import cohort
from tessera.operators.joins import Link, assert_unique, enrich, parent_lookup, semi
from tessera.operators.names import drop_by_regex, drop_listed, rename_by_rule, repair_names
from tessera.operators.reshape import count_levels, cross_tab, force_columns, row_shares, row_total, unpivot_named
from tessera.operators.stats import box_stats, correlations, describe, histogram, null_profile, schema_profile
from tessera.operators.windows import best_per_group, latest_revision, latest_slice, previous_value
from conftest import rows


def test_enrich_chain_keeps_unmatched_and_row_count(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "k int, p int")
    prod = spark.createDataFrame([(10, 100)], "p int, sub int")
    sub = spark.createDataFrame([(100, "Bikes")], "sub int, name string")
    out = enrich(fact, [Link(prod, "p", "p", ["sub"]), Link(sub, "sub", "sub", ["name"])])
    assert out.count() == 3
    assert rows(out.select("k", "name")) == [(1, "Bikes"), (2, None), (3, None)]


def test_semi_and_parent_lookup_C7_C9(spark):
    people = spark.createDataFrame([(1, None, "Boss"), (2, 1, "Ann"), (3, 1, "Bob")], "k int, parent int, name string")
    got = parent_lookup(spark.createDataFrame([(2,), (1,)], "k int"), people, "k", "parent", ["name"], "m_")
    assert rows(got) == [(1, "Boss", None), (2, "Ann", "Boss")]
    keys = spark.createDataFrame([(3,)], "k int")
    assert rows(semi(people, keys, "k").select("k")) == [(3,)]
    assert assert_unique(people, ["parent"]).count() == 1


def test_best_per_group_keeps_ties_D10(spark):
    df = spark.createDataFrame([("a", "x", 5.0), ("a", "y", 5.0), ("a", "z", 1.0), ("b", "w", 2.0)], "g string, s string, m double")
    assert rows(best_per_group(df, ["g"], "m").select("s")) == [("w",), ("x",), ("y",)]


def test_latest_revision_keeps_same_date_ties_D12(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (1, 2, 21), (2, 1, 5)], "k int, d int, v int")
    assert rows(latest_revision(df, ["k"], "d")) == [(1, 2, 20), (1, 2, 21), (2, 1, 5)]


def test_latest_slice_has_no_global_window_W5(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "k int, d int")
    out = latest_slice(df, "d")
    assert rows(out) == [(2, 2), (3, 2)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_previous_value_W6(spark):
    df = spark.createDataFrame([("p", 1, "a"), ("p", 2, "b"), ("q", 1, "c")], "k string, o int, s string")
    assert rows(previous_value(df, ["k"], ["o"], "s", "prev")) == [("p", 1, "a", None), ("p", 2, "b", "a"), ("q", 1, "c", None)]


def test_totals_and_shares_W2_W3_M1(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n bigint")
    assert rows(attach_total(df, "n", "t")) == [("a", 1, 4), ("b", 3, 4)]
    got = {r.k: float(r.p) for r in share_of_total(df, "n", "p").collect()}
    assert got == {"a": 25.0, "b": 75.0}


def test_top_k_with_tiebreak_D11(spark):
    df = spark.createDataFrame([(k, 1) for k in "dcba"], "k string, v int")
    assert [r.k for r in top_k(df, [F.desc("v"), F.asc("k")], 2).collect()] == ["a", "b"]


def test_dax_measures_G28_G30(spark):
    df = spark.createDataFrame([("p1", True), ("p1", False), ("p2", False), ("p3", None)], "p string, f boolean")
    r = df.agg(distinct_list("p").alias("l"), hit_rate("p", F.col("f")).alias("h")).first()
    assert r.l == "p1, p2, p3" and abs(r.h - 1 / 3) < 1e-12
    empty = df.filter(F.lit(False)).agg(hit_rate("p", F.col("f")).alias("h")).first()
    assert empty.h == 0.0


def test_unpivot_drops_null_and_placeholder_D13(spark):
    df = spark.createDataFrame([(1, "To Do", None, "-")], "id int, W_1 string, W_2 string, W_3 string")
    assert rows(unpivot_named(df, ["id"], r"^W_\d$", "s", "v")) == [(1, "W_1", "To Do")]


def test_pivot_roundtrip_property(spark):
    long = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "z")], "id int, k string, v string")
    wide = cross_tab(long, ["id"], "k", ["a", "b"], agg=F.first("v"))
    back = unpivot_named(wide, ["id"], "^[ab]$", "k", "v")
    assert rows(back) == rows(long)


def test_row_total_and_shares_D19_G33(spark):
    df = spark.createDataFrame([("x", 3, None), ("y", 1, 1)], "c string, a bigint, b bigint")
    t = df.withColumn("sum", row_total(["a", "b"]))
    assert rows(t.select("c", "sum")) == [("x", 3), ("y", 2)]
    s = row_shares(t, ["a", "b"]).collect()
    assert [(r.a, r.b) for r in s] == [(1.0, None), (0.5, 0.5)]
    assert force_columns(df, ["c"], ["b", "zz"]).columns == ["c", "b", "zz"]


def test_count_levels_zero_fill_D18(spark):
    df = spark.createDataFrame([("March",), ("January",), ("March",), ("Smarch",)], "m string")
    got = [tuple(r) for r in count_levels(df, "m", ["January", "February", "March"]).collect()]
    assert got == [("January", 1), ("February", 0), ("March", 2)]


def test_mode_fill_smallest_tie_D16(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert df.select(mode_value(df, "c")).first()[0] == "a"
    assert rows(fill_mode(df, "c")).count(("a",)) == 3


def test_dedupe_and_dropna_T4_T5(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert dedupe(df).count() == 2
    assert rows(drop_incomplete(df)) == [(2, "x")]
    s = spark.createDataFrame([(dt.date(1900, 1, 1),), (dt.date(2020, 1, 1),)], "d date")
    assert rows(s.select(null_sentinels("d", [dt.date(1900, 1, 1)]))) == [(dt.date(2020, 1, 1),), (None,)]


def test_name_rules_B4_B7_D26_D27(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`0_min` int, `a_10_x` int, test_col int")
    assert rename_by_rule(df, "0_", "temp_").columns == ["temp_min", "a_10_x", "test_col"]
    assert drop_by_regex(df, r"_[1-9][0-9]_|test").columns == ["0_min"]
    out, missing = drop_listed(df, ["test_col", "nope"])
    assert out.columns == ["0_min", "a_10_x"] and missing == ["nope"]
    with pytest.raises(ValueError):
        repair_names(spark.createDataFrame([(1, 2)], "a int, b int").toDF("x", "x"))
    assert repair_names(spark.createDataFrame([(1,)], "a int").toDF("")).columns == ["blank"]


def test_describe_linear_quartiles_D21(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = describe(df, "x").first()
    assert (r.p25, r.p50, r.p75) == (1.75, 2.5, 4.75)
    assert r["count"] == 4 and r["min"] == 1.0 and r["max"] == 10.0


def test_histogram_last_bin_closed_and_zero_width_D22(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "x double")
    h = histogram(df, "x", 10).collect()
    assert [r["count"] for r in h] == [1] * 9 + [2]
    same = histogram(spark.createDataFrame([(5.0,), (5.0,)], "x double"), "x", 4).collect()
    assert [r["count"] for r in same] == [2, 0, 0, 0]


def test_box_stats_whiskers_clip_to_data(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double")
    r = box_stats(df, "x").first()
    assert (r.p25, r.p75, r.whisker_low, r.whisker_high, r.outliers) == (2.0, 4.0, 1.0, 4.0, 1)
    g = box_stats(df.withColumn("g", F.lit("a")), "x", by=["g"], whis=100.0).first()
    assert g.outliers == 0 and g.whisker_high == 100.0


def test_correlations_symmetric_and_constant_is_null_D20(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.1, 7.0), (3.0, 5.9, 7.0), (None, 1.0, 7.0)], "a double, b double, c double")
    got = {(r.var_x, r.var_y): r.r for r in correlations(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == got[("b", "a")] and abs(got[("a", "b")]) <= 1
    assert got[("a", "c")] is None and got[("a", "a")] == 1.0


def test_profiles_G23_G24(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    assert rows(null_profile(df)) == [("a", 1), ("b", 1)]
    assert rows(schema_profile(df)) == [("a", "int", 1), ("b", "string", 1)]


def test_cohort_properties(spark):
    data = [(1, dt.datetime(1997, 1, 5)), (1, dt.datetime(1997, 3, 1)), (2, dt.datetime(1997, 3, 9)),
            (2, dt.datetime(1997, 3, 10)), (3, dt.datetime(1998, 1, 1))]
    df = spark.createDataFrame(data, "c int, d timestamp_ntz")
    c = cohort(df, "c", "d", "1997-01-01", "1997-12-31")
    long = c.long.collect()
    for r in long:
        assert r.retained_subjects <= r.new_subjects
        if r.first_month == r.retention_month:
            assert float(r.retention_rate) == 1.0
    assert rows(c.new) == [(dt.date(1997, 1, 1), 1), (dt.date(1997, 3, 1), 1)]


def test_transpose_small_T11(spark):
    from tessera.operators.reshape import transpose_small
    df = spark.createDataFrame([("F", 1, 2), ("O", 3, 4)], "t string, a bigint, b bigint")
    got = {r[0]: tuple(r[1:]) for r in transpose_small(df, "t").collect()}
    assert got == {"a": (1, 3), "b": (2, 4)}


def test_broadcast_only_behind_a_known_bound(spark):
    from tessera.operators.joins import bounded
    dim = spark.range(0, 1000)
    fact = spark.range(0, 100000)

    def plan(dim):
        return fact.join(dim, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(bounded(dim, known_rows=1000)).lower()
    assert "strategy=broadcast" not in plan(bounded(dim, known_rows=1000, max_rows=10)).lower()


def test_missing_checkpoint_folder_raises_off_one_machine():
    from tessera.session import require_local
    require_local("local[4]")
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            require_local(master)


def test_a_grown_table_is_read_whole(spark, tmp_path):
    from tessera.sources.tables import read_table
    path = f"{tmp_path}/part.parquet"
    spark.range(3).write.parquet(path)
    assert read_table(spark, str(tmp_path), "part").count() == 3
    spark.range(7).write.mode("append").parquet(path)
    assert read_table(spark, str(tmp_path), "part").count() == 10


def test_scratch_tables_can_be_dropped(spark):
    import os
    from tessera.session import drop_scratch, scratch_path
    path = scratch_path(spark, "t")
    spark.range(2).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.exists(local) and drop_scratch(spark) >= 1 and not os.path.exists(local)


def test_correlations_of_constant_and_single_columns(spark):
    from tessera.operators.stats import correlations
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    got = {(r.var_x, r.var_y): r.r for r in correlations(df, ["x", "c"]).collect()}
    assert got == {("x", "x"): 1.0, ("c", "c"): None, ("x", "c"): None, ("c", "x"): None}
    assert [tuple(r) for r in correlations(df, ["x"]).collect()] == [("x", "x", 1.0)]


def test_count_null_on_empty_input(spark):
    from tessera.operators.aggregates import distinct_count
    df = spark.createDataFrame([], "v int")
    assert df.agg(distinct_count("v", count_null=True)).first()[0] == 0


def test_box_stats_plan_has_no_second_scan_and_splits_hot_groups(spark):
    from tessera.operators.stats import box_stats
    rows = [("hot", float(i % 97)) for i in range(4000)] + [("cold", 1.0), ("cold", 9.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r for r in box_stats(df, "x", ["g"]).collect()}
    assert set(got) == {"hot", "cold"} and got["hot"].n == 4000
    assert (got["cold"].p25, got["cold"].p50, got["cold"].p75, got["cold"].outliers) == (3.0, 5.0, 7.0, 0)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = box_stats(df, "x", ["g"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_reshape_with_no_values(spark):
    df = spark.createDataFrame([(1, "x")], "id int, v string")
    wide = cross_tab(df, ["id"], "v", [], agg=F.first("v"))
    assert wide.columns == ["id"]
    long = unpivot_named(wide, ["id"], r"^W_", "s", "v")
    assert long.columns == ["id", "s", "v"] and long.count() == 0
