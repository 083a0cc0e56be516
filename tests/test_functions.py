"""One case per dialect rule and per scalar helper."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions.dates import (
    date_dim, fiscal_month_range, fiscal_year, fiscal_year_range, in_range, month_name, day_name, month_start,
)
from tessera.functions.numeric import dummy_measure, money, pct, safe_ratio
from tessera.functions.recode import bucket, ordinal, recode
from tessera.functions.text import concat_nullsafe, first_item, sprint_key


def one(spark, expr, schema="a string, b string", data=(("x", None),)):
    return spark.createDataFrame(list(data), schema).select(expr.alias("v")).first()["v"]


def test_concat_reads_null_as_empty_D2(spark):
    assert one(spark, concat_nullsafe("a", "b", sep=" ")) == "x "
    assert one(spark, F.concat("a", F.lit(" "), "b")) is None


def test_two_argument_datediff_counts_boundaries_D4(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23), dt.datetime(2024, 1, 2, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(F.datediff("b", "a")).first()[0] == 1


def test_between_excludes_later_time_on_last_day_D6(spark):
    df = spark.createDataFrame([(dt.datetime(2012, 12, 31, 10),), (dt.datetime(2012, 12, 31),)], "d timestamp_ntz")
    assert df.filter(in_range("d", "2012-01-01", "2012-12-31")).count() == 1
    assert df.filter(in_range("d", "2012-01-01", "2013-01-01", half_open=True)).count() == 2


def test_dummy_measure_in_range_and_stable_D8(spark):
    df = spark.range(0, 5000).select(dummy_measure("id").alias("m"))
    lo, hi = df.agg(F.min("m"), F.max("m")).first()
    assert 20 <= lo and hi <= 100
    a = sorted(r[0] for r in spark.range(0, 500).repartition(7).select(dummy_measure("id")).collect())
    b = sorted(r[0] for r in spark.range(0, 500).repartition(1).select(dummy_measure("id")).collect())
    assert a == b


def test_safe_ratio_and_percent_D28_R6(spark):
    df = spark.createDataFrame([(5, 0), (1, 1)], "a int, b int")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [None, 1.0]
    assert df.select(pct("a", "b")).collect()[1][0] == Decimal("100.00")


def test_money_is_exact_decimal(spark):
    df = spark.createDataFrame([(0.1,), (0.2,)], "x double")
    assert df.agg(F.sum(money("x"))).first()[0] == Decimal("0.30")


def test_month_and_day_names_are_full_D25(spark):
    d = dt.date(2024, 9, 7)
    assert one(spark, month_name(F.lit(d))) == "September"
    assert one(spark, day_name(F.lit(d))) == "Saturday"
    assert one(spark, month_start(F.lit(dt.datetime(2024, 9, 7, 13)))) == dt.date(2024, 9, 1)


def test_fiscal_year_and_ranges():
    assert fiscal_month_range(1998, 2) == ("1998-02-01", "1998-03-01")
    assert fiscal_month_range(1998, 8) == ("1997-08-01", "1997-09-01")
    assert fiscal_month_range(1998, 12) == ("1997-12-01", "1998-01-01")
    assert fiscal_year_range(1998) == ("1997-07-01", "1998-07-01")


def test_date_dim(spark):
    cal = date_dim(spark, "1997-06-29", "1997-07-02")
    got = [(r.date_key, r.fiscal_year, r.calendar_quarter) for r in cal.orderBy("date").collect()]
    assert got == [(19970629, 1997, 2), (19970630, 1997, 2), (19970701, 1998, 3), (19970702, 1998, 3)]
    assert one(spark, fiscal_year(F.lit(dt.date(2011, 8, 1)))) == 2012


def test_first_item_F4(spark):
    assert one(spark, first_item("a"), data=((", India",),), schema="a string") == ""
    assert one(spark, first_item("a"), data=(("US, India",),), schema="a string") == "US"


def test_sprint_keys_F2_F3(spark):
    assert one(spark, sprint_key("a", "DDE "), data=(("PI8___Iteration_1",),), schema="a string") == "DDE PI8 Iteration 1"
    assert one(spark, sprint_key("a", "DDE ", False), data=(("PI8_Iteration_1",),), schema="a string") == "DDE PI8 Iteration 1"


def test_recode_keeps_unmapped_D17(spark):
    df = spark.createDataFrame([("TV-MA",), ("XX",), (None,)], "r string")
    got = [r[0] for r in df.select(recode("r", {"TV-MA": "Adults"})).collect()]
    assert got == ["Adults", "XX", None]


def test_ordinal_and_bucket_edges_F19_F21(spark):
    df = spark.createDataFrame([(d,) for d in [9, 8, -4, -5, -19, -20, None]], "d int")
    got = [r[0] for r in df.select(bucket("d", [(-5, 8), (-20, -5)], ["cur", "prev"])).collect()]
    assert got == [None, "cur", "cur", "prev", "prev", None, None]
    df2 = spark.createDataFrame([("To Do",), ("Other",)], "s string")
    assert [r[0] for r in df2.select(ordinal("s", ["Bug Raised", "To Do"], default=7)).collect()] == [1, 7]


def test_collation_option_D9(spark):
    from tessera.functions.text import collated
    df = spark.createDataFrame([("Bikes",), ("BIKES",), ("bikes ",)], "c string")
    assert df.filter(F.col("c") == "bikes").count() == 0
    assert df.filter(collated("c") == "bikes").count() == 2
    assert df.filter(collated("c", "UTF8_BINARY_RTRIM") == "bikes").count() == 1


def test_distinct_count_options_G4_D30(spark):
    from tessera.operators.aggregates import distinct_count
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    r = df.agg(distinct_count("c").alias("d"), distinct_count("c", count_null=True).alias("n"),
               distinct_count("c", approx=True).alias("a")).first()
    assert (r.d, r.n, r.a) == (2, 3, 2)


def test_read_csv_declared_schema_and_bad_rows_A1(spark, tmp_path):
    from tessera.sources.files import read_csv
    p = tmp_path / "t.csv"
    p.write_text("type,title,year\nMovie,A,2019\nTV Show,B,not-a-year\n")
    df = read_csv(spark, str(p), "type string, title string, year int, _bad string", corrupt_column="_bad")
    got = sorted((r.title, r.year, r._bad is not None) for r in df.collect())
    assert got == [("A", 2019, False), ("B", None, True)]


def test_shuffle_partition_sizing():
    from tessera.session import cluster_settings, shuffle_partitions_for
    assert shuffle_partitions_for(10 << 20) == 200
    assert shuffle_partitions_for(100 * (1 << 40)) == 409600
    assert cluster_settings(1 << 40)["spark.sql.shuffle.partitions"] == "4096"


def test_null_safe_flags_and_case_else_D14_F22_F23(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), (None, None)], "x string, y string")
    got = df.select(F.coalesce(F.col("x") != F.col("y"), F.lit(False)).alias("changed"),
                    F.coalesce(F.col("x") == F.col("y"), F.lit(False)).alias("equal"),
                    F.when(F.col("x") == "a", 1).otherwise(7).alias("decode")).collect()
    assert [tuple(r) for r in got] == [(False, True, 1), (True, False, 1), (False, False, 7), (False, False, 7)]


def test_text_dates_with_blank_and_bad_values_D23(spark):
    df = spark.createDataFrame([(" June 5, 1997",), ("June 15, 1997",), ("15/06/1997",), (None,)], "d string")
    got = [r[0] for r in df.select(F.try_to_date(F.trim("d"), "MMMM d, yyyy")).collect()]
    assert got == [dt.date(1997, 6, 5), dt.date(1997, 6, 15), None, None]


def test_top_list_ignores_null_key_D15(spark):
    from tessera.plans.titles import _per_country, _top10
    df = spark.createDataFrame([("US", "t1"), (None, "t2"), (None, "t3"), ("IN", "t4")], "first_country string, title string")
    assert [r.first_country for r in _top10(_per_country(df)).collect()] == ["IN", "US"]


def test_replace_view_and_catalog_table_A3_A7(spark):
    from tessera.sources.files import replace_view
    from tessera.sources.tables import catalog_table
    replace_view(spark.range(3), "tessera_v")
    replace_view(spark.range(5), "tessera_v")          # drop-if-exists + create
    assert catalog_table(spark, "tessera_v").count() == 5
