"""Rental-demand exploratory analysis (Q65-Q74, Q81).

Fixture roles (SURVEY 7.2): an hourly rental record is an ``events`` row;
rented count = ``value``, season = ``event_type``, holiday = weekend,
temperature = ``props.k``; the numeric columns for correlation are those of
``lineitem``; monthly means use ``orders``.

Every statistic is an aggregate with map-side combine; whole-column values
(min, max, quartiles) are scalar subqueries; charts are replaced by the
aggregates behind them (binned counts instead of raw scatter points).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tessera.functions.dates import DAY_NAMES, MONTH_NAMES, day_name, month_name
from tessera.functions.numeric import money
from tessera.functions.recode import bucket, ordinal
from tessera.operators.names import rename_map
from tessera.operators.stats import box_stats, correlations, describe, histogram
from tessera.operators.windows import sample_per_group
from tessera.sources.tables import Warehouse

RENAME = {"event_type": "seasons", "value": "rented_bike_count"}
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CORR_TARGET = "l_extendedprice"
HIGH_DEMAND = 250.0
WHIS_GROUPED = 10.0
BINS = 10
# Part-of-day bounds, hours in (lo, hi].
DAYPARTS = ([(None, 11), (11, 17), (17, None)], ["morning", "afternoon", "evening"])
MONTH_THIRDS = ([(None, 10), (10, 20), (20, None)], ["early", "mid", "late"])


def _r(c: str, digits: int = 6):
    return F.round(F.col(c), digits).alias(c)


def _ev(spark, base) -> DataFrame:
    return Warehouse(spark, base).events


# Q65 -------------------------------------------------------------------------
def rental_rename_and_calendar(spark, base):
    ev = rename_map(_ev(spark, base), RENAME)
    return ev.select(*ev.columns, F.to_date("ts").alias("date"), month_name("ts").alias("month"),
                     day_name("ts").alias("day_name"))


# Q66 -------------------------------------------------------------------------
def rental_histogram(spark, base):
    h = histogram(_ev(spark, base), "value", BINS)
    return h.select("bin", _r("lower"), _r("upper"), "count")


# Q67 -------------------------------------------------------------------------
_BOX = ["p25", "p50", "p75", "lo_fence", "hi_fence", "whisker_low", "whisker_high"]


def rental_box(spark, base):
    b = box_stats(_ev(spark, base), "value")
    return b.select(*[_r(c) for c in _BOX], "outliers", "n")


# Q68 -------------------------------------------------------------------------
def rental_describe(spark, base):
    d = describe(_ev(spark, base), "value")
    return d.select("count", *[_r(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


# Q69 -------------------------------------------------------------------------
def rental_mean_by_month(spark, base):
    o = Warehouse(spark, base).orders
    m = (o.groupBy(month_name("o_orderdate").alias("month"))
         .agg(F.round(F.avg(money("o_totalprice")), 4).cast("double").alias("mean_total_price")))
    return m.orderBy(ordinal("month", MONTH_NAMES))


# Q70 -------------------------------------------------------------------------
def _hourly_mean(ev: DataFrame, key) -> DataFrame:
    return (ev.groupBy(F.hour("ts").alias("hour"), key)
            .agg(F.round(F.avg(money("value")), 6).cast("double").alias("mean_value")))


def rental_mean_by_hour_season(spark, base):
    return _hourly_mean(_ev(spark, base), F.col("event_type").alias("seasons")).orderBy("seasons", "hour")


def rental_mean_by_hour_month(spark, base):
    third = bucket(F.dayofmonth("ts"), *MONTH_THIRDS).alias("month_part")
    return _hourly_mean(_ev(spark, base), third).orderBy("month_part", "hour")


def rental_mean_by_hour_dayname(spark, base):
    out = _hourly_mean(_ev(spark, base), day_name("ts").alias("day_name"))
    return out.orderBy(ordinal("day_name", DAY_NAMES), "hour")


# Q71 -------------------------------------------------------------------------
def rental_correlations(spark, base):
    c = correlations(Warehouse(spark, base).lineitem, CORR_COLS)
    return c.select("var_x", "var_y", _r("r"))


def rental_correlation_ranking(spark, base):
    c = correlations(Warehouse(spark, base).lineitem, CORR_COLS)
    c = c.filter((F.col("var_x") == CORR_TARGET) & (F.col("var_y") != CORR_TARGET))
    # a handful of rows (one per variable): a single-partition window is fine here
    w = Window.orderBy(F.desc(F.abs("r")), "var_y")
    return c.select(F.col("var_y").alias("variable"), _r("r"),
                    F.row_number().over(w).alias("strength_rank"))


# Q72 -------------------------------------------------------------------------
def rental_scatter_source(spark, base):
    li = Warehouse(spark, base).lineitem
    x, y = F.col("l_quantity"), F.col("l_extendedprice")
    rng = li.select(F.struct(F.min(x).alias("xmn"), F.max(x).alias("xmx"),
                             F.min(y).alias("ymn"), F.max(y).alias("ymx"))).scalar()  # one subquery

    def binned(c, mn, mx):
        return F.when(mx == mn, F.lit(1)).otherwise(
            F.least(F.floor((c - mn) / (mx - mn) * BINS) + 1, F.lit(BINS))).cast("int")

    return (li.filter(x.isNotNull() & y.isNotNull()).withColumn("__r", rng)
            .groupBy(F.col("l_returnflag").alias("grp"),
                     binned(x, F.col("__r.xmn"), F.col("__r.xmx")).alias("x_bin"),
                     binned(y, F.col("__r.ymn"), F.col("__r.ymx")).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("n")))


SCATTER_ROWS, SCATTER_KEY = 100, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def rental_scatter_sample(spark, base):
    """The points of the scatter plot: the same number of rows per group, drawn by hash."""
    li = Warehouse(spark, base).lineitem
    points = sample_per_group(li.select("l_returnflag", "l_quantity", "l_extendedprice", *SCATTER_KEY), ["l_returnflag"], SCATTER_ROWS,
                              SCATTER_KEY, ties=["l_quantity", "l_extendedprice"])
    return points.select(F.col("l_returnflag").alias("grp"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), "l_orderkey", "l_linenumber")


# Q73 -------------------------------------------------------------------------
def temperature_histogram_high_demand(spark, base):
    ev = _ev(spark, base).filter(F.col("value") > HIGH_DEMAND)
    ev = ev.select(F.get_json_object("props", "$.k").cast("int").alias("temperature"))
    h = histogram(ev, "temperature", BINS)
    return h.select("bin", _r("lower"), _r("upper"), "count")


# Q74 -------------------------------------------------------------------------
def rental_box_by_season_holiday(spark, base):
    ev = _ev(spark, base).select(
        F.col("event_type").alias("seasons"),
        F.when(F.dayofweek("ts").isin(1, 7), "Holiday").otherwise("No Holiday").alias("holiday"), "value")
    b = box_stats(ev, "value", by=["seasons", "holiday"], whis=WHIS_GROUPED)
    return b.select("seasons", "holiday", *[_r(c) for c in _BOX], "outliers", "n")


# Q81 -------------------------------------------------------------------------
def mean_by_daypart_season(spark, base):
    ev = _ev(spark, base)
    part = bucket(F.hour("ts"), *DAYPARTS).alias("day_part")
    return (ev.groupBy(part, F.col("event_type").alias("seasons"))
            .agg(F.round(F.avg(money("value")), 6).cast("double").alias("mean_value"))
            .orderBy("seasons", ordinal("day_part", DAYPARTS[1])))


QUERIES = {
    "rental_rename_and_calendar": rental_rename_and_calendar,
    "rental_histogram": rental_histogram,
    "rental_box": rental_box,
    "rental_describe": rental_describe,
    "rental_mean_by_month": rental_mean_by_month,
    "rental_mean_by_hour_season": rental_mean_by_hour_season,
    "rental_mean_by_hour_month": rental_mean_by_hour_month,
    "rental_mean_by_hour_dayname": rental_mean_by_hour_dayname,
    "rental_correlations": rental_correlations,
    "rental_correlation_ranking": rental_correlation_ranking,
    "rental_scatter_source": rental_scatter_source,
    "rental_scatter_sample": rental_scatter_sample,
    "temperature_histogram_high_demand": temperature_histogram_high_demand,
    "rental_box_by_season_holiday": rental_box_by_season_holiday,
    "mean_by_daypart_season": mean_by_daypart_season,
}

# ----------------------------------------------------------------------------


def _hist_sql(src: str, col: str) -> str:
    return f"""
WITH src AS ({src}),
s AS (SELECT MIN(CAST({col} AS DOUBLE)) AS mn, MAX(CAST({col} AS DOUBLE)) AS mx FROM src),
b AS (
  SELECT CASE WHEN mx = mn THEN 1 ELSE LEAST(FLOOR((CAST({col} AS DOUBLE) - mn) / (mx - mn) * {BINS}) + 1, {BINS}) END
         AS bin
  FROM src, s WHERE {col} IS NOT NULL
),
c AS (SELECT bin, COUNT(*) AS n FROM b GROUP BY bin),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {BINS + 1}))
SELECT bins.bin, ROUND(mn + (mx - mn) / {BINS} * (bins.bin - 1), 6) AS lower,
       ROUND(mn + (mx - mn) / {BINS} * bins.bin, 6) AS upper, COALESCE(c.n, 0) AS count
FROM bins LEFT JOIN c ON bins.bin = c.bin, s"""


def _box_sql(by: list[str], src: str, whis: float) -> str:
    keys = ", ".join(by)
    sel = f"{keys}, " if by else ""
    grp = f"GROUP BY {keys}" if by else ""
    on = " AND ".join(f"r.{k} = q.{k}" for k in by) if by else "TRUE"
    return f"""
WITH src AS ({src}),
q AS (
  SELECT {sel}quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
         quantile_cont(value, 0.75) AS p75
  FROM src WHERE value IS NOT NULL {grp}
),
f AS (SELECT *, p25 - {whis} * (p75 - p25) AS lo_fence, p75 + {whis} * (p75 - p25) AS hi_fence FROM q)
SELECT {", ".join(f"q.{k}" for k in by) + ", " if by else ""}
       ROUND(q.p25, 6) AS p25, ROUND(q.p50, 6) AS p50, ROUND(q.p75, 6) AS p75,
       ROUND(q.lo_fence, 6) AS lo_fence, ROUND(q.hi_fence, 6) AS hi_fence,
       ROUND(MIN(CASE WHEN r.value >= q.lo_fence THEN r.value END), 6) AS whisker_low,
       ROUND(MAX(CASE WHEN r.value <= q.hi_fence THEN r.value END), 6) AS whisker_high,
       COUNT(*) FILTER (WHERE r.value < q.lo_fence OR r.value > q.hi_fence) AS outliers,
       COUNT(r.value) AS n
FROM src r JOIN f q ON {on}
WHERE r.value IS NOT NULL
GROUP BY {", ".join(f"q.{k}" for k in by) + ", " if by else ""}q.p25, q.p50, q.p75, q.lo_fence, q.hi_fence"""


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i + 1:]:
            r = f"ROUND(corr({a}, {b}), 6)"
            parts.append(f"SELECT '{a}' AS var_x, '{b}' AS var_y, {r} AS r FROM lineitem")
            parts.append(f"SELECT '{b}' AS var_x, '{a}' AS var_y, {r} AS r FROM lineitem")
    for a in CORR_COLS:
        parts.append(f"SELECT '{a}' AS var_x, '{a}' AS var_y, CASE WHEN MIN({a}) < MAX({a}) THEN 1.0::DOUBLE END AS r FROM lineitem")
    return "\nUNION ALL ".join(parts)


_MONEY_VALUE = "CAST(value AS DECIMAL(18,2))"
_DAYPART_SQL = "CASE WHEN hour(ts) <= 11 THEN 'morning' WHEN hour(ts) <= 17 THEN 'afternoon' ELSE 'evening' END"
_THIRD_SQL = "CASE WHEN day(ts) <= 10 THEN 'early' WHEN day(ts) <= 20 THEN 'mid' ELSE 'late' END"

ORACLE = {
    "rental_rename_and_calendar": """
SELECT event_id, ts, user_id, event_type AS seasons, value AS rented_bike_count, props,
       CAST(ts AS DATE) AS date, strftime(ts, '%B') AS month, strftime(ts, '%A') AS day_name
FROM events""",
    "rental_histogram": _hist_sql("SELECT value FROM events", "value"),
    "rental_box": _box_sql([], "SELECT value FROM events", 1.5),
    "rental_describe": """
WITH q AS (SELECT quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
                  quantile_cont(value, 0.75) AS p75 FROM events WHERE value IS NOT NULL)
SELECT COUNT(value) AS count, ROUND(AVG(value), 6) AS mean, ROUND(stddev_samp(value), 6) AS std,
       ROUND(MIN(value), 6) AS min, ROUND(ANY_VALUE(q.p25), 6) AS p25, ROUND(ANY_VALUE(q.p50), 6) AS p50,
       ROUND(ANY_VALUE(q.p75), 6) AS p75, ROUND(MAX(value), 6) AS max
FROM events, q""",
    "rental_mean_by_month": """
SELECT strftime(o_orderdate, '%B') AS month,
       CAST(ROUND(AVG(CAST(o_totalprice AS DECIMAL(18,2))), 4) AS DOUBLE) AS mean_total_price
FROM orders GROUP BY 1""",
    "rental_mean_by_hour_season": f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, event_type AS seasons,
       CAST(ROUND(AVG({_MONEY_VALUE}), 6) AS DOUBLE) AS mean_value
FROM events GROUP BY 1, 2""",
    "rental_mean_by_hour_month": f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, {_THIRD_SQL} AS month_part,
       CAST(ROUND(AVG({_MONEY_VALUE}), 6) AS DOUBLE) AS mean_value
FROM events GROUP BY 1, 2""",
    "rental_mean_by_hour_dayname": f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, strftime(ts, '%A') AS day_name,
       CAST(ROUND(AVG({_MONEY_VALUE}), 6) AS DOUBLE) AS mean_value
FROM events GROUP BY 1, 2""",
    "rental_correlations": _corr_sql(),
    "rental_correlation_ranking": f"""
WITH c AS ({_corr_sql()})
SELECT var_y AS variable, r,
       CAST(ROW_NUMBER() OVER (ORDER BY ABS(r) DESC, var_y) AS INTEGER) AS strength_rank
FROM c WHERE var_x = '{CORR_TARGET}' AND var_y != '{CORR_TARGET}'""",
    "rental_scatter_sample": f"""
SELECT l_returnflag AS grp, l_quantity AS x, l_extendedprice AS y, l_orderkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('0|' || {" || '|' || ".join(f'CAST({c} AS VARCHAR)' for c in SCATTER_KEY)}),
                           {", ".join(SCATTER_KEY)}, l_quantity, l_extendedprice) <= {SCATTER_ROWS}""",
    "rental_scatter_source": f"""
WITH s AS (SELECT MIN(l_quantity) AS xmn, MAX(l_quantity) AS xmx, MIN(l_extendedprice) AS ymn,
                  MAX(l_extendedprice) AS ymx FROM lineitem)
SELECT l_returnflag AS grp,
  CAST(CASE WHEN xmx = xmn THEN 1 ELSE LEAST(FLOOR((l_quantity - xmn) / (xmx - xmn) * {BINS}) + 1, {BINS}) END
       AS INTEGER) AS x_bin,
  CAST(CASE WHEN ymx = ymn THEN 1 ELSE LEAST(FLOOR((l_extendedprice - ymn) / (ymx - ymn) * {BINS}) + 1, {BINS}) END
       AS INTEGER) AS y_bin,
  COUNT(*) AS n
FROM lineitem, s WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL
GROUP BY 1, 2, 3""",
    "temperature_histogram_high_demand": _hist_sql(
        f"SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS temperature FROM events "
        f"WHERE value > {HIGH_DEMAND}", "temperature"),
    "rental_box_by_season_holiday": _box_sql(
        ["seasons", "holiday"],
        "SELECT event_type AS seasons, CASE WHEN dayofweek(ts) IN (0, 6) THEN 'Holiday' ELSE 'No Holiday' END "
        "AS holiday, value FROM events", WHIS_GROUPED),
    "mean_by_daypart_season": f"""
SELECT {_DAYPART_SQL} AS day_part, event_type AS seasons,
       CAST(ROUND(AVG({_MONEY_VALUE}), 6) AS DOUBLE) AS mean_value
FROM events GROUP BY 1, 2""",
}
