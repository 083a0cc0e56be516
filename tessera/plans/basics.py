"""Data-manipulation basics and dashboard prose items (Q75-Q80).

Fixture roles (SURVEY 7.2): department = ``p_brand`` (max of
``p_retailprice``); units of one product type sold in one year = lineitem
quantity in one year for one return flag; totals by region = customer
balance per region; a daily series for two cities = mean order total per day
for two nations.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.dates import in_range
from tessera.functions.numeric import money
from tessera.operators.aggregates import top_k
from tessera.operators.joins import Link, enrich, semi
from tessera.plans.events import events_view, fact_events
from tessera.sources.tables import Warehouse

SOLD_YEAR, SOLD_FLAG = 1997, "A"
CITIES = ["NATION_1", "NATION_2"]


# Q75 -------------------------------------------------------------------------
def max_sales_by_department(spark, base):
    p = Warehouse(spark, base).part
    per = p.groupBy(F.col("p_brand").alias("department")).agg(F.max("p_retailprice").alias("weekly_sales"))
    return top_k(per, [F.desc("weekly_sales"), F.asc("department")], 5)


# Q76 -------------------------------------------------------------------------
def sold_in_year_of_type(spark, base):
    li = Warehouse(spark, base).lineitem
    sel = li.filter(in_range("l_shipdate", f"{SOLD_YEAR}-01-01", f"{SOLD_YEAR}-12-31")
                    & (F.col("l_returnflag") == SOLD_FLAG))
    return sel.agg(F.sum(money("l_quantity")).alias("nb_sold"))


# Q77 -------------------------------------------------------------------------
def sum_by_region(spark, base, ascending: bool = True):
    w = Warehouse(spark, base)
    per_nation = w.customer.groupBy("c_nationkey").agg(F.sum(money("c_acctbal")).alias("s"))
    rows = enrich(per_nation, [Link(w.nation, "c_nationkey", "n_nationkey", ["n_regionkey"]),
                               Link(w.region, "n_regionkey", "r_regionkey", ["r_name"])])
    out = rows.groupBy(F.col("r_name").alias("region")).agg(F.sum("s").alias("individuals"))
    return out.orderBy(F.col("individuals").asc() if ascending else F.col("individuals").desc(), "region")


# Q78 -------------------------------------------------------------------------
def mean_by_date_two_cities(spark, base):
    w = Warehouse(spark, base)
    nations = w.nation.filter(F.col("n_name").isin(*CITIES)).select("n_nationkey", "n_name")
    cust = enrich(semi(w.customer.select("c_custkey", "c_nationkey"),
                       nations.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"),
                  [Link(nations, "c_nationkey", "n_nationkey", ["n_name"])])
    o = w.orders.select("o_custkey", "o_orderdate", "o_totalprice").join(
        cust.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    return (o.groupBy(F.col("n_name").alias("city"), F.to_date("o_orderdate").alias("date"))
            .agg(F.round(F.avg(money("o_totalprice")), 4).cast("double").alias("avg_temp_c")))


# Q79 -------------------------------------------------------------------------
def conformed_dimension(spark, base):
    """Nation keys used by either fact, with per-fact counts and an orphan flag."""
    w = Warehouse(spark, base)
    c = w.customer.groupBy(F.col("c_nationkey").alias("nation_key")).agg(F.count(F.lit(1)).alias("customers"))
    s = w.supplier.groupBy(F.col("s_nationkey").alias("nation_key")).agg(F.count(F.lit(1)).alias("suppliers"))
    keys = c.select("nation_key").union(s.select("nation_key")).distinct()
    dim = w.nation.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"))
    out = (keys.join(c, "nation_key", "left").join(s, "nation_key", "left")
           .join(dim, "nation_key", "left"))
    return out.select("nation_key", "nation_name",
                      F.coalesce("customers", F.lit(0)).alias("customers"),
                      F.coalesce("suppliers", F.lit(0)).alias("suppliers"),
                      F.col("nation_name").isNull().alias("is_orphan"))


# Q80 -------------------------------------------------------------------------
def events_by_state(spark, base):
    v = events_view(spark, base)
    return v.groupBy(F.col("nation_name").alias("state_name")).agg(F.count(F.lit(1)).alias("events"))


def top_sellers(spark, base):
    f = fact_events(spark, base).filter(F.col("line_part_key_1").isNotNull())
    per = f.groupBy(F.col("line_part_key_1").alias("part_key")).agg(F.sum("sales").alias("total_sales"))
    return top_k(per, [F.desc("total_sales"), F.asc("part_key")], 10)


QUERIES = {
    "max_sales_by_department": max_sales_by_department,
    "sold_in_year_of_type": sold_in_year_of_type,
    "sum_by_region": sum_by_region,
    "mean_by_date_two_cities": mean_by_date_two_cities,
    "conformed_dimension": conformed_dimension,
    "events_by_state": events_by_state,
    "top_sellers": top_sellers,
}

_CITIES = ", ".join(f"'{c}'" for c in CITIES)
ORACLE = {
    "max_sales_by_department": """
SELECT p_brand AS department, MAX(p_retailprice) AS weekly_sales FROM part
GROUP BY p_brand ORDER BY weekly_sales DESC, department LIMIT 5""",
    "sold_in_year_of_type": f"""
SELECT SUM(CAST(l_quantity AS DECIMAL(18,2))) AS nb_sold FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '{SOLD_YEAR}-01-01' AND TIMESTAMP '{SOLD_YEAR}-12-31'
  AND l_returnflag = '{SOLD_FLAG}'""",
    "sum_by_region": """
SELECT r.r_name AS region, SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS individuals
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name ORDER BY individuals""",
    "mean_by_date_two_cities": f"""
SELECT n.n_name AS city, CAST(o.o_orderdate AS DATE) AS date,
       CAST(ROUND(AVG(CAST(o.o_totalprice AS DECIMAL(18,2))), 4) AS DOUBLE) AS avg_temp_c
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name IN ({_CITIES})
GROUP BY 1, 2""",
    "conformed_dimension": """
WITH c AS (SELECT c_nationkey AS nation_key, COUNT(*) AS customers FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS nation_key, COUNT(*) AS suppliers FROM supplier GROUP BY 1),
k AS (SELECT nation_key FROM c UNION SELECT nation_key FROM s)
SELECT k.nation_key, n.n_name AS nation_name, COALESCE(c.customers, 0) AS customers,
       COALESCE(s.suppliers, 0) AS suppliers, n.n_name IS NULL AS is_orphan
FROM k LEFT JOIN c ON k.nation_key = c.nation_key LEFT JOIN s ON k.nation_key = s.nation_key
  LEFT JOIN nation n ON k.nation_key = n.n_nationkey""",
    "events_by_state": """
SELECT n.n_name AS state_name, COUNT(*) AS events
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1""",
    "top_sellers": """
WITH slot AS (
  SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS part_key,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS p
  FROM lineitem GROUP BY 1, 2
)
SELECT part_key, CAST(SUM(((l_orderkey % 1000003) * 7919) % 81 + 20) AS BIGINT) AS total_sales
FROM slot WHERE p = 1 AND part_key IS NOT NULL
GROUP BY part_key ORDER BY total_sales DESC, part_key LIMIT 10""",
}
