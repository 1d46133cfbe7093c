"""Join shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query
from tidemark.operators import joins as j


@query("""
SELECT o_orderkey, n_name, r_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def star_enrichment(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    full = j.enrich(t.orders.select("o_orderkey", "o_custkey"), [(customers, "o_custkey"), (places, "c_nationkey")])
    return full.select("o_orderkey", "n_name", "r_name", "c_mktsegment").filter(F.col("n_name").isNotNull())


@query("""
WITH pairs AS (SELECT DISTINCT o_custkey, o_orderkey % 40 AS supp FROM orders WHERE o_orderstatus = 'F')
SELECT c_custkey, c_name, s_suppkey, s_name FROM customer LEFT JOIN pairs ON c_custkey = o_custkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 1000) ON supp = s_suppkey""", name="bridge_join")
def customers_through_bridge(t):
    pairs = t.orders.filter("o_orderstatus = 'F'").select("o_custkey", (F.col("o_orderkey") % 40).alias("supp"))
    suppliers = t.supplier.filter("s_acctbal > 1000").select("s_suppkey", "s_name")
    return j.bridge_join(t.customer.select("c_custkey", "c_name"), pairs, suppliers, "c_custkey", "s_suppkey",
                         bridge_left="o_custkey", bridge_right="supp")


@query("""
WITH newest AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN newest ON c_custkey = o_custkey""", name="latest_join")
def customers_with_latest_order(t):
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate", "o_totalprice")
    joined = j.latest_join(t.customer.select("c_custkey", "c_name"), orders, "c_custkey",
                           [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return joined.drop("o_orderdate")


@query("""
SELECT a.c_custkey, a.c_name, b.c_name AS parent_c_name, b.c_mktsegment AS parent_c_mktsegment
FROM customer a JOIN customer b ON a.c_custkey // 10 = b.c_custkey""")
def customer_hierarchy(t):
    source = t.customer.select("c_custkey", "c_name", "c_mktsegment", F.floor(F.col("c_custkey") / 10).alias("above"))
    return j.hierarchy_join(source, "above", "c_custkey", ["c_name", "c_mktsegment"]).drop("above", "c_mktsegment")


@query("""
SELECT o_orderkey, c.n_name AS customer_n_name, s.n_name AS seller_n_name FROM orders
LEFT JOIN nation c ON o_custkey % 30 = c.n_nationkey LEFT JOIN nation s ON o_orderkey % 27 = s.n_nationkey""", name="role_join")
def nations_in_roles(t):
    source = t.orders.select("o_orderkey", (F.col("o_custkey") % 30).alias("ck"), (F.col("o_orderkey") % 27).alias("sk"))
    return j.role_join(source, t.nation, {"customer": "ck", "seller": "sk"}, "n_nationkey", ["n_name"]).drop("ck", "sk")


@query("""
SELECT c_custkey, CAST(CAST(unnest(generate_series(DATE '2001-01-01', DATE '2001-06-01', INTERVAL 1 MONTH)) AS DATE) AS VARCHAR) AS month
FROM customer""", name="cross_spine")
def customer_months(t):
    return j.cross_spine(t.customer.select("c_custkey"), "2001-01-01", "2001-06-01")


@query("""
SELECT o_orderkey, o_totalprice = (SELECT max(o_totalprice) FROM orders) AS is_highest FROM orders""")
def share_of_highest(t):
    marked = j.with_scalar(t.orders.select("o_orderkey", "o_totalprice"), F.max("o_totalprice"), t.orders, "highest")
    return marked.select("o_orderkey", (F.col("o_totalprice") == F.col("highest")).alias("is_highest"))


@query("""
WITH spans AS (SELECT s_suppkey, DATE '1996-01-01' + CAST(s_suppkey * 7 AS INTEGER) AS lo, DATE '1996-01-01' + CAST(s_suppkey * 7 + 20 AS INTEGER) AS hi FROM supplier),
daily AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT s_suppkey, CAST(d AS VARCHAR) AS day, n FROM daily JOIN spans ON d BETWEEN lo AND hi""", name="date_range_join")
def days_in_spans(t):
    start = F.lit("1996-01-01").cast("date")
    number = (F.col("s_suppkey") * 7).cast("int")
    spans = t.supplier.select("s_suppkey", F.date_add(start, number).alias("lo"), F.date_add(start, number + 20).alias("hi"))
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return j.date_range_join(daily, spans, "day", "lo", "hi").select("s_suppkey", "day", "n")


@query("""
WITH daily AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT s_suppkey, count(*) AS n_days, CAST(sum(n) AS BIGINT) AS n_orders FROM daily JOIN supplier ON d >= DATE '2001-01-01' + CAST(s_suppkey AS INTEGER)
GROUP BY 1""")
def date_range_join_open(t):
    spans = t.supplier.select("s_suppkey", F.date_add(F.lit("2001-01-01").cast("date"), F.col("s_suppkey").cast("int")).alias("lo"),
                              F.lit("9999-12-31").cast("date").alias("hi"))
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    joined = j.date_range_join(daily, spans, "day", "lo", "hi")
    return joined.groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n_days"), F.sum("n").alias("n_orders"))


@query("""
SELECT s_suppkey, p_partkey, p_retailprice FROM part JOIN supplier ON p_retailprice BETWEEN s_acctbal AND s_acctbal + 150""",
       name="range_join")
def parts_in_bands(t):
    bands = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("lo"), (F.col("s_acctbal") + 150).alias("hi"))
    return j.range_join(t.part.select("p_partkey", "p_retailprice"), bands, "p_retailprice", "lo", "hi", 150).select(
        "s_suppkey", "p_partkey", "p_retailprice")


@query("""
WITH spans AS (SELECT s_suppkey, DATE '1995-06-01' + CAST(s_suppkey % 40 * 50 AS INTEGER) AS lo, CASE WHEN s_suppkey % 5 = 0 THEN DATE '9999-12-31'
                 ELSE DATE '1995-06-01' + CAST(s_suppkey % 40 * 50 + s_suppkey % 4 * 700 - 3 AS INTEGER) END AS hi FROM supplier),
facts AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN DATE '1998-01-05' ELSE CAST(o_orderdate AS DATE) END AS d, o_totalprice FROM orders)
SELECT s_suppkey, CAST(lo AS VARCHAR) AS lo, count(*) AS n, max(o_orderkey) AS last_order, CAST(count(DISTINCT d) AS BIGINT) AS n_days FROM facts JOIN spans ON d BETWEEN lo AND hi GROUP BY ALL""")
def long_ranges(t):
    """Ranges of days, years and without end, over facts a third of which lie on one day.

    Counts and maxima need no single facts, so these are brought to one row a day before they meet the ranges, and
    ranges to one row each with the number of times they come; a range then meets a day once, however often it comes.
    """
    day = F.when(F.col("o_orderkey") % 3 == 0, F.lit("1998-01-05").cast("date")).otherwise(F.col("o_orderdate").cast("date"))
    daily = t.orders.groupBy(day.alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_order"))
    start = F.date_add(F.lit("1995-06-01").cast("date"), (F.col("s_suppkey") % 40 * 50).cast("int"))
    end = F.when(F.col("s_suppkey") % 5 == 0, F.lit("9999-12-31").cast("date")).otherwise(F.date_add(start, (F.col("s_suppkey") % 4 * 700 - 3).cast("int")))
    spans = t.supplier.groupBy("s_suppkey", start.alias("lo"), end.alias("hi")).agg(F.count(F.lit(1)).alias("times"))
    joined = j.quantile_range_join(daily, spans, "d", "lo", "hi", rows_per_piece=100, fan=8)
    # Both ends of a range hang on its supplier, so the days of a supplier are all different.
    return joined.groupBy("s_suppkey", "lo").agg(F.sum(F.col("n") * F.col("times")).alias("n"), F.max("last_order").alias("last_order"), F.count("d").alias("n_days"))


@query("""
SELECT p_partkey, s_suppkey FROM part JOIN supplier ON p_retailprice BETWEEN s_acctbal AND s_acctbal + s_suppkey % 3 * 400 - 50""")
def quantile_ranges(t):
    bands = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("lo"), (F.col("s_acctbal") + F.col("s_suppkey") % 3 * 400 - 50).alias("hi"))
    return j.quantile_range_join(t.part.select("p_partkey", "p_retailprice"), bands, "p_retailprice", "lo", "hi").select("p_partkey", "s_suppkey")


@query("""
SELECT coalesce(a.k, b.k) AS k, n_customers, n_suppliers FROM
  (SELECT c_nationkey AS k, count(*) AS n_customers FROM customer WHERE c_acctbal > 9700 GROUP BY 1) a FULL JOIN
  (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) b ON a.k = b.k""", name="full_join")
def parties_per_nation(t):
    customers = t.customer.filter("c_acctbal > 9700").groupBy(F.col("c_nationkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    suppliers = t.supplier.filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n_suppliers"))
    return j.full_join(customers, suppliers, "k")


@query("""
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""", name="anti_join")
def orders_without_lines(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return j.anti_join(t.orders.select("o_orderkey", "o_custkey"), lines, "o_orderkey")


@query("""
SELECT p_partkey, EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49) AS sold_in_bulk FROM part""",
       name="flag_exists")
def parts_sold_in_bulk(t):
    return j.flag_exists(t.part.select("p_partkey"), t.lineitem.filter("l_quantity > 49"), "p_partkey", "sold_in_bulk",
                         "l_partkey")
