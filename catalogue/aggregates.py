"""Grouping, distinct counts and conditional sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query
from tidemark.functions.scalars import money_sum, sum_if
from tidemark.operators import aggregate as agg


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, count(nullif(l_tax, 0)) AS n_taxed,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
       min(l_quantity) AS min_quantity, max(l_quantity) AS max_quantity,
       CAST(floor(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,10)) / count(*) + 0.5) AS BIGINT) AS average_quantity,
       count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_totals(t):
    return agg.group_agg(t.lineitem, ["l_returnflag", "l_linestatus"], {
        "n_rows": F.count(F.lit(1)), "n_taxed": F.count(F.nullif("l_tax", F.lit(0.0))),
        "sum_price": money_sum("l_extendedprice"), "min_quantity": F.min("l_quantity"),
        "max_quantity": F.max("l_quantity"), "average_quantity": agg.rounded_average("l_quantity"),
        "n_suppliers": agg.distinct_count("l_suppkey")})


@query("""
SELECT o_custkey, o_orderstatus, count(*) AS n_orders, max(o_orderpriority) AS a_priority
FROM orders GROUP BY 1, 2""")
def group_by_leading_columns(t):
    source = t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority")
    return agg.group_by_first(source, 2, {"n_orders": F.count(F.lit(1)), "a_priority": agg.any_of("o_orderpriority")})


@query("""
SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey HAVING count(*) > 12""")
def frequent_customers(t):
    return agg.having(t.orders, "o_custkey", {"n_orders": F.count(F.lit(1))}, F.col("n_orders") > 12)


@query("""
SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS returned,
       CAST(sum(CASE WHEN nullif(l_returnflag, 'R') NOT IN ('A') THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS kept,
       CAST(sum(CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_high_tax
FROM lineitem GROUP BY l_suppkey""")
def conditional_sums(t):
    quantity = F.col("l_quantity").cast("decimal(18,2)")
    known = F.nullif("l_returnflag", F.lit("R"))
    return agg.group_agg(t.lineitem, "l_suppkey", {
        "returned": sum_if(F.col("l_returnflag") == "R", quantity).cast("double"),
        "kept": sum_if(~known.isin("A"), quantity).cast("double"),
        "n_high_tax": sum_if(F.col("l_tax") > 0.05)})


@query("""
SELECT count(*) AS n_events, count(DISTINCT user_id) AS n_users, max(event_id) AS last_event,
       CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS first_day FROM events""")
def whole_table_totals(t):
    return agg.total(t.events, {
        "n_events": F.count(F.lit(1)), "n_users": agg.distinct_count("user_id"), "last_event": F.max("event_id"),
        "first_day": F.min(F.col("ts").cast("date"))})


@query("""
SELECT o_custkey, arg_min(o_orderkey, o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 12, '0')) AS first_order
FROM orders GROUP BY o_custkey""")
def first_order_per_customer(t):
    return agg.group_agg(t.orders, "o_custkey", {
        "first_order": agg.pick_first(F.col("o_orderkey"), F.struct("o_orderdate", "o_orderkey"))})


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_pairs(t):
    return t.orders.select("o_custkey", "o_orderstatus").distinct()
