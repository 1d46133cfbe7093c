"""Pivots, unpivots, unions and value lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query
from tidemark.functions.calendar import month_key
from tidemark.operators import reshape as r
from tidemark.operators.spines import months_list

MONTHS = months_list(1996, 11, 1997, 4)
STATUSES = ["F", "O", "P"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _month_sums(alias: str) -> str:
    return ",\n".join(
        f"CAST(sum(CASE WHEN strftime(o_orderdate, '%Y-%m') = '{m}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) "
        f'AS "{alias}{m}"' for m in MONTHS)


@query(f"SELECT o_custkey, {_month_sums('price_')} FROM orders GROUP BY o_custkey", name="pivot_periods")
def pivot_by_month(t):
    wide = r.pivot_periods(t.orders, "o_custkey", month_key("o_orderdate"), F.col("o_totalprice").cast("decimal(18,2)"),
                           MONTHS, alias="price")
    return wide.select("o_custkey", *[F.col(f"`price_{m}`").cast("double").alias(f"price_{m}") for m in MONTHS])


@query("SELECT user_id, " + ", ".join(
    f"CAST(sum(CASE WHEN event_type = '{e}' THEN 1 ELSE 0 END) AS BIGINT) AS \"n_{e}_events\"" for e in EVENT_TYPES)
    + ", " + ", ".join(f"count(DISTINCT CASE WHEN event_type <> '{e}' THEN event_id % 50 ELSE -1 END) AS \"not_{e}\""
                       for e in EVENT_TYPES) + " FROM events GROUP BY user_id")
def pivot_cols_events(t):
    types = EVENT_TYPES  # the columns of a pivot are given, not looked up
    counts = r.pivot_cols("event_type", types, prefix="n_", suffix="_events")
    others = r.pivot_cols("event_type", types, agg="count", cmp="<>", prefix="Not ", distinct=True,
                          then_value=F.col("event_id") % 50, else_value=-1, quote=False)
    return t.events.groupBy("user_id").agg(*counts, *others)


@query("""
SELECT 'customer' AS "_dbt_source_relation", CAST(c_custkey AS BIGINT) AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation,
       c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer WHERE c_name LIKE '%1%'
UNION ALL
SELECT 'supplier', CAST(s_suppkey AS BIGINT), s_name, CAST(s_nationkey AS BIGINT), NULL, s_acctbal FROM supplier WHERE s_name LIKE '%1%'""")
def union_aligned_parties(t):
    customers = t.customer.selectExpr("c_custkey AS id", "c_name AS name", "c_nationkey AS nation",
                                      "c_mktsegment AS segment", "c_acctbal AS left_out")
    suppliers = t.supplier.selectExpr("s_suppkey AS ID", "s_name AS name", "s_nationkey AS nation", "s_acctbal AS balance")
    return r.union_aligned({"customer": customers, "supplier": suppliers}, exclude=["LEFT_OUT"],
                           overrides={"nation": "bigint"}, where="name LIKE '%1%'")


@query("""
SELECT p_partkey, field_name, value FROM (
  SELECT p_partkey, 'p_brand' AS field_name, p_brand AS value FROM part
  UNION ALL SELECT p_partkey, 'p_type', nullif(p_type, 'PROMO') FROM part
  UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, 'is_large', CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END FROM part)""")
def unpivot_part(t):
    source = t.part.select("p_partkey", "p_name", "p_retailprice", "p_brand",
                           F.nullif("p_type", F.lit("PROMO")).alias("p_type"), "p_size",
                           (F.col("p_size") > 25).alias("is_large"))
    return r.unpivot(source, "string", exclude=["P_PARTKEY"], remove=["p_name", "p_retailprice"])


@query("""
SELECT o_orderkey, slot, name, amount FROM (
  SELECT o_orderkey, 0 AS slot, nullif(o_orderstatus, 'P') AS name, o_totalprice AS amount FROM orders
  UNION ALL SELECT o_orderkey, 1, nullif(o_orderpriority, '5-LOW'), o_totalprice / 2 FROM orders) WHERE name IS NOT NULL""")
def slots_as_rows(t):
    wide = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("name_0"),
                           F.col("o_totalprice").alias("amount_0"),
                           F.nullif("o_orderpriority", F.lit("5-LOW")).alias("name_1"),
                           (F.col("o_totalprice") / 2).alias("amount_1"))
    slots = [{"name": f"name_{n}", "amount": f"amount_{n}"} for n in (0, 1)]
    return r.slots_to_rows(wide, ["o_orderkey"], slots, "name", "slot")


@query("""
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def customers_without_urgent_order(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return r.except_distinct(t.customer.select("c_custkey"), urgent)


@query("""
SELECT event_type AS id, count(*) AS n FROM (
  SELECT event_type FROM events UNION ALL SELECT o_orderstatus FROM orders) GROUP BY 1""")
def union_all_rows(t):
    return t.events.select("event_type").unionAll(t.orders.select("o_orderstatus")).groupBy(
        F.col("event_type").alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT p_brand AS value, count(*) AS n_records FROM part WHERE p_size > 10
GROUP BY p_brand ORDER BY n_records DESC, value LIMIT 10""", name="column_values")
def brand_values(t):
    return r.column_values(t.part, "p_brand", max_records=10, where="p_size > 10")


@query("""
SELECT o_orderstatus, count(*) AS n_orders, (SELECT max(o_totalprice) FROM orders) AS highest FROM orders GROUP BY 1""")
def single_values(t):
    counted = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    return counted.withColumn("highest", t.orders.agg(F.max("o_totalprice")).scalar())
