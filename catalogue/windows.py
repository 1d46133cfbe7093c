"""Latest rows, fills, neighbours and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query
from tidemark.operators import windows as w


@query("""
SELECT event_id, user_id, event_type, CAST(epoch_us(ts) AS BIGINT) AS ts_us, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_event_per_user(t):
    newest = w.latest_per_key(t.events, "user_id", [F.desc("ts"), F.desc("event_id")])
    return newest.select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
                         "value")


@query("""
SELECT event_id, k, event_type, value FROM (
  SELECT *, CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS k FROM events)
QUALIFY row_number() OVER (PARTITION BY k, event_type ORDER BY value, event_id) = 1""")
def dedup_events(t):
    keyed = t.events.withColumn("k", F.when(F.col("user_id") % 10 != 0, F.col("user_id")))
    return w.deduplicate(keyed, ["k", "event_type"], ["value", "event_id"]).select("event_id", "k", "event_type", "value")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM (
  SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_quantity DESC, l_partkey, l_suppkey, l_linenumber) <= 3""")
def top_lines_per_order(t):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    return w.latest_per_key(t.lineitem.select(*columns).distinct(), "l_orderkey",
                            [F.desc("l_quantity"), "l_partkey", "l_suppkey", "l_linenumber"], rows=3)


PURCHASES = """
WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'purchase' THEN value END AS amount FROM events)
"""


def _purchases(t):
    return t.events.select("user_id", "event_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"))


@query(PURCHASES + """
SELECT user_id, event_id, amount,
       last_value(amount IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM e""")
def forward_fill_events(t):
    return w.forward_fill(_purchases(t), "user_id", "event_id", "amount", "filled")


@query(PURCHASES + """
SELECT user_id, event_id, amount,
       first_value(amount IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_amount FROM e""")
def first_known_events(t):
    return w.first_known(_purchases(t), "user_id", "event_id", "amount", "first_amount")


@query("""
SELECT event_id, user_id, round(coalesce(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id), value), 4) AS change
FROM events""", name="change_from_previous")
def changes(t):
    changed = w.change_from_previous(t.events.select("event_id", "user_id", "value"), "user_id", "event_id", "value")
    return changed.select("event_id", "user_id", F.round("change", 4).alias("change"))


@query("""
SELECT event_id, user_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS next_type,
       lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_type FROM events""")
def neighbouring_events(t):
    by = F.col("event_id")
    scanned = w.ordered_scan(t.events.select("event_id", "user_id", "event_type"), "user_id", "event_id", [
        w.neighbour("next_type", "event_type", by, following=True),
        w.neighbour("previous_type", "event_type", by, following=False)])
    return scanned.drop("event_type")


@query("""
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rank_asc,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rank_desc FROM orders""", name="rank_both_ways")
def ranks(t):
    return w.rank_both_ways(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey")


@query("""
SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place,
       lag(event_id) OVER (ORDER BY ts, event_id) AS event_before FROM events""")
def whole_table_sequence(t):
    by = F.struct("ts", "event_id")
    scanned = w.ordered_scan(t.events.select("event_id", "ts"), None, ["ts", "event_id"], [
        w.place("place"), w.neighbour("event_before", "event_id", by, following=False)])
    return scanned.drop("ts")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity) AS quantity_rank FROM lineitem""")
def dense_ranks(t):
    source = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return w.dense_rank_within(source, "l_orderkey", "l_quantity", "quantity_rank")


@query("""
SELECT p_partkey, p_type, p_retailprice FROM part
QUALIFY rank() OVER (PARTITION BY p_type ORDER BY abs(CAST(p_retailprice AS DECIMAL(18,2)) - 1000)) = 1""")
def closest_to_price(t):
    distance = F.abs(F.col("p_retailprice").cast("decimal(18,2)") - F.lit(1000))
    return w.closest_by(t.part.select("p_partkey", "p_type", "p_retailprice"), "p_type", distance)


@query("""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""")
def top_orders(t):
    return w.top_n(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 25)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, o_orderstatus
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""")
def heavy_key_join(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = t.orders.filter(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    return lines.join(orders, "l_orderkey", "left")  # adaptive execution splits what a heavy key makes too large


@query("""
SELECT l_suppkey, l_returnflag, user_id % 5 AS kind, count(*) AS n, count(DISTINCT l_partkey) AS n_parts
FROM lineitem JOIN (SELECT DISTINCT user_id, event_type FROM events) ON l_suppkey = user_id GROUP BY 1, 2, 3""")
def heavy_key_join_to_many(t):
    lines = t.lineitem.select(F.col("l_suppkey").alias("user_id"), "l_partkey", "l_returnflag")
    kinds = t.events.select("user_id", "event_type").distinct()
    return lines.join(kinds, "user_id").groupBy(
        F.col("user_id").alias("l_suppkey"), "l_returnflag", (F.col("user_id") % 5).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_partkey").alias("n_parts"))


# The same operators with keys cut into small pieces, over NULL, equal and far-off order values.
UNEVEN = """
WITH e AS (SELECT event_id, user_id % 3 AS k, CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id = 5 THEN -1000000000 ELSE event_id // 4 END AS t,
                  CASE WHEN event_type = 'purchase' THEN value END AS amount FROM events)
"""
PIECE = 50


def _uneven(t):
    moment = F.when(F.col("event_id") % 97 == 0, None).when(F.col("event_id") == 5, -1000000000).otherwise(F.floor(F.col("event_id") / 4))
    return t.events.select("event_id", (F.col("user_id") % 3).alias("k"), moment.cast("bigint").alias("t"),
                           F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"))


@query(UNEVEN + """
SELECT event_id, k, last_value(amount IGNORE NULLS) OVER w AS filled, first_value(amount IGNORE NULLS) OVER w AS first_amount,
       lag(amount) OVER s AS before, lead(amount) OVER s AS after FROM e
WINDOW w AS (PARTITION BY k ORDER BY t NULLS FIRST, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       s AS (PARTITION BY k ORDER BY t NULLS FIRST, event_id)""")
def fills_cut(t):
    by = F.struct("t", "event_id")
    scanned = w.ordered_scan(_uneven(t), "k", ["t", "event_id"], [
        w.filled("filled", "amount", by), w.first_seen("first_amount", "amount", by),
        w.neighbour("before", "amount", by, following=False), w.neighbour("after", "amount", by, following=True)], rows_per_piece=PIECE)
    return scanned.drop("t", "amount")


@query(UNEVEN + """
SELECT event_id, row_number() OVER (PARTITION BY k ORDER BY t NULLS FIRST, event_id) AS up,
       count(*) OVER (PARTITION BY k) - row_number() OVER (PARTITION BY k ORDER BY t NULLS FIRST, event_id) + 1 AS down FROM e""")
def rank_both_ways_cut(t):
    ranked = w.rank_both_ways(_uneven(t), "k", ["t", "event_id"], "up", "down", rows_per_piece=PIECE)
    return ranked.select("event_id", "up", "down")


@query(UNEVEN + "SELECT event_id, dense_rank() OVER (PARTITION BY k ORDER BY t NULLS FIRST) AS place FROM e")
def dense_ranks_cut(t):
    return w.dense_rank_within(_uneven(t), "k", "t", "place", rows_per_piece=PIECE).select("event_id", "place")


@query("""
SELECT event_id, row_number() OVER (ORDER BY event_type, event_id) AS place, lag(event_id) OVER (ORDER BY event_type, event_id) AS event_before FROM events""")
def whole_table_sequence_cut(t):
    scanned = w.ordered_scan(t.events.select("event_id", "event_type"), None, ["event_type", "event_id"], [
        w.place("place"), w.neighbour("event_before", "event_id", F.struct("event_type", "event_id"), following=False)], rows_per_piece=PIECE)
    return scanned.drop("event_type")


# Heavy keys whose order values are texts of one long prefix, or agree in all leading columns.
LINKED = """
WITH e AS (SELECT event_id, user_id % 3 AS k, 'https://example.org/events/' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS link,
                  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS moment, CASE WHEN event_type = 'purchase' THEN value END AS amount FROM events)
"""


def _linked(t):
    link = F.concat(F.lit("https://example.org/events/"), F.lpad(F.col("event_id").cast("string"), 9, "0"))
    return t.events.select("event_id", (F.col("user_id") % 3).alias("k"), link.alias("link"),
                           F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("moment"), F.lit("all").alias("same"),
                           F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"))


@query(LINKED + """
SELECT event_id, row_number() OVER s AS up, count(*) OVER (PARTITION BY k) - row_number() OVER s + 1 AS down, lag(event_id) OVER s AS before,
       lead(event_id) OVER s AS after, last_value(amount IGNORE NULLS) OVER w AS filled, first_value(amount IGNORE NULLS) OVER w AS first_amount
FROM e WINDOW s AS (PARTITION BY k ORDER BY link),
              w AS (PARTITION BY k ORDER BY link ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def links_in_order_cut(t):
    by = F.struct("link")
    scanned = w.ordered_scan(_linked(t), "k", "link", [
        w.place("up"), w.place("down", descending=True), w.neighbour("before", "event_id", by, following=False),
        w.neighbour("after", "event_id", by, following=True), w.filled("filled", "amount", by),
        w.first_seen("first_amount", "amount", by)], rows_per_piece=PIECE)
    return scanned.select("event_id", "up", "down", "before", "after", "filled", "first_amount")


@query(LINKED + """
SELECT event_id, row_number() OVER (PARTITION BY k ORDER BY moment, event_id) AS up, lag(moment) OVER (PARTITION BY k ORDER BY moment, event_id) AS moment_before,
       last_value(amount IGNORE NULLS) OVER (PARTITION BY k ORDER BY moment, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM e""")
def equal_leads_cut(t):
    order = ["same", "moment", "event_id"]
    by = F.struct(*order)
    scanned = w.ordered_scan(_linked(t), "k", order, [
        w.place("up"), w.neighbour("moment_before", "moment", by, following=False), w.filled("filled", "amount", by)], rows_per_piece=PIECE)
    return scanned.select("event_id", "up", "moment_before", "filled")


@query(LINKED + "SELECT event_id, dense_rank() OVER (PARTITION BY k ORDER BY substr(moment, 1, 13)) AS place FROM e")
def dense_ranks_of_texts_cut(t):
    rows = _linked(t).withColumn("hour", F.substring("moment", 1, 13))
    return w.dense_rank_within(rows, "k", ["same", "hour"], "place", rows_per_piece=PIECE).select("event_id", "place")


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS place,
       lead(o_orderkey) OVER (ORDER BY o_orderpriority, strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS after FROM orders""")
def whole_table_of_texts_cut(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    order = ["o_orderpriority", "day", "o_orderkey"]
    scanned = w.ordered_scan(rows, None, order, [
        w.place("place"), w.neighbour("after", "o_orderkey", F.struct(*order), following=True)], rows_per_piece=500)
    return scanned.select("o_orderkey", "place", "after")
