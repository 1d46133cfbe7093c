"""Data-quality checks: the failing rows of each."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query
from tidemark.operators import checks as c
from tidemark.operators import suite

NOW = "2024-01-31 00:00:00"


@query("SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1")
def check_unique(t):
    return c.unique(t.orders, "o_custkey")


@query("SELECT event_id FROM events WHERE nullif(event_type, 'error') IS NULL")
def check_not_null(t):
    source = t.events.select("event_id", F.nullif("event_type", F.lit("error")).alias("kind"))
    return c.not_null(source, "kind").select("event_id")


@query("SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') GROUP BY 1")
def check_accepted_values(t):
    return c.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "5-LOW"])


@query("SELECT DISTINCT o_orderpriority AS value_field FROM orders WHERE o_orderpriority IN ('2-HIGH', '5-LOW', '9-NONE')")
def check_not_accepted_values(t):
    return c.not_accepted_values(t.orders, "o_orderpriority", ["2-HIGH", "5-LOW", "9-NONE"])


@query("""
SELECT l_suppkey AS id, count(*) AS n_records FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
GROUP BY 1""")
def check_relationships(t):
    return c.relationships(t.lineitem, "l_suppkey", t.supplier.filter("s_acctbal > 0"), "s_suppkey")


@query("""
SELECT l_orderkey AS id, count(*) AS n_records FROM lineitem
WHERE l_returnflag = 'R' AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""")
def check_relationships_where(t):
    return c.relationships_where(t.lineitem, "l_orderkey", t.orders, "o_orderkey", "l_returnflag = 'R'", "o_orderstatus <> 'P'")


@query("SELECT p_partkey, p_size FROM part WHERE nullif(p_size, 50) <= 2 OR nullif(p_size, 50) >= 45")
def check_accepted_range(t):
    source = t.part.select("p_partkey", "p_size")
    return c.accepted_range(source, F.nullif("p_size", F.lit(50)), 2, 45, inclusive=False)


@query("""
SELECT user_id, count(CASE WHEN event_type = 'purchase' AND value > 60 THEN value END) AS n_known FROM events
GROUP BY user_id HAVING count(CASE WHEN event_type = 'purchase' AND value > 60 THEN value END) = 0""")
def check_at_least_one(t):
    big = F.when((F.col("event_type") == "purchase") & (F.col("value") > 60), F.col("value"))
    return c.at_least_one(t.events.select("user_id", big.alias("big_purchase")), "big_purchase", "user_id")


@query("""
WITH a AS (SELECT c_nationkey AS v, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1),
b AS (SELECT s_nationkey AS v, count(*) AS n FROM supplier WHERE s_acctbal > 0 GROUP BY 1)
SELECT v AS value_field, n AS num_rows, 'a_minus_b' AS which_diff FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT v, n, 'b_minus_a' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def check_cardinality_equality(t):
    return c.cardinality_equality(t.customer.filter("c_mktsegment = 'BUILDING'"), "c_nationkey",
                                  t.supplier.filter("s_acctbal > 0"), "s_nationkey")


@query("""
SELECT a.k AS k_a, b.k AS k_b, count_a, count_b, abs(count_a - count_b) AS diff_count FROM
(SELECT o_custkey AS k, count(*) AS count_a FROM orders GROUP BY 1) a FULL JOIN
(SELECT user_id AS k, count(*) AS count_b FROM events GROUP BY 1) b ON a.k = b.k WHERE abs(count_a - count_b) > 0""")
def check_equal_rowcount(t):
    return c.equal_rowcount(t.orders.withColumnRenamed("o_custkey", "k"), t.events.withColumnRenamed("user_id", "k"), "k")


@query("""
SELECT a.k AS k_a, b.k AS k_b, count_a, count_b, abs(coalesce(count_a, 0) - coalesce(count_b, 0)) AS diff_count FROM
(SELECT o_custkey AS k, count(*) AS count_a FROM orders GROUP BY 1) a FULL JOIN
(SELECT user_id AS k, count(*) AS count_b FROM events GROUP BY 1) b ON a.k = b.k
WHERE coalesce(count_a, 0) <> coalesce(count_b, 0)""")
def check_equal_rowcount_strict(t):
    return c.equal_rowcount(t.orders.withColumnRenamed("o_custkey", "k"), t.events.withColumnRenamed("user_id", "k"), "k",
                            strict=True)


@query("""
SELECT a.k AS k_a, b.k AS k_b, n AS count_our_model, m AS count_comparison_model,
       CASE WHEN n > m THEN n - m ELSE 1 END AS row_count_delta FROM
(SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1) a FULL JOIN
(SELECT c_nationkey AS k, count(*) AS m FROM customer WHERE c_mktsegment = 'MACHINERY' GROUP BY 1) b ON a.k = b.k WHERE n >= m""")
def check_fewer_rows_than(t):
    keyed = t.customer.withColumnRenamed("c_nationkey", "k")
    return c.fewer_rows_than(keyed.filter("c_mktsegment = 'BUILDING'"), keyed.filter("c_mktsegment = 'MACHINERY'"), "k")


@query("""
SELECT (SELECT count(*) FROM events) AS count_our_model, (SELECT count(*) FROM customer) AS count_comparison_model,
       (SELECT count(*) FROM events) - (SELECT count(*) FROM customer) AS row_count_delta""")
def check_fewer_rows_whole_table(t):
    return c.fewer_rows_than(t.events, t.customer)


@query("""
WITH a AS (SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_quantity > 10),
b AS (SELECT l_orderkey, l_partkey, CASE WHEN l_tax = 0.08 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem WHERE l_quantity < 40)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def check_equality(t):
    ours = t.lineitem.filter("l_quantity > 10")
    theirs = t.lineitem.filter("l_quantity < 40").withColumn(
        "l_returnflag", F.when(F.col("l_tax") == 0.08, F.lit(None)).otherwise(F.col("l_returnflag")))
    return c.equality(ours, theirs, ["l_orderkey", "l_partkey", "l_returnflag"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND NOT (nullif(o_totalprice, 0) > 50000)")
def check_expression_is_true(t):
    source = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return c.expression_is_true(source, "> 50000", column="o_totalprice", where="o_orderstatus = 'F'").drop("o_orderstatus")


#: Each distinct range meets all ranges that start after it (or end later); of equal ranges all but one are followed by their like.
FOLLOWED_SQL = """
followed AS (SELECT a.p, a.lo, a.hi, a.n, min(b.lo) AS after FROM spans a LEFT JOIN spans b ON a.p = b.p AND (b.lo > a.lo OR b.lo = a.lo AND b.hi > a.hi)
             GROUP BY ALL),
met AS (SELECT p, lo, hi, after, 1 AS n FROM followed UNION ALL SELECT p, lo, hi, lo, n - 1 FROM followed WHERE n > 1)
"""


@query(f"""
WITH spans AS (SELECT o_custkey AS p, CAST(o_orderdate AS DATE) AS lo, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 300 AS INTEGER) AS hi, count(*) AS n
               FROM orders GROUP BY ALL), {FOLLOWED_SQL}
SELECT p AS partition_by_col, CAST(lo AS VARCHAR) AS lower_bound, CAST(hi AS VARCHAR) AS upper_bound, CAST(after AS VARCHAR) AS next_lower_bound,
       after IS NULL AS is_last_record, CAST(sum(n) AS BIGINT) AS n_records, lo < hi AS lower_bound_less_than_upper_bound,
       after IS NULL OR hi <= after AS upper_bound_less_than_or_equal_to_next_lower_bound
FROM met WHERE lo >= hi OR hi > after GROUP BY p, lo, hi, after""")
def check_mutually_exclusive_ranges(t):
    start = F.col("o_orderdate").cast("date")
    return c.mutually_exclusive_ranges(t.orders, start, F.date_add(start, (F.col("o_orderkey") % 300).cast("int")),
                                       partition_by="o_custkey")


@query(f"""
WITH spans AS (SELECT o_custkey % 2 AS p, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS lo, strftime(o_orderdate + INTERVAL 1 HOUR * CAST(o_orderkey % 30 AS INTEGER), '%Y-%m-%dT%H:%M:%S') AS hi,
                      count(*) AS n FROM orders GROUP BY ALL),
ordered AS (SELECT *, lead(lo) OVER (PARTITION BY p ORDER BY lo, hi) AS after FROM spans),
met AS (SELECT p, lo, hi, after, 1 AS n FROM ordered UNION ALL SELECT p, lo, hi, lo, n - 1 FROM ordered WHERE n > 1)
SELECT p AS partition_by_col, lo AS lower_bound, hi AS upper_bound, after AS next_lower_bound, after IS NULL AS is_last_record,
       CAST(sum(n) AS BIGINT) AS n_records, lo < hi AS lower_bound_less_than_upper_bound,
       after IS NULL OR hi <= after AS upper_bound_less_than_or_equal_to_next_lower_bound
FROM met WHERE lo >= hi OR hi > after GROUP BY p, lo, hi, after""")
def check_ranges_of_texts_cut(t):
    """Bounds that are times as text, with many equal lower bounds, in two heavy partitions."""
    text = "yyyy-MM-dd'T'HH:mm:ss"
    end = F.timestamp_seconds(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + 3600 * (F.col("o_orderkey") % 30))
    return c.mutually_exclusive_ranges(t.orders, F.date_format("o_orderdate", text), F.date_format(end, text),
                                       partition_by=F.col("o_custkey") % 2, rows_per_piece=200)


@query(f"""
WITH spans AS (SELECT 0 AS p, p_partkey AS lo, p_partkey + CASE WHEN p_size < 3 THEN 2 WHEN p_size > 48 THEN 0 ELSE 1 END AS hi, count(*) AS n
               FROM part GROUP BY ALL), {FOLLOWED_SQL}
SELECT lo AS lower_bound, hi AS upper_bound, after AS next_lower_bound, after IS NULL AS is_last_record, CAST(sum(n) AS BIGINT) AS n_records,
       lo <= hi AS lower_bound_less_than_or_equal_to_upper_bound, after IS NULL OR hi = after AS upper_bound_equal_to_next_lower_bound
FROM met WHERE lo > hi OR hi <> after GROUP BY p, lo, hi, after""")
def check_ranges_without_gaps(t):
    width = F.when(F.col("p_size") < 3, 2).when(F.col("p_size") > 48, 0).otherwise(1)
    return c.mutually_exclusive_ranges(t.part, "p_partkey", F.col("p_partkey") + width, gaps="not_allowed", zero_length=True)


@query("""
SELECT user_id, count(DISTINCT event_type) AS n_distinct FROM events WHERE value > 60 AND event_type IN ('view', 'click') GROUP BY user_id
HAVING count(DISTINCT event_type) = 1""")
def check_not_constant(t):
    return c.not_constant(t.events.filter("value > 60 AND event_type IN ('view', 'click')"), "event_type", "user_id")


@query("SELECT doc_id FROM documents WHERE trim(CASE WHEN n_chars < 100 THEN '  ' ELSE text END) = ''")
def check_not_empty_string(t):
    source = t.documents.select("doc_id", F.when(F.col("n_chars") < 100, "  ").otherwise(F.col("text")).alias("body"))
    return c.not_empty_string(source, "body").select("doc_id")


@query("""
SELECT l_suppkey, round(count(nullif(l_tax, 0)) / count(*), 6) AS not_null_proportion FROM lineitem GROUP BY l_suppkey
HAVING count(nullif(l_tax, 0)) / count(*) < 0.88 OR count(nullif(l_tax, 0)) / count(*) > 0.9""")
def check_not_null_proportion(t):
    source = t.lineitem.select("l_suppkey", F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    failing = c.not_null_proportion(source, "tax", 0.88, 0.9, "l_suppkey")
    return failing.withColumn("not_null_proportion", F.round("not_null_proportion", 6))


@query("""
SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS most_recent, '2024-01-30 12:00:00' AS threshold FROM events GROUP BY user_id
HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'""")
def check_recency(t):
    return c.recency(t.events, "ts", "hour", 12, NOW, group_by="user_id")


@query("""
SELECT o_custkey, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS most_recent, '2001-05-01' AS threshold FROM orders GROUP BY o_custkey
HAVING CAST(max(o_orderdate) AS DATE) < DATE '2001-05-01'""")
def check_recency_by_day(t):
    return c.recency(t.orders, "o_orderdate", "quarter", 1, "2001-08-01 09:30:00", ignore_time=True, group_by="o_custkey")


@query("""
WITH w AS (SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders)
SELECT o_custkey, o_orderkey, p AS previous_o_orderkey, count(*) AS n_records FROM w WHERE NOT (o_orderkey = p + 1500) GROUP BY ALL""")
def check_sequential_values(t):
    return c.sequential_values(t.orders, "o_orderkey", 1500, group_by="o_custkey")


@query("""
WITH w AS (SELECT l_suppkey, l_shipdate, lag(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS p FROM lineitem)
SELECT l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, strftime(p, '%Y-%m-%d %H:%M:%S') AS previous_l_shipdate, count(*) AS n_records
FROM w WHERE l_shipdate <> p + INTERVAL 1 DAY GROUP BY ALL""")
def check_sequential_values_cut(t):
    return c.sequential_values(t.lineitem, "l_shipdate", 1, "day", "l_suppkey", rows_per_piece=40)


@query("""
WITH w AS (SELECT l_quantity, lag(l_quantity) OVER (ORDER BY l_quantity) AS p FROM lineitem)
SELECT l_quantity, p AS previous_l_quantity, count(*) AS n_records FROM w WHERE NOT (l_quantity = p + 1) GROUP BY ALL""")
def check_sequential_whole_table(t):
    return c.sequential_values(t.lineitem, "l_quantity", 1)


@query("""
WITH h AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS h FROM events),
w AS (SELECT user_id, h, lag(h) OVER (PARTITION BY user_id ORDER BY h) AS p FROM h)
SELECT user_id, strftime(h, '%Y-%m-%d %H:%M:%S') AS h, strftime(p, '%Y-%m-%d %H:%M:%S') AS previous_h, count(*) AS n_records
FROM w WHERE h <> p + INTERVAL 2 HOUR GROUP BY ALL""")
def check_sequential_hours(t):
    hours = t.events.select("user_id", F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("h")).distinct()
    return c.sequential_values(hours, "h", 2, "hour", "user_id")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique_combination(t):
    return c.unique_combination_of_columns(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
SELECT column_name, problem, n_rows FROM (VALUES ('p_retailprice', 'not_expected'), ('p_weight', 'not_found')) v(column_name, problem),
(SELECT count(*) AS n_rows FROM part)""")
def check_columns_match_set(t):
    wrong = c.columns_match_set(t.part, ["P_PARTKEY", "p_name", "p_brand", "p_type", "p_size", "p_weight"])
    return wrong.withColumn("n_rows", t.part.agg(F.count(F.lit(1))).scalar())


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey <> CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 50 END")
def check_assert_equal(t):
    source = t.orders.select("o_orderkey", "o_custkey",
                             F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 50).alias("expected"))
    return c.assert_equal(source, "o_custkey", "expected").drop("expected")


SUITE_SQL = """
WITH t AS (SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lineitem),
by_flag AS (SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_tax) AS low, max(l_tax) AS high, count(CASE WHEN l_tax > 0.01 THEN 1 END) AS known,
                   max(l_shipdate) AS last FROM t GROUP BY ALL)
SELECT 'not_null l_shipdate' AS "check", CAST(NULL AS VARCHAR) AS key, count(*) AS n_records FROM t WHERE l_shipdate IS NULL HAVING count(*) > 0
UNION ALL SELECT 'quantity', NULL, count(*) FROM t WHERE NOT (l_quantity >= 2 AND l_quantity <= 49) HAVING count(*) > 0
UNION ALL SELECT 'price covers discount', NULL, count(*) FROM t WHERE NOT (l_extendedprice * (1 - l_discount) > 30000) HAVING count(*) > 0
UNION ALL SELECT 'not_empty_string l_linestatus', NULL, count(*) FROM t WHERE trim(l_linestatus) = '' HAVING count(*) > 0
UNION ALL SELECT 'number is quantity', NULL, count(*) FROM t WHERE l_linenumber <> q HAVING count(*) > 0
UNION ALL SELECT 'unique l_orderkey', CAST(l_orderkey AS VARCHAR), count(*) FROM t GROUP BY l_orderkey HAVING count(*) > 1
UNION ALL SELECT 'one line', l_orderkey || ', ' || l_linenumber, count(*) FROM t GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'accepted_values l_returnflag', l_returnflag, count(*) FROM t GROUP BY 2 HAVING l_returnflag NOT IN ('A', 'R')
UNION ALL SELECT 'not_accepted_values l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM t WHERE l_linenumber IN (6, 7) GROUP BY 2
UNION ALL SELECT 'at_least_one taxed', l_returnflag || ', ' || l_linestatus, n FROM by_flag WHERE known = 0
UNION ALL SELECT 'not_constant l_tax', l_returnflag || ', ' || l_linestatus, n FROM by_flag WHERE low = high
UNION ALL SELECT 'share taxed', l_returnflag || ', ' || l_linestatus, n FROM by_flag WHERE known / n < 0.89 OR known / n > 1
UNION ALL SELECT 'recency l_shipdate', l_returnflag || ', ' || l_linestatus, n FROM by_flag WHERE last < TIMESTAMP '2001-08-28' - INTERVAL 1 DAY
"""


@query(SUITE_SQL)
def check_suite(t):
    """Thirteen checks in one scan."""
    lines = t.lineitem.withColumn("taxed", F.when(F.col("l_tax") > 0.01, F.col("l_tax")))
    by = ["l_returnflag", "l_linestatus"]
    return suite.run_suite(lines, [
        suite.not_null("l_shipdate"), suite.accepted_range("l_quantity", 2, 49, name="quantity"),
        suite.expression_is_true("l_extendedprice * (1 - l_discount) > 30000", name="price covers discount"),
        suite.not_empty_string("l_linestatus"), suite.assert_equal("l_linenumber", F.col("l_quantity").cast("int"), name="number is quantity"),
        suite.unique("l_orderkey"), suite.unique_combination_of_columns(["l_orderkey", "l_linenumber"], name="one line"),
        suite.accepted_values("l_returnflag", ["A", "R"]), suite.not_accepted_values("l_linenumber", [6, 7]),
        suite.at_least_one("taxed", by), suite.not_constant("l_tax", by), suite.not_null_proportion("taxed", 0.89, group_by=by, name="share taxed"),
        suite.recency("l_shipdate", "day", 1, "2001-08-28", group_by=by)])


@query("""
WITH b AS (SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_orderkey = 7 THEN NULL WHEN l_orderkey % 1000 = 3 THEN l_tax + 1 ELSE l_tax END AS l_tax
           FROM lineitem WHERE l_orderkey <> 11)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT l_orderkey, l_linenumber, l_returnflag, l_tax FROM lineitem EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT l_orderkey, l_linenumber, l_returnflag, l_tax FROM lineitem)""")
def check_equality_by_digest(t):
    key, tax = F.col("l_orderkey"), F.col("l_tax")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_tax")
    changed = lines.filter(key != 11).withColumn("l_tax", F.when(key == 7, None).when(key % 1000 == 3, tax + 1).otherwise(tax))
    return suite.equality_by_digest(lines, changed, ranges=256)
