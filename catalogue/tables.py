"""Landed files, raw, snapshot and history tables, flattening and tables found by name."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from catalogue.base import query, work_folder
from tidemark.functions.documents import project_json
from tidemark.operators import spines
from tidemark.operators.checks import unique
from tidemark.sources import catalog, files, intervals, kept_schema
from tidemark.sources import lifecycle as life
from tidemark.streaming.landing import land_new_files, land_rejects

DAY_1, DAY_2 = dt.datetime(2024, 1, 30, 12, 0), dt.datetime(2024, 1, 31, 5, 0)


def _new_database(spark, label):
    """A database for one run, so that no run meets the tables of another."""
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_folder(spark, label)}'")
    return name


def _event_documents(t):
    """Events as JSON text."""
    body = F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("object"),
                    F.col("user_id").alias("user"), F.col("value"))
    return t.events.select("value", F.to_json(body).alias("json_data"))


def _land(df, label):
    folder = work_folder(df.sparkSession, label)
    df.write.text(folder)
    return folder


@query("""
SELECT '20240130' AS run_day, event_type AS object, count(*) AS n, min(CAST(event_id AS VARCHAR)) AS first_id FROM events GROUP BY 2
UNION ALL
SELECT '20240131', event_type, count(*), min(CAST(event_id AS VARCHAR)) FROM events WHERE value > 20 GROUP BY 2""")
def bronze_roundtrip(t):
    documents = _event_documents(t)
    first = files.load_json_lines(t.spark, _land(documents.select("json_data"), "json"))
    table = work_folder(t.spark, "bronze")
    second = documents.filter("value > 20").select("json_data")
    # The second run of a day adds nothing, whatever it brings.
    runs = [life.append_bronze(first, table, DAY_1), life.append_bronze(second, table, DAY_1),
            life.append_bronze(second, table, DAY_2)]
    if runs != [True, False, True]:
        raise AssertionError(f"unexpected runs {runs}")
    return t.spark.read.parquet(table).groupBy(F.col("run_day").cast("string").alias("run_day"), "object").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@query("""
SELECT o_custkey, count(*) AS n_orders, '20240131050000' AS run_date FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey""")
def snapshot_replace(t):
    table = work_folder(t.spark, "snapshot")
    for as_of, kind in ((DAY_1, "F"), (DAY_2, "O")):
        life.write_snapshot(t.orders.filter(F.col("o_orderstatus") == kind), table, ["o_orderkey", "o_custkey"], as_of)
    return life.read_snapshot(t.spark, table).groupBy("o_custkey", "run_date").agg(F.count(F.lit(1)).alias("n_orders"))


@query("""
SELECT '20240131' AS run_day, l_linestatus, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2""")
def history_append(t):
    table = work_folder(t.spark, "history")
    for as_of, flag in ((DAY_1, "A"), (DAY_2, "R"), (DAY_2, "N")):  # the last run finds its day taken
        life.append_history(t.lineitem.filter(F.col("l_returnflag") == flag), table, ["l_orderkey", "l_linestatus"], as_of)
    newest = life.latest_snapshot(t.spark.read.parquet(table), life.RUN_DAY)
    return newest.groupBy(F.col("run_day").cast("string").alias("run_day"), "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH copies AS (
  SELECT '20240130' AS run_day, CASE o_orderstatus WHEN 'F' THEN 'O' ELSE o_orderstatus END AS o_orderstatus, o_custkey FROM orders
  UNION ALL SELECT '20240131', o_orderstatus, o_custkey FROM orders
  UNION ALL SELECT '20240201', o_orderstatus, o_custkey FROM orders WHERE o_orderstatus <> 'F')
SELECT run_day, o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS n_customers, CAST(sum(o_custkey) AS BIGINT) AS total FROM copies GROUP BY 1, 2""")
def history_as_intervals(t):
    """Three daily copies: orders before any was finished, then with their status, then without the finished ones."""
    table, status = work_folder(t.spark, "intervals"), F.col("o_orderstatus")
    days = [DAY_1, DAY_2, DAY_2 + dt.timedelta(days=1)]
    columns = ["o_custkey", "o_orderstatus"]  # many rows are equal
    for as_of, copy in zip(days, (t.orders.withColumn("o_orderstatus", F.when(status == "F", "O").otherwise(status)), t.orders, t.orders.filter(status != "F")), strict=True):
        intervals.append_intervals(copy, table, columns, as_of, buckets=16)
    return intervals.copies_on(t.spark, table, days).groupBy("run_day", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("n_customers"), F.sum("o_custkey").alias("total"))


def _dated(df, moment: str):
    return df.withColumn("run_date", F.date_format(moment, "yyyyMMddHHmmss"))


@query("""
SELECT event_id, user_id, strftime(ts, '%Y%m%d%H%M%S') AS run_date FROM events
WHERE strftime(ts, '%Y%m%d') = (SELECT max(strftime(ts, '%Y%m%d')) FROM events)""", name="latest_snapshot")
def newest_event_day(t):
    return life.latest_snapshot(_dated(t.events, "ts")).select("event_id", "user_id", "run_date")


@query("""
SELECT l_orderkey, l_partkey, l_linenumber, strftime(l_shipdate, '%Y%m%d%H%M%S') AS run_date FROM lineitem
WHERE day(l_shipdate) = 1 AND l_shipdate BETWEEN TIMESTAMP '2000-02-01' AND TIMESTAMP '2001-08-15'""")
def month_start_copies(t):
    copies = _dated(t.lineitem, "l_shipdate").select("l_orderkey", "l_partkey", "l_linenumber", "run_date")
    return life.month_start_snapshots(copies, "2001-08-15", 18)


@query("""
SELECT l_suppkey, count(*) AS n, min(strftime(l_shipdate, '%Y%m%d%H%M%S')) AS first_copy FROM lineitem
WHERE day(l_shipdate) = 1 AND l_shipdate BETWEEN TIMESTAMP '2000-02-01' AND TIMESTAMP '2001-08-15' GROUP BY 1""")
def snapshots_on_days(t):
    days = spines.month_starts(t.spark, "2001-08-15", 18)
    copies = life.snapshots_on(_dated(t.lineitem, "l_shipdate"), days)
    return copies.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.min("run_date").alias("first_copy"))


@query("""
SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_loaded_at,
       round(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01 12:00:00') / 3600.0, 6) AS age_hours,
       CASE WHEN date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01 12:00:00') / 3600.0 <= 24 THEN 'pass' ELSE 'error' END AS status
FROM events""", name="freshness")
def event_freshness(t):
    return life.freshness(_dated(t.events, "ts"), "2024-02-01 12:00:00").withColumn("age_hours", F.round("age_hours", 6))


@query("""
SELECT doc_id, lang, source, n_chars, md5(text) AS text_hash FROM documents""")
def csv_load(t):
    folder = work_folder(t.spark, "csv")
    (t.documents.write.options(header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False,
                               ignoreTrailingWhiteSpace=False).csv(folder))
    loaded = files.load_csv(t.spark, folder, multi_line=True)
    return loaded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source",
                         F.col("n_chars").cast("bigint").alias("n_chars"), F.md5("text").alias("text_hash"))


@query("""
SELECT copy, doc_id, lang, md5(text) AS text_hash, CASE WHEN doc_id % 50 = 7 THEN 1 ELSE 0 END AS rejected
FROM documents, range(4) copies(copy)""")
def csv_in_blocks(t):
    """Files with quoted line breaks, read block by block; records that do not fit come from the folder of rejects.

    Each task writes the file of what it reads, for one file of all would be one task's work.
    """
    folder = work_folder(t.spark, "csv")
    doc = F.when(F.col("doc_id") % 50 == 7, F.concat(F.lit("no. "), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    copies = t.documents.select(F.explode(F.sequence(F.lit(0), F.lit(3))).alias("copy"), doc.alias("doc_id"), "lang", "text")
    (copies.write.options(header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False,
                          ignoreTrailingWhiteSpace=False).csv(folder))
    rejects = work_folder(t.spark, "rejects")
    rows = files.load_csv(t.spark, folder, "copy bigint, doc_id bigint, lang string, text string", max_bad=10**9, multi_line=True, rejects=rejects)
    again = F.from_csv("record", "copy BIGINT, doc_id STRING, lang STRING, text STRING", {"escape": '"'})
    bad = t.spark.read.parquet(rejects).select(again.alias("r")).select(
        "r.copy", F.replace("r.doc_id", F.lit("no. "), F.lit("")).cast("bigint").alias("doc_id"), "r.lang", "r.text")
    both = rows.withColumn("rejected", F.lit(0)).unionByName(bad.withColumn("rejected", F.lit(1)))
    return both.select("copy", "doc_id", "lang", F.md5("text").alias("text_hash"), "rejected")


@query("""
SELECT 'nations' AS name, count(*) AS n, CAST(max(n_nationkey) AS BIGINT) AS last_key FROM nation
UNION ALL SELECT 'sellers', count(*), max(s_suppkey) FROM supplier""")
def load_many_files(t):
    folder = work_folder(t.spark, "many")
    t.nation.write.option("header", True).csv(f"{folder}/nation.csv")
    t.supplier.write.option("header", True).csv(f"{folder}/supplier.csv")
    loaded = files.load_many(t.spark, {"nation.csv": "nations", "supplier.csv": "sellers", "supplier-2024.csv": "old"}, folder)
    keys = {"nations": "n_nationkey", "sellers": "s_suppkey"}
    return files.load_union([df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"),
                                    F.max(F.col(keys[name]).cast("bigint")).alias("last_key"))
                             for name, df in loaded.items()])


@query("""
SELECT o_orderstatus, o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS open_amount FROM orders
WHERE o_orderstatus IN ('O', 'F')""")
def union_of_pulls(t):
    done = t.orders.filter("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey")
    pending = t.orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("open_amount"))
    return files.load_union([done, pending])


def _order_documents(t):
    """Orders as nested documents; the items and their tags vary in number from row to row."""
    def item(n):
        tags = F.when(F.col("o_orderkey") % 2 == n, F.array(F.col("o_orderpriority"))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.col("o_totalprice").alias("amount"), (F.col("o_orderkey") + n).alias("no"), tags.alias("tags"))

    items = F.slice(F.array(item(0), item(1)), F.lit(1), (F.col("o_orderkey") % 3).cast("int"))
    document = F.struct(F.col("o_orderkey").alias("id"),
                        F.struct(F.col("o_orderstatus").alias("code"), F.nullif("o_custkey", F.lit(7)).alias("who")).alias("state"),
                        F.struct(items.alias("data")).alias("items"))
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.to_json(document).alias("json_data"))


@query("""
SELECT o_orderkey AS order_id, o_orderkey AS id, o_orderstatus AS state_code, nullif(o_custkey, 7) AS state_who,
  CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS items_data_0_amount, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS items_data_0_no,
  CASE WHEN o_orderkey % 3 > 0 AND o_orderkey % 2 = 0 THEN o_orderpriority END AS items_data_0_tags_0,
  CASE WHEN o_orderkey % 3 > 1 THEN o_totalprice END AS items_data_1_amount, CASE WHEN o_orderkey % 3 > 1 THEN o_orderkey + 1 END AS items_data_1_no,
  CASE WHEN o_orderkey % 3 > 1 AND o_orderkey % 2 = 1 THEN o_orderpriority END AS items_data_1_tags_0
FROM orders""", name="flatten_json")
def flat_orders(t):
    flat = files.flatten_json(_order_documents(t), "json_data")
    return flat.withColumns({c: F.col(c).cast("double") for c in flat.columns if c.endswith("_amount")})


@query("""
SELECT order_id, no, amount, tag FROM (
  SELECT o_orderkey AS order_id, o_orderkey AS no, o_totalprice AS amount, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS tag FROM orders WHERE o_orderkey % 3 > 0
  UNION ALL SELECT o_orderkey, o_orderkey + 1, o_totalprice, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END FROM orders WHERE o_orderkey % 3 > 1)""",
       name="explode_child")
def order_items(t):
    children = files.explode_child(_order_documents(t), "items.data", keep=["order_id"])

    return project_json(children, "json_data", {"no": ("no", "bigint"), "amount": ("amount", "double"), "tag": "$.tags[0]"})


@query("""
SELECT 'tidemark_shards.events_click' AS "_dbt_source_relation", user_id, value FROM events WHERE event_type = 'click' AND value > 10
UNION ALL SELECT 'tidemark_shards.events_view', user_id, value FROM events WHERE event_type = 'view' AND value > 10""")
def tables_like_union(t):
    database = _new_database(t.spark, "tidemark_shards")
    for kind in ("click", "view", "error"):
        shard = t.events.filter(F.col("event_type") == kind).select("user_id", "value")
        life.materialize(shard, f"{database}.events_{kind}", "table")
    found = catalog.tables_like(t.spark, f"{database[:-4]}%", "EVENTS%", exclude="%error")
    by_prefix = [n for n in catalog.tables_with_prefix(t.spark, database, "events_") if not n.endswith("_error")]
    if found != by_prefix:
        raise AssertionError(f"{found} and {by_prefix} differ")
    united = catalog.union_tables(t.spark, found, where="value > 10")
    return united.withColumn("_dbt_source_relation", F.replace("_dbt_source_relation", F.lit(database), F.lit("tidemark_shards")))


@query("""
SELECT l_linenumber, count(*) AS n_values, CAST(sum(n_records) AS BIGINT) AS n_rows FROM (
  SELECT l_linenumber, l_partkey, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""")
def stored_failures(t):
    database = _new_database(t.spark, "tidemark_failures")
    lines = life.materialize(t.lineitem.select("l_linenumber", F.struct("l_linenumber", "l_partkey").alias("pair")), f"{database}_lines")
    failing = life.store_failures(unique(lines, "pair"), f"{database}.unique_pair")
    return failing.groupBy(F.col("unique_field.l_linenumber").alias("l_linenumber")).agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("n_records").alias("n_rows"))


@query("""
SELECT '20240130' AS run_day, event_type AS object, count(*) AS n FROM events WHERE value > 20 GROUP BY 2
UNION ALL SELECT '20240131', event_type, count(*) FROM events WHERE value <= 20 GROUP BY 2""")
def stream_landing(t):
    documents = _event_documents(t)
    folder, table, progress = (work_folder(t.spark, label) for label in ("incoming", "landed", "progress"))
    for as_of, part in ((DAY_1, "value > 20"), (DAY_2, "value <= 20"), (DAY_2, None)):  # the last run finds no new files
        if part is not None:
            documents.filter(part).select("json_data").write.mode("append").text(folder)
        land_new_files(t.spark, folder, table, as_of, "events", progress=progress).awaitTermination()
    return t.spark.read.parquet(table).groupBy(F.col("run_day").cast("string").alias("run_day"), "object").agg(
        F.count(F.lit(1)).alias("n"))


BROKEN = """
WITH lines AS (SELECT event_id, event_id % 50 = 0 AS broken FROM events)
"""


def _broken_documents(t):
    """Event documents, every fiftieth of which is cut off."""
    text = F.col("json_data")
    return _event_documents(t).select("value", F.when(F.get_json_object(text, "$.id").cast("bigint") % 50 == 0, F.concat(
        F.lit('{"id": '), F.get_json_object(text, "$.id"))).otherwise(text).alias("line"))


@query(BROKEN + """
SELECT 'document' AS kind, CAST(event_id AS VARCHAR) AS record FROM lines WHERE NOT broken
UNION ALL SELECT 'rejected', '{"id": ' || event_id FROM lines WHERE broken""")
def json_lines_with_rejects(t):
    documents, rejected = files.split_json_lines(t.spark, _land(_broken_documents(t).select("line"), "broken"))
    return documents.select(F.lit("document").alias("kind"), F.get_json_object("json_data", "$.id").alias("record")).unionByName(
        rejected.select(F.lit("rejected").alias("kind"), "record"))


@query("""
SELECT 'row' AS kind, CAST(o_orderkey AS VARCHAR) AS record FROM orders WHERE o_orderkey % 40 <> 0
UNION ALL SELECT 'rejected', 'x' || o_orderkey || ',' || o_custkey FROM orders WHERE o_orderkey % 40 = 0""")
def csv_with_rejects(t):
    key = F.when(F.col("o_orderkey") % 40 == 0, F.concat(F.lit("x"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string"))
    folder = work_folder(t.spark, "rejects")
    t.orders.select(key.alias("o_orderkey"), "o_custkey").write.option("header", True).csv(folder)
    rows, rejected = files.split_csv(t.spark, folder, "o_orderkey bigint, o_custkey bigint")
    return rows.select(F.lit("row").alias("kind"), F.col("o_orderkey").cast("string").alias("record")).unionByName(
        rejected.select(F.lit("rejected").alias("kind"), "record"))


@query(BROKEN + """
SELECT 'landed' AS kind, '20240130' AS run_day, count(*) AS n FROM lines WHERE NOT broken
UNION ALL SELECT 'rejected', '20240130', count(*) FROM lines WHERE broken""")
def stream_with_rejects(t):
    folder, table, rejects, progress = (work_folder(t.spark, label) for label in ("incoming", "landed", "rejects", "progress"))
    _broken_documents(t).select("line").write.text(folder)
    for _ in range(2):  # the second run finds no new files
        land_new_files(t.spark, folder, table, DAY_1, "events", progress=progress).awaitTermination()
        land_rejects(t.spark, folder, rejects, DAY_1, "events", progress=f"{progress}-rejects").awaitTermination()
    counted = [t.spark.read.parquet(path).groupBy(F.col("run_day").cast("string").alias("run_day")).agg(F.count(F.lit(1)).alias("n"))
               .withColumn("kind", F.lit(kind)) for path, kind in ((table, "landed"), (rejects, "rejected"))]
    return counted[0].unionByName(counted[1]).select("kind", "run_day", "n")


@query("""
SELECT o_orderkey AS order_id, o_orderkey AS id, o_orderstatus AS state_code, nullif(o_custkey, 7) AS state_who,
  CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS items_data_0_no,
  CASE WHEN o_orderkey % 3 > 1 THEN 1 END AS n_rest, CASE WHEN o_orderkey % 3 > 1 THEN o_orderkey + 1 END AS rest_no
FROM orders""")
def flatten_json_with_rest(t):
    flat = files.flatten_json(_order_documents(t), "json_data", max_items=1)
    rest = F.col("items_data_rest")
    return flat.select("order_id", "id", "state_code", "state_who", "items_data_0_no", F.json_array_length(rest).alias("n_rest"),
                       F.get_json_object(rest, "$[0].no").cast("bigint").alias("rest_no"))


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS owner_id, CASE WHEN event_id % 3 = 1 THEN value END AS sum_value,
       CASE WHEN event_id % 3 = 2 THEN event_type END AS kinds_0, CASE WHEN event_id % 3 = 2 AND event_id % 2 = 0 THEN 'even' END AS kinds_1
FROM events""")
def flatten_day_by_day(t):
    """Three days of documents with fields of their own; the schema comes from each day's new documents alone."""
    kinds = F.when(F.col("event_id") % 2 == 0, F.array("event_type", F.lit("even"))).otherwise(F.array("event_type"))
    fields = [F.struct(F.col("user_id").alias("id")).alias("owner"), F.struct("value").alias("sum"), kinds.alias("kinds")]
    location = work_folder(t.spark, "schema") + ".json"
    days = [t.events.filter(F.col("event_id") % 3 == k).select(F.to_json(F.struct("event_id", field)).alias("json_data")) for k, field in enumerate(fields)]
    for day in days:
        kept = kept_schema.keep_schema(day, "json_data", location)
    flat = files.flatten_json(files.load_union(days), "json_data", schema=kept.schema, widths=kept.widths)
    return flat.select("event_id", "owner_id", F.col("sum_value").cast("double").alias("sum_value"), "kinds_0", "kinds_1")
