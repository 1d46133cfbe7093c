"""Scalar functions and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query
from tidemark.functions import calendar as cal
from tidemark.functions import scalars as sc
from tidemark.functions.documents import json_value, project_json
from tidemark.functions.web import url_host, url_param, url_path
from tidemark.operators.select import (
    empty_to_null,
    epoch_to_ts,
    filtered_columns,
    first_slot,
    null_column,
    slugified,
    stage,
    star,
    top_parent_flag,
)
from tidemark.plans.general import REPORT_PERIODS
from tidemark.plans.staging import COLUMNS, STAGING, TEST_CUSTOMERS, stage_all
from tidemark.plans.subscriptions import FACT_PERIODS
from tidemark.sources.files import load_union


@query("""
SELECT l_orderkey, l_partkey, l_linenumber,
       round(coalesce(l_quantity, 0) + coalesce(nullif(l_tax, 0), 0) + coalesce(nullif(l_discount, 0), 0), 6) AS added,
       round(coalesce(nullif(l_tax, 0), 0) - coalesce(l_discount, 0) - coalesce(l_quantity, 0), 6) AS subtracted,
       round(l_extendedprice / nullif(l_tax, 0), 4) AS divided
FROM lineitem""")
def safe_math(t):
    tax, discount = F.nullif("l_tax", F.lit(0.0)), F.nullif("l_discount", F.lit(0.0))
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.round(sc.safe_add("l_quantity", tax, discount), 6).alias("added"),
        F.round(sc.safe_subtract(tax, "l_discount", "l_quantity"), 6).alias("subtracted"),
        F.round(sc.safe_divide("l_extendedprice", "l_tax"), 4).alias("divided"))


@query("""
SELECT l_orderkey, l_partkey, l_linenumber,
       CAST(CASE WHEN l_extendedprice < 1000 THEN 0 WHEN l_extendedprice >= 91000 THEN 10
            ELSE floor(9 * (l_extendedprice - 1000) / 90000) + 1 END AS BIGINT) AS bucket,
       CAST(CASE WHEN CAST(l_extendedprice AS DECIMAL(38,9)) % 20000 = 0 THEN 1 ELSE 0 END
            + least(ceil((l_extendedprice - 0) / 20000), 6) AS BIGINT) AS edge_bucket
FROM lineitem""")
def width_buckets(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        sc.width_bucket("l_extendedprice", 1000, 91000, 9).alias("bucket"),
        sc.width_bucket("l_extendedprice", 0, 100000, 5, edge_formula=True).alias("edge_bucket"))


@query("""
SELECT l_orderkey, l_partkey, l_linenumber,
       md5(coalesce(CAST(l_orderkey AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(CAST(l_linenumber AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_')) AS line_key,
       md5(coalesce(nullif(l_returnflag, 'N'), '') || '-' || l_linestatus) AS flag_key
FROM lineitem""")
def surrogate_key_lineitem(t):
    flag = F.nullif("l_returnflag", F.lit("N"))
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        sc.surrogate_key("l_orderkey", "l_linenumber", flag).alias("line_key"),
        sc.surrogate_key(flag, "l_linestatus", nulls_as_empty=True).alias("flag_key"))


@query("""
WITH places AS (
  SELECT o_orderkey, o_custkey % 160 - 80 AS lat1, o_custkey % 340 - 170 AS lon1,
         o_orderkey % 150 - 75 AS lat2, o_orderkey % 330 - 165 AS lon2 FROM orders)
SELECT o_orderkey,
       round(2 * 3961 * asin(sqrt(pow(sin((radians(lat2) - radians(lat1)) / 2), 2) + cos(radians(lat1)) *
             cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2))), 3) AS miles,
       round(2 * 3961 * asin(sqrt(pow(sin((radians(lat2) - radians(lat1)) / 2), 2) + cos(radians(lat1)) *
             cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2))) * 1.60934, 3) AS km,
       round(radians(lat1), 9) AS lat1_radians
FROM places""")
def haversine_pairs(t):
    places = t.orders.select(
        "o_orderkey", (F.col("o_custkey") % 160 - 80).alias("lat1"), (F.col("o_custkey") % 340 - 170).alias("lon1"),
        (F.col("o_orderkey") % 150 - 75).alias("lat2"), (F.col("o_orderkey") % 330 - 165).alias("lon2"))
    corners = ("lat1", "lon1", "lat2", "lon2")
    return places.select("o_orderkey", F.round(sc.haversine(*corners), 3).alias("miles"),
                         F.round(sc.haversine(*corners, unit="km"), 3).alias("km"),
                         F.round(sc.degrees_to_radians("lat1"), 9).alias("lat1_radians"))


@query("""
WITH stripped AS (
  SELECT page_id, url, replace(replace(url, 'http://', ''), 'https://', '') AS s FROM pages)
SELECT page_id,
       split_part(split_part(replace(s, 'android-app://', ''), '/', 1), '?', 1) AS host,
       split_part(right(s, CAST(length(s) - coalesce(nullif(instr(s, '/'), 0), instr(s, '?') - 1) AS BIGINT)), '?', 1) AS path,
       nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
       nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS utm_source
FROM stripped""")
def url_host_path_param(t):
    return t.pages.select("page_id", url_host("url").alias("host"), url_path("url").alias("path"),
                          url_param("url", "page").alias("page"), url_param("url", "utm_source").alias("utm_source"))


@query("""
SELECT event_id, regexp_extract(props, '"k": ([0-9]+)', 1) AS k,
       CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k_number,
       CAST(CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) / 2 AS DOUBLE) AS k_half,
       CAST(NULL AS VARCHAR) AS missing
FROM events""")
def json_props(t):
    typed = project_json(t.events.select("event_id", "props"), "props", {
        "k": "k", "k_number": ("$.k", "bigint"), "k_double": ("k", "double"), "missing": "a.b"})
    return typed.select("event_id", "k", "k_number", (F.col("k_double") / 2).alias("k_half"), "missing")


@query("""
WITH docs AS (SELECT user_id, event_type, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k FROM events)
SELECT event_type, k, count(*) AS n FROM docs GROUP BY event_type, k""")
def json_value_counts(t):
    return t.events.groupBy("event_type", json_value("props", "$.k").try_cast("bigint").alias("k")).agg(
        F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_orderkey,
       CASE WHEN nullif(o_orderstatus, 'P') = 'F' THEN 'yes' ELSE 'no' END AS is_final,
       coalesce(nullif(o_orderpriority, '5-LOW'), 'null') AS priority_label,
       CASE WHEN nullif(o_totalprice > 300000, false) IS NOT NULL THEN greatest(o_orderkey, o_custkey) END AS larger,
       CASE WHEN o_totalprice > 300000 THEN least(o_orderkey, o_custkey) END AS smaller,
       'https://example.com/orders/' || CAST(o_orderkey AS VARCHAR) || '/view' AS order_link,
       CAST(round(CAST(o_totalprice AS DECIMAL(18,2))) AS BIGINT) AS whole_price,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'monthly' WHEN o_orderpriority = '2-HIGH' THEN 'quarterly'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'biannually' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'annually'
            END AS fact_period,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'monthly' WHEN o_orderpriority = '2-HIGH' THEN 'quarterly'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'semiannualy' ELSE '' END AS report_period,
       CASE WHEN o_custkey = o_orderkey % 100 THEN 'Yes' ELSE 'No' END AS is_top_parent,
       CAST(NULL AS VARCHAR) AS cache_size
FROM orders""")
def row_labels(t):
    priority = F.col("o_orderpriority")
    interval = F.when(priority.isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "month").when(priority == "4-NOT SPECIFIED", "year")
    count = F.when(priority == "1-URGENT", 1).when(priority == "2-HIGH", 3).when(priority == "3-MEDIUM", 6).otherwise(2)
    big = F.when(F.col("o_totalprice") > 300000, F.col("o_custkey"))
    source = t.orders.withColumn("_parent", F.col("o_orderkey") % 100)
    return source.select(
        "o_orderkey",
        sc.yes_no(F.nullif("o_orderstatus", F.lit("P")) == "F").alias("is_final"),
        sc.null_label(F.nullif(priority, F.lit("5-LOW"))).alias("priority_label"),
        sc.largest("o_orderkey", big).alias("larger"),
        sc.smallest("o_orderkey", big).alias("smaller"),
        sc.link("https://example.com/orders/", "o_orderkey", "/view").alias("order_link"),
        sc.rounded_int(F.col("o_totalprice").cast("decimal(18,2)")).alias("whole_price"),
        sc.billing_period(interval, count, FACT_PERIODS).alias("fact_period"),
        sc.billing_period(interval, count, REPORT_PERIODS, "").alias("report_period"),
        top_parent_flag("o_custkey", "_parent").alias("is_top_parent"),
        null_column("string").alias("cache_size"))


@query("""
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds,
       strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS from_seconds,
       strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS from_millis,
       strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS from_micros
FROM events""")
def epoch_roundtrip(t):
    seconds = t.events.select("event_id", cal.to_epoch("ts").alias("seconds"))
    return seconds.select(
        "event_id", "seconds",
        cal.from_epoch(F.col("seconds").cast("double")).alias("from_seconds"),
        cal.from_epoch(F.col("seconds") * 1000, "milliseconds").alias("from_millis"),
        cal.from_epoch(F.col("seconds") * 1000000, "microseconds").alias("from_micros"))


@query("""
SELECT event_id AS id, CAST(user_id AS VARCHAR) AS owner, event_type,
       strftime(make_timestamp(CAST(user_id AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS value_at
FROM events WHERE event_type <> 'error'""")
def staging_select(t):
    source = t.events.withColumn("value_at", F.col("user_id").cast("double"))
    return stage(source, columns=["event_id", "user_id", "event_type", "value_at"],
                 renames={"event_id": "id", "user_id": "owner"}, casts={"user_id": "string"},
                 epochs=["VALUE_AT"], where="event_type <> 'error'")


@query("""
SELECT 'user' AS kind, c_custkey AS id, c_name AS label FROM customer
UNION ALL SELECT 'membership', o_orderkey, CAST(o_custkey % 5 AS VARCHAR) FROM orders
UNION ALL SELECT 'change', event_id, props FROM events
UNION ALL SELECT 'newest copy', event_id, event_type FROM events WHERE strftime(ts, '%Y%m%d') = (SELECT max(strftime(ts, '%Y%m%d')) FROM events)""")
def staging_views(t):
    none = null_column("string")
    views = stage_all({
        "app_users": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"), *[
            none.alias(c) for c in ("last_name", "phone", "email", "last_sign_in_at", "last_synced_at", "not_staged")]),
        "app_memberships": t.orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_custkey").alias("organization_id"),
            (F.col("o_custkey") % 5).alias("role_id")),
        "crm_account_history": t.events.select(
            F.col("event_id").alias("AccountId"), F.lit("Owner").alias("Field"), F.col("props").alias("OldValue"),
            none.alias("NewValue"), F.col("ts").alias("CreatedDate")),
        "raw_subscriptions": t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("object"),
                                             F.date_format("ts", "yyyyMMddHHmmss").alias("run_date")),
    })
    parts = [("user", "app_users", "user_id", "first_name"), ("membership", "app_memberships", "id", "role_id"),
             ("change", "crm_account_history", "account_id", "old_value"), ("newest copy", "raw_subscriptions", "id", "object")]
    return load_union([views[view].select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.col(label).cast("string").alias("label"))
                       for kind, view, key, label in parts])


# One query per staging view whose source has no counterpart among the driver's tables: the source gets the view's columns
# with texts made of their names and a key, and one column that the view's list does not have.
_WIDE = {  # some columns of views that keep all of their source's
    "billing_subscriptions": ("id", "customer", "status", "items_data_0_plan_id", "items_data_1_quantity", *STAGING["billing_subscriptions"].epochs),
    "billing_customers": ("id", "email", "name", "description", "metadata_organization_id"),
    "app_organizations": ("id", "resource_id", "name", "membership_count", "created_at"),
    "app_subscriptions": ("id", "stripe_customer_token", "plan_id", "max_users", "owner_id"),
    "app_forms": ("id", "resource_id", "name", "owner_id", "record_count"),
    "app_form_updates": ("id", "resource_id", "organization_id", "field_count", "received_at"),
    "app_groups": ("id", "group_id", "industry", "is_paid_account", "timestamp"),
    "app_flows_completed": ("id", "flow_id", "flow_name", "user_org_id", "timestamp"),
    "app_device_syncs": ("id", "identifier", "organization_id", "platform", "timestamp"),
}
_SOURCES = {"billing": ("customer", "c_custkey"), "app": ("orders", "o_orderkey"), "raw": ("events", "event_id")}


def _staged(view: str) -> None:
    table, key = _SOURCES[view.split("_")[0]]
    spec = STAGING[view]
    listed = spec.columns or _WIDE[view]
    shown = listed if spec.columns else (*listed, "not_listed")  # a view without a list keeps what its source has
    test = TEST_CUSTOMERS[0]

    def value(column: str):
        text = F.concat(F.lit(f"{column}-"), F.col(key).cast("string"))
        if column in spec.epochs:
            return F.when(F.col(key) % 7 > 0, F.col(key) * 3600).cast("string").alias(column)
        return (F.when(F.col(key) % 50 == 3, F.lit(test)).otherwise(text) if column == "id" else text).alias(column)

    def value_sql(column: str) -> str:
        text = f"'{column}-' || {key}"
        if column in spec.epochs:
            text = f"CASE WHEN {key} % 7 > 0 THEN strftime(make_timestamp(CAST({key} * 3600 AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') END"
        elif column == "id":
            text = f"CASE WHEN {key} % 50 = 3 THEN '{test}' ELSE {text} END"
        return f'{text} AS "{spec.renames.get(column, column)}"'

    excluded = f" WHERE {key} % 50 <> 3" if view == "billing_customers" else ""

    @query(f"SELECT {', '.join(map(value_sql, shown))} FROM {table}{excluded}", name=f"staged_{view}")
    def staged(t):
        source = getattr(t, table)
        return stage_all({view: source.select(*map(value, (*listed, "not_listed")))})[view]


for _view in (*_WIDE, *COLUMNS):
    _staged(_view)


@query("""
SELECT 'item-' || event_id AS id, 'sub-' || user_id AS subscription, strftime(ts, '%Y%m%d%H%M%S') AS run_date FROM events
WHERE strftime(ts, '%Y%m%d') = (SELECT max(strftime(ts, '%Y%m%d')) FROM events)""")
def staged_raw_subscription_items(t):
    copies = t.events.select(F.concat(F.lit("item-"), F.col("event_id").cast("string")).alias("id"),
                             F.concat(F.lit("sub-"), F.col("user_id").cast("string")).alias("subscription"),
                             F.date_format("ts", "yyyyMMddHHmmss").alias("run_date"))
    return stage_all({"raw_subscription_items": copies})["raw_subscription_items"]


@query("""
SELECT o_orderkey, strftime(make_timestamp(o_orderkey * 1000000), '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders""")
def epoch_columns(t):
    return epoch_to_ts(t.orders.select("o_orderkey", F.col("o_orderkey").alias("o_orderdate")), ["o_orderdate"])


@query("""
SELECT n_nationkey AS dim_n_nationkey_id, n_name AS dim_n_name_id, count(c_custkey) AS n_customers
FROM nation LEFT JOIN customer ON n_nationkey = c_nationkey GROUP BY ALL""")
def star_except(t):
    renamed = star(t.nation, except_=["N_REGIONKEY"], prefix="dim_", suffix="_id")
    keys = filtered_columns(renamed, [])
    joined = renamed.join(t.customer, F.col("dim_n_nationkey_id") == F.col("c_nationkey"), "left")
    return joined.groupBy(*keys).agg(F.count("c_custkey").alias("n_customers"))


@query("""
SELECT doc_id, nullif(CASE WHEN length(text) < 200 THEN '' ELSE lang END, '') AS lang,
       nullif(CASE WHEN source = 'web' THEN '' ELSE source END, '') AS source, n_chars
FROM documents""", name="empty_to_null")
def empty_text(t):
    blanked = t.documents.select(
        "doc_id", F.when(F.length("text") < 200, "").otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("source") == "web", "").otherwise(F.col("source")).alias("source"), "n_chars")
    return empty_to_null(blanked)


@query("""
SELECT l_orderkey, l_partkey, l_linenumber,
       CASE WHEN l_returnflag = 'A' THEN l_quantity WHEN l_linestatus = 'F' THEN l_discount
            WHEN l_tax > 0.05 THEN l_tax ELSE 0 END AS first_match
FROM lineitem""")
def first_matching_slot(t):
    tests = [F.col("l_returnflag") == "A", F.col("l_linestatus") == "F", F.col("l_tax") > 0.05]
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber",
                             first_slot(tests, [F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")], 0.0)
                             .alias("first_match"))


@query("""
SELECT o_orderkey, o_orderstatus, lower(o_orderpriority) AS priority, left(o_orderpriority, 1) AS rank,
       substr(o_orderpriority, 3) AS word, replace(o_orderpriority, '-', ' ') AS spaced
FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P') AND o_totalprice BETWEEN 1000 AND 200000
  AND o_orderdate IS NOT NULL AND (o_custkey <> 7 OR o_orderstatus = 'F')""")
def predicates_and_text(t):
    kept = t.orders.filter(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P")
        & F.col("o_totalprice").between(1000, 200000) & F.col("o_orderdate").isNotNull()
        & ((F.col("o_custkey") != 7) | (F.col("o_orderstatus") == "F")))
    return kept.select("o_orderkey", "o_orderstatus", F.lower("o_orderpriority").alias("priority"),
                       F.left("o_orderpriority", F.lit(1)).alias("rank"),
                       F.substring("o_orderpriority", 3, 100).alias("word"),
                       F.replace("o_orderpriority", F.lit("-"), F.lit(" ")).alias("spaced"))


@query("""
SELECT 'brand' || '_' || lower(replace(p_brand, '#', '')) AS column_name, count(*) AS n_parts FROM part GROUP BY 1""")
def slugged_names(t):
    return t.part.groupBy(slugified(F.concat(F.lit("Brand "), "p_brand")).alias("column_name")).agg(F.count(F.lit(1)).alias("n_parts"))
