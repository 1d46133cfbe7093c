"""Dimensions, facts and reports on stand-ins made from the driver's tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalogue.base import query, work_folder
from tidemark.functions.scalars import sum_if
from tidemark.operators.select import null_column
from tidemark.operators.spines import months_list
from tidemark.operators.windows import latest_per_key
from tidemark.plans import book, crm, customers, general, kept, monthly, revenue, staging, status, subscriptions, touchpoints, usage

AS_OF = "2001-08-01"
APP_URL, BILLING_URL = "https://app.example.com/customers/", "https://billing.example.com/customers/"
COUNTERS = ("membership_count", "active_device_count", "form_count", "record_count")


def _text(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


# -- stand-ins, each with its SQL ---------------------------------------------------------------

def billing_customers(t):
    return t.customer.select(
        _text("cus_", "c_custkey").alias("id"), F.col("c_name").alias("email"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"),
        F.col("c_mktsegment").alias("description"), _text("org_", "c_nationkey").alias("metadata_organization_id"))


def bridge(t):
    """Customer and nation of every order: the same pair many times."""
    keys = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return t.orders.join(keys, "o_custkey").select(_text("cus_", "o_custkey").alias("customer_id"),
                                                  F.col("c_nationkey").alias("organization_id"))


def organizations(t):
    key = F.col("n_nationkey")
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return places.select(
        key.alias("id"), F.when(key != 24, _text("org_", "n_nationkey")).alias("resource_id"), F.col("n_name").alias("name"),
        F.lower("n_name").alias("locality"), F.col("r_name").alias("region"), F.col("r_name").alias("country"),
        F.col("r_name").alias("industry_name"), F.col("n_regionkey").alias("created_by_id"),
        (key * 10).alias("company_size"), F.date_add(F.lit("2020-01-01").cast("date"), key).alias("created_at"),
        *[(key % n).alias(c) for n, c in zip((2, 3, 5, 7), COUNTERS, strict=True)])


ORGS_SQL = """
cust AS (SELECT 'cus_' || c_custkey AS id, c_name AS email, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name,
         c_mktsegment AS description, 'org_' || c_nationkey AS metadata_organization_id FROM customer),
bridge AS (SELECT DISTINCT 'cus_' || o_custkey AS customer_id, c_nationkey AS organization_id FROM orders JOIN customer ON o_custkey = c_custkey),
orgs AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey <> 24 THEN 'org_' || n_nationkey END AS resource_id, n_name AS name,
         lower(n_name) AS locality, r_name AS region, r_name AS country, r_name AS industry_name, n_regionkey AS created_by_id,
         n_nationkey * 10 AS company_size, CAST(DATE '2020-01-01' + n_nationkey AS VARCHAR) AS created_at,
         n_nationkey % 2 AS membership_count, n_nationkey % 3 AS active_device_count, n_nationkey % 5 AS form_count,
         n_nationkey % 7 AS record_count FROM nation JOIN region ON n_regionkey = r_regionkey)
"""


@query(f"""WITH {ORGS_SQL}
SELECT metadata_organization_id AS app_customer_key, cust.id AS billing_customer_key, orgs.name, email, locality, region, country,
       created_by_id, company_size, created_at, '{APP_URL}' || resource_id AS app_account_link, '{BILLING_URL}' || cust.id AS billing_customer_link
FROM cust LEFT JOIN bridge ON cust.id = customer_id LEFT JOIN orgs ON organization_id = orgs.id WHERE resource_id IS NOT NULL""")
def dim_customers(t):
    return customers.dim_customers(billing_customers(t), bridge(t), organizations(t), APP_URL, BILLING_URL)


REVENUE_MONTHS = months_list(1996, 1, 1997, 10)


@query(f"""WITH {ORGS_SQL}
SELECT customer, resource_id, """ + ", ".join(
    f"CAST(sum(CASE WHEN month = '{m}' THEN amount END) AS DOUBLE) AS \"{m}\"" for m in REVENUE_MONTHS) + """
FROM (SELECT 'cus_' || o_custkey AS customer, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, strftime(o_orderdate, '%Y-%m') AS month
      FROM orders WHERE o_orderstatus = 'F') LEFT JOIN bridge ON customer = customer_id LEFT JOIN orgs ON organization_id = orgs.id
GROUP BY customer, resource_id""")
def revenue_by_month_pivot(t):
    invoices = t.orders.select(_text("cus_", "o_custkey").alias("customer"), F.col("o_totalprice").alias("amount_paid"),
                               F.col("o_orderdate").alias("created"), (F.col("o_orderstatus") == "F").alias("paid"))
    return revenue.revenue_by_month(invoices, bridge(t), organizations(t), REVENUE_MONTHS)


# Subscriptions: an order with its first three lines as slots.
def _status():
    return (F.when(F.col("o_orderstatus") == "F", "canceled").when(F.col("o_orderstatus") == "O", "active")
            .otherwise("past_due"))


def wide_subscriptions(t):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    fields = {
        "plan_product": F.col("l_partkey"), "quantity": F.col("l_quantity").cast("bigint"),
        "plan_amount": F.floor(F.col("l_extendedprice") * 100 + 0.5),
        "plan_interval": F.when(F.col("l_returnflag") == "A", "year").otherwise("month"),
        "plan_interval_count": F.when(F.col("l_returnflag") == "R", 3).otherwise(1),
        "price_id": F.concat(F.lit("price_"), (F.col("l_partkey") % 10).cast("string"))}
    # An order may have very many lines: only its first three are kept before they are moved.
    first = latest_per_key(t.lineitem.select("l_orderkey", *order), "l_orderkey", order, rows=3)
    along = Window.partitionBy("l_orderkey").orderBy(*order)
    item = F.struct(*[value.alias(name) for name, value in fields.items()])
    slots = first.select(F.col("l_orderkey").alias("o_orderkey"), F.row_number().over(along).alias("place"), item.alias("slot_0"),
                         F.lead(item, 1).over(along).alias("slot_1"), F.lead(item, 2).over(along).alias("slot_2")).filter("place = 1")
    day = F.col("o_orderdate").cast("date")
    return t.orders.join(slots, "o_orderkey").select(
        F.col("o_orderkey").alias("id"), _text("cus_", "o_custkey").alias("customer"), _status().alias("status"),
        F.col("o_orderpriority").alias("collection_method"), F.lit("usd").alias("currency"),
        (F.col("o_orderstatus") == "O").alias("plan_active"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "month").alias("plan_interval"),
        F.date_add(day, 7).alias("trial_end"), F.date_add(day, 1).alias("items_data_0_created"), day.alias("created"), day.alias("current_period_start"),
        F.date_add(day, 30).alias("current_period_end"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(day, 90)).alias("ended_at"),
        *[F.col(f"slot_{n}.{f}").alias(f"items_data_{n}_{f}") for n in (0, 1, 2) for f in fields])


SUBS_SQL = """
line AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) AS place,
         l_partkey AS product, CAST(l_quantity AS BIGINT) AS quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount,
         CASE WHEN l_returnflag = 'A' THEN 'year' ELSE 'month' END AS unit, CASE WHEN l_returnflag = 'R' THEN 3 ELSE 1 END AS times FROM lineitem),
slots AS (SELECT l_orderkey, """ + ", ".join(
    f"max(CASE WHEN place = {n + 1} THEN {c} END) AS {c}_{n}" for n in (0, 1, 2) for c in ("product", "quantity", "amount", "unit", "times")) + """
  FROM line WHERE place <= 3 GROUP BY 1),
subs AS (SELECT o_orderkey AS id, 'cus_' || o_custkey AS customer, CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'O' THEN 'active' ELSE 'past_due' END AS status,
         o_orderpriority AS collection_method, 'usd' AS currency, o_orderstatus = 'O' AS plan_active,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'month' END AS plan_interval, CAST(o_orderdate AS DATE) AS created,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 90 END AS ended_at, slots.*
         FROM orders JOIN slots ON o_orderkey = l_orderkey)
"""


def products(t):
    return t.part.select(F.col("p_partkey").alias("id"), F.nullif("p_type", F.lit("PROMO")).alias("name"))


def app_settings(t):
    return t.nation.filter("n_name NOT IN ('NATION_3', 'NATION_7')").select(
        F.col("n_nationkey").alias("owner_id"), (F.col("n_nationkey") * 100).alias("media_data_usage"),
        (F.col("n_nationkey") % 2 == 0).alias("form_scripts_enabled"))


@query(f"""WITH {ORGS_SQL}, {SUBS_SQL},
prod AS (SELECT p_partkey AS id, nullif(p_type, 'PROMO') AS name FROM part)
SELECT subs.id AS billing_subscription_key, customer AS billing_customer_key, collection_method, currency, plan_active, plan_interval, status,
       p0.name AS plan_0_name, p1.name AS plan_1_name, p2.name AS plan_2_name, membership_count, active_device_count, form_count, record_count,
       created_at AS signed_up_date, CAST(created + 7 AS VARCHAR) AS trial_end_date, orgs.id * 100 AS media_data_usage,
       orgs.id % 2 = 0 AS form_scripts_enabled, '{BILLING_URL}' || subs.id AS billing_subscription_link
FROM subs LEFT JOIN prod p0 ON product_0 = p0.id LEFT JOIN prod p1 ON product_1 = p1.id LEFT JOIN prod p2 ON product_2 = p2.id
JOIN cust ON customer = cust.id JOIN bridge ON cust.id = customer_id JOIN orgs ON organization_id = orgs.id WHERE orgs.name NOT IN ('NATION_3', 'NATION_7')""")
def dim_subscriptions(t):
    return subscriptions.dim_subscriptions(wide_subscriptions(t), products(t), billing_customers(t), bridge(t),
                                           organizations(t), app_settings(t), BILLING_URL)


# Recurring revenue: orders as subscriptions, lines as their items.
def plain_subscriptions(t):
    gone = F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 300).cast("int"))
    return t.orders.select(
        F.col("o_orderkey").alias("id"), _text("cus_", "o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("start_date"), F.when(F.col("o_orderstatus") == "F", gone).alias("canceled_at"),
        _status().alias("status"))


def subscription_items(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("subscription"), F.col("l_quantity").cast("bigint").alias("quantity"),
        F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("amount"),
        F.when(F.col("l_returnflag") == "A", "year").otherwise("month").alias("interval_period"),
        F.when(F.col("l_returnflag") == "R", 3).otherwise(1).alias("interval_count"))


def _mrr_sql(history: bool) -> str:
    return f"""
items AS (SELECT l_orderkey AS sub, sum(CAST(CASE WHEN l_returnflag = 'A' THEN CAST(round(l_extendedprice * 100) AS BIGINT) / 1 / 12 * CAST(l_quantity AS BIGINT)
            ELSE CAST(round(l_extendedprice * 100) AS BIGINT) / CASE WHEN l_returnflag = 'R' THEN 3 ELSE 1 END * CAST(l_quantity AS BIGINT) END AS DECIMAL(28,6))) AS cents
          FROM lineitem GROUP BY 1),
begun AS (  -- subscriptions by the month they began in, without those cancelled in that month
  SELECT 'cus_' || o_custkey AS customer_id, date_trunc('month', o_orderdate) AS start_month,
         CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'O' THEN 'active' ELSE 'past_due' END AS source_status,
         CAST(CAST(floor(round(sum(cents), 3) + 50) AS HUGEINT) // 100 AS BIGINT) AS amount,
         max(date_trunc('month', o_orderdate + CAST(o_orderkey % 300 AS INTEGER) * INTERVAL 1 DAY)) AS ended
  FROM orders LEFT JOIN items ON o_orderkey = sub
  WHERE o_orderstatus <> 'F' OR date_trunc('month', o_orderdate) <> date_trunc('month', o_orderdate + CAST(o_orderkey % 300 AS INTEGER) * INTERVAL 1 DAY)
  GROUP BY 1, 2, 3),
person AS (SELECT customer_id, coalesce(max(source_status) FILTER (source_status <> 'canceled'), 'canceled') AS status,
             CASE WHEN bool_and(source_status = 'canceled') THEN max(ended) END AS canceled_at FROM begun GROUP BY 1),
level AS (SELECT customer_id, start_month, arg_max(amount, source_status) AS mrr FROM begun
          WHERE amount IS NOT NULL AND start_month BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2001-08-01' GROUP BY 1, 2),
present AS (SELECT person.*, CAST(m AS TIMESTAMP) AS month FROM person, unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) g(m)
       WHERE (canceled_at IS NULL OR m <= canceled_at) {'' if history else "AND m = TIMESTAMP '2001-08-01'"}),
standing AS (SELECT present.*, level.mrr FROM present ASOF JOIN level ON present.customer_id = level.customer_id AND present.month >= level.start_month),
mrr AS (SELECT customer_id, strftime(month, '%Y-%m-%d') AS month, strftime(start_month, '%Y-%m-%d') AS start_date_month,
          amount AS monthly_amount_after_discount, strftime(canceled_at, '%Y-%m-%d') AS canceled_at, status, mrr,
          mrr - coalesce(lag(mrr) OVER up, 0) AS mrr_change, row_number() OVER up AS mrr_rank_asc,
          count(*) OVER (PARTITION BY customer_id) - row_number() OVER up + 1 AS mrr_rank_desc
        FROM standing LEFT JOIN (SELECT customer_id, start_month, source_status, amount, start_month AS month FROM begun) USING (customer_id, month)
        WINDOW up AS (PARTITION BY customer_id ORDER BY month, source_status NULLS FIRST))"""


def _mrr(t, history=False, as_of=AS_OF):
    return revenue.recurring_revenue(plain_subscriptions(t), subscription_items(t), as_of, "1995-01-01", history)


@query(f"WITH {_mrr_sql(False)} SELECT * FROM mrr")
def mrr_current(t):
    return _mrr(t)


@query(f"WITH {_mrr_sql(True)} SELECT * FROM mrr")
def mrr_history(t):
    return _mrr(t, history=True)


def _kept_revenue(t, history=False):
    """The same out of a state: early subscriptions as they stood before any was cancelled, the others a day later with what became of them."""
    state, day = work_folder(t.spark, "revenue"), dt.datetime(2001, 8, 1)
    subs, items = plain_subscriptions(t), subscription_items(t)
    early = F.col("start_date") < "1998-07-01"
    then = subs.filter(early).withColumns({"status": F.lit("active"), "canceled_at": F.lit(None).cast("date")})
    early_items = items.join(subs.filter(early).select(F.col("id").alias("subscription")), "subscription", "left_semi")
    kept.update_revenue(then, early_items, state, day, "1995-01-01", buckets=16)
    late_items = items.join(subs.filter(~early).select(F.col("id").alias("subscription")), "subscription", "left_semi")
    kept.update_revenue(subs.filter(~early | (F.col("status") != "active")), late_items, state, day + dt.timedelta(days=1), "1995-01-01")
    return kept.kept_revenue(t.spark, state, AS_OF, history)


@query(f"WITH {_mrr_sql(False)} SELECT * FROM mrr")
def mrr_current_kept(t):
    return _kept_revenue(t)


@query(f"WITH {_mrr_sql(True)} SELECT * FROM mrr")
def mrr_history_kept(t):
    return _kept_revenue(t, history=True)


@query("""
SELECT o_orderkey AS id, 'cus_' || o_custkey AS customer_id, CASE o_orderstatus WHEN 'F' THEN 'canceled' ELSE 'active' END AS status,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start_date, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 90 DAY, '%Y-%m-%d %H:%M:%S') END AS canceled_at,
  CAST(o_custkey % 5 + 1 AS BIGINT) AS quantity, CAST(round(o_totalprice * 100) AS BIGINT) AS amount, 'month' AS interval_period
FROM orders""")
def subscription_documents(t):
    def seconds(days):
        return F.unix_timestamp(F.date_add(F.col("o_orderdate").cast("date"), days).cast("timestamp"))

    subs = F.struct(_text("cus_", "o_custkey").alias("customer"), F.when(F.col("o_orderstatus") == "F", "canceled").otherwise("active").alias("status"),
                    seconds(0).alias("start_date"), F.when(F.col("o_orderstatus") == "F", seconds(90)).alias("canceled_at"))
    plan = F.struct(F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"), F.lit("month").alias("interval"), F.lit(1).alias("interval_count"))
    item = F.struct(F.col("o_orderkey").cast("string").alias("subscription"), (F.col("o_custkey") % 5 + 1).alias("quantity"), plan.alias("plan"))
    raw_subs = t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.to_json(subs).alias("json_data"))
    raw_items = t.orders.select(F.to_json(item).alias("json_data"))
    typed, items = revenue.subscription_documents(raw_subs, raw_items)
    full = typed.join(items, F.col("id") == F.col("subscription"))
    return full.select(F.col("id").cast("bigint").alias("id"), "customer_id", "status", "start_date", "canceled_at", "quantity", "amount", "interval_period")


@query(f"""WITH {ORGS_SQL}, {_mrr_sql(False)}
SELECT resource_id AS app_customer_key, cust.id AS billing_customer_key, membership_count, active_device_count, form_count, record_count, mrr
FROM orgs JOIN bridge ON orgs.id = organization_id JOIN cust ON bridge.customer_id = cust.id LEFT JOIN mrr ON cust.id = mrr.customer_id""")
def fct_customers(t):
    return customers.fct_customers(organizations(t), bridge(t), billing_customers(t), _mrr(t))


PAID, EXCLUDED = ["ECONOMY", "LARGE", "STANDARD"], ["SMALL"]


@query(f"""WITH {ORGS_SQL}, {SUBS_SQL}, {_mrr_sql(False)},
prod AS (SELECT p_partkey AS id, nullif(p_type, 'PROMO') AS name FROM part),
slot AS (SELECT id, product_0 AS product, quantity_0 AS quantity, amount_0 AS amount FROM subs WHERE product_0 IS NOT NULL
  UNION ALL SELECT id, product_1, quantity_1, amount_1 FROM subs WHERE product_1 IS NOT NULL
  UNION ALL SELECT id, product_2, quantity_2, amount_2 FROM subs WHERE product_2 IS NOT NULL),
lic AS (SELECT slot.id, CAST(sum(CASE WHEN name IN ('ECONOMY', 'LARGE', 'STANDARD') THEN quantity ELSE 0 END) AS BIGINT) AS paid,
          CAST(sum(CASE WHEN name IN ('ECONOMY', 'LARGE', 'STANDARD') THEN CAST(amount / 100 AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS total_amount,
          CAST(sum(CASE WHEN name NOT IN ('SMALL') THEN quantity ELSE 0 END) AS BIGINT) AS total FROM slot LEFT JOIN prod ON product = prod.id GROUP BY 1),
settings AS (SELECT 'cus_' || c_custkey AS token, c_nationkey AS max_users, 1 AS min_users, c_mktsegment AS media_data_usage, c_nationkey > 9 AS form_scripts_enabled
             FROM customer WHERE c_acctbal > 0)
SELECT DISTINCT resource_id AS app_customer_key, subs.id AS billing_subscription_key, customer AS billing_customer_key,
  CASE WHEN plan_interval = 'month' THEN 'monthly' WHEN unit_0 = 'month' AND times_0 = 1 THEN 'monthly' WHEN unit_0 = 'month' AND times_0 = 3 THEN 'quarterly'
       WHEN unit_0 = 'year' THEN 'annually' END AS plan_interval, subs.status,
  CAST(created AS VARCHAR) AS current_period_start, CAST(created + 30 AS VARCHAR) AS current_period_end, CAST(created AS VARCHAR) AS created,
  CAST(ended_at AS VARCHAR) AS ended_at, collection_method, paid AS paid_licenses, total - paid AS unpaid_licenses, total AS total_licenses, total_amount, mrr,
  industry_name, membership_count, active_device_count, form_count, record_count, created_at AS signed_up_date, max_users, min_users, media_data_usage, form_scripts_enabled
FROM subs JOIN lic ON subs.id = lic.id LEFT JOIN bridge ON customer = bridge.customer_id LEFT JOIN orgs ON organization_id = orgs.id
LEFT JOIN mrr ON customer = mrr.customer_id LEFT JOIN settings ON customer = token""")
def fct_subscriptions(t):
    settings = t.customer.filter("c_acctbal > 0").select(
        _text("cus_", "c_custkey").alias("customer_token"), F.col("c_nationkey").alias("max_users"), F.lit(1).alias("min_users"),
        F.col("c_mktsegment").alias("media_data_usage"), (F.col("c_nationkey") > 9).alias("form_scripts_enabled"))
    return subscriptions.fct_subscriptions(wide_subscriptions(t), products(t), bridge(t), organizations(t), settings, _mrr(t), PAID, EXCLUDED)


@query("""
SELECT l_orderkey AS id, CAST(sum(CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'STANDARD') THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS paid_licenses,
  CAST(sum(CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'STANDARD') THEN CAST(CAST(round(l_extendedprice * 100) AS BIGINT) / 100 AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS total_amount,
  CAST(sum(CASE WHEN nullif(p_type, 'PROMO') NOT IN ('SMALL') THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS total_licenses
FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) <= 3)
LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def slot_licences(t):
    counted = subscriptions.with_licences(wide_subscriptions(t), products(t), PAID, EXCLUDED)
    return counted.select("id", "paid_licenses", F.col("total_amount").cast("double").alias("total_amount"), "total_licenses")


# -- CRM ----------------------------------------------------------------------------------------

def crm_users(t):
    return t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.upper("n_name").alias("first_name"),
                           F.lower("n_name").alias("last_name"), (F.col("n_regionkey") * 7).alias("manager_id"))


def _hours_after(column: str):
    return F.timestamp_seconds(F.lit(1577836800) + F.col(column) * 3600)


@query("""
SELECT c_custkey AS account_id, c_custkey // 5 * 5 AS top_parent_id, c_name AS account_name, n_name AS account_owner, c_mktsegment,
  CASE WHEN c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS is_top_parent,
  CAST(CAST((make_timestamp((1577836800 + c_custkey * 3600) * 1000000) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS VARCHAR) AS created_date
FROM customer JOIN nation ON c_nationkey + 2 = n_nationkey""")
def crm_accounts(t):
    acc = t.customer.select(
        F.col("c_custkey").alias("id"), (F.col("c_nationkey") + 2).alias("owner_id"), F.col("c_name").alias("name"),
        (F.col("c_custkey") - F.col("c_custkey") % 5).alias("top_parent_id"), _hours_after("c_custkey").alias("created_date"), "c_mktsegment")
    return crm.accounts(acc, crm_users(t), columns=["c_mktsegment"])


@query("""
SELECT o_orderkey AS lead_id, n_name AS owner_name, o_orderpriority,
  CAST(CAST(((o_orderdate + INTERVAL 7 HOUR + CAST(o_custkey % 3 AS INTEGER) * INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS VARCHAR) AS created_date
FROM orders JOIN nation ON o_custkey % 30 = n_nationkey WHERE o_orderstatus = 'F'""")
def crm_leads(t):
    moment = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.lit(7) + (F.col("o_custkey") % 3).cast("int"))
    lead = t.orders.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 30).alias("owner_id"), "o_orderpriority",
        (F.col("o_orderstatus") == "F").alias("reporting"), moment.alias("created_date"))
    return crm.leads(lead, crm_users(t), columns=["o_orderpriority"])


def _touch_leads(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
                           .alias("converted_opportunity_id"), F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("converted_date"))


TOUCH_SQL = """
touch AS (SELECT o_orderkey AS id, o_custkey AS opp, date_trunc('quarter', o_orderdate) AS d FROM orders WHERE o_orderpriority <> '5-LOW'),
first_day AS (SELECT opp, min(d) AS d FROM touch GROUP BY 1),
first_lead AS (SELECT touch.opp, max(id) AS lead_id FROM touch JOIN first_day ON touch.opp = first_day.opp AND touch.d = first_day.d GROUP BY 1)"""


@query(f"WITH {TOUCH_SQL} SELECT opp AS opportunity_id, lead_id FROM first_lead")
def first_touch(t):
    return crm.first_touch(_touch_leads(t))


@query(f"""WITH {TOUCH_SQL}
SELECT c_custkey AS opportunity_id, s_suppkey AS account_id, s_name AS account_name, s_suppkey // 4 * 4 AS top_parent_id, c_name AS opportunity_name, c_mktsegment,
  m.n_name AS opportunity_owner_manager, o.n_name AS opportunity_owner, r_name AS record_type_name, lead_id AS lead_id_from_converted_lead,
  CASE WHEN s_suppkey % 4 = 0 THEN 'Yes' ELSE 'No' END AS is_top_parent,
  CAST(CAST((make_timestamp((1577836800 + c_custkey * 3600) * 1000000) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS VARCHAR) AS opportunity_created_date
FROM customer JOIN supplier ON c_custkey % 120 = s_suppkey JOIN region ON c_custkey % 6 = r_regionkey LEFT JOIN first_lead ON c_custkey = opp
LEFT JOIN nation o ON c_nationkey + 2 = o.n_nationkey LEFT JOIN nation m ON o.n_regionkey * 7 = m.n_nationkey""")
def crm_opportunities(t):
    opps = t.customer.select(
        F.col("c_custkey").alias("id"), (F.col("c_custkey") % 120).alias("account_id"), (F.col("c_custkey") % 6).alias("record_type_id"),
        (F.col("c_nationkey") + 2).alias("owner_id"), F.col("c_name").alias("name"), _hours_after("c_custkey").alias("created_date"), "c_mktsegment")
    acc = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), (F.col("s_suppkey") - F.col("s_suppkey") % 4).alias("top_parent_id"))
    kinds = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return crm.opportunities(opps, _touch_leads(t), acc, crm_users(t), kinds, columns=["c_mktsegment"], account_columns=[])


# -- usage --------------------------------------------------------------------------------------

def _org_accounts(t):
    return t.supplier.select(
        F.col("s_suppkey").alias("id"), F.when(F.col("s_acctbal") > 0, _text("org_", "s_suppkey")).alias("app_customer_key"),
        F.col("s_name").alias("account_key"))


@query("""
WITH sync AS (SELECT user_id, 'org_' || event_id % 25 AS org, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
acc AS (SELECT 'org_' || s_suppkey AS org, s_name FROM supplier WHERE s_acctbal > 0 AND s_suppkey NOT IN (3, 7))
SELECT c_custkey AS identifier, c_custkey + 1000 AS id, c_nationkey + 3 AS user_id, n_name AS first_name, sync.org AS organization_id, s_name AS account_key,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_synced_at
FROM customer JOIN sync ON c_custkey = sync.user_id LEFT JOIN nation ON c_nationkey + 3 = n_nationkey LEFT JOIN acc ON sync.org = acc.org""")
def device_report(t):
    registered = t.customer.select((F.col("c_custkey") + 1000).alias("id"), (F.col("c_nationkey") + 3).alias("user_id"), F.col("c_custkey").alias("identifier"))
    syncs = t.events.select(F.col("user_id").alias("identifier"), F.concat(F.lit("org_"), (F.col("event_id") % 25).cast("string")).alias("organization_id"),
                            F.col("ts").alias("loaded_at"), "event_id")
    users = t.nation.select(F.col("n_nationkey").alias("user_id"), F.col("n_name").alias("first_name"))
    return usage.devices(registered, syncs, users, _org_accounts(t), excluded=[3, 7], tie="event_id")


@query("""
SELECT o_custkey AS user_id, 'org_' || n_nationkey AS org_resource_id, CAST(n_nationkey AS BIGINT) AS org_id, s_name AS account_key, c_name AS first_name, r_name AS role_name
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON o_orderkey % 30 = n_nationkey LEFT JOIN region ON o_orderkey % 7 = r_regionkey
LEFT JOIN supplier ON s_suppkey = n_nationkey AND s_acctbal > 0""")
def member_report(t):
    memberships = t.orders.select(F.col("o_custkey").alias("user_id"), (F.col("o_orderkey") % 30).alias("organization_id"), (F.col("o_orderkey") % 7).alias("role_id"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("first_name"))
    orgs = t.nation.select(F.col("n_nationkey").alias("id"), _text("org_", "n_nationkey").alias("resource_id"))
    roles = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return usage.members(users, memberships, orgs, roles, _org_accounts(t))


@query("""
SELECT 'org_' || n_nationkey AS org_resource_id, doc_id AS form_id, doc_id % 30 AS owner_id, n_name AS owner_name, lang, doc_id * 2 AS created_by_id, n_chars AS updated_by_id,
  a.c_name || ' ' || a.c_mktsegment AS created_by_name, b.c_name || ' ' || b.c_mktsegment AS updated_by_name
FROM documents JOIN nation ON doc_id % 30 = n_nationkey LEFT JOIN customer a ON doc_id * 2 = a.c_custkey LEFT JOIN customer b ON n_chars = b.c_custkey""")
def form_report(t):
    form_table = t.documents.select(F.col("doc_id").alias("form_id"), (F.col("doc_id") % 30).alias("owner_id"), "lang",
                                    (F.col("doc_id") * 2).alias("created_by_id"), F.col("n_chars").alias("updated_by_id"))
    orgs = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), _text("org_", "n_nationkey").alias("resource_id"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("first_name"), F.col("c_mktsegment").alias("last_name"))
    return usage.forms(form_table, orgs, users)


@query("""
WITH ord AS (SELECT o_custkey AS k, count(*) AS form_count, CAST(sum(CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2001-07-02' THEN 1 ELSE 0 END) AS BIGINT) AS form_activity FROM orders GROUP BY 1),
recent AS (SELECT user_id AS k, count(DISTINCT event_type) AS devices_synced FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' GROUP BY 1),
feature AS (SELECT user_id AS k, CAST(sum(CASE WHEN value > 150 THEN 1 ELSE 0 END) AS BIGINT) AS feature_uses FROM events GROUP BY 1),
err AS (SELECT DISTINCT 'org_' || user_id AS k FROM events WHERE event_type = 'error' AND value > 100)
SELECT c_custkey AS id, 'org_' || c_custkey AS resource_id, c_nationkey AS token_count, form_count, form_activity, devices_synced, feature_uses, CASE WHEN err.k IS NOT NULL THEN true END AS has_issue,
  CASE WHEN c_nationkey > 0 THEN 'yes' ELSE 'no' END AS api_tokens, CASE WHEN feature_uses > 0 THEN 'yes' ELSE 'no' END AS feature_services,
  CASE WHEN err.k IS NOT NULL THEN 'yes' ELSE 'no' END AS issues, CASE WHEN form_activity > 0 OR devices_synced > 3 THEN 'yes' ELSE 'no' END AS active, s_name AS account_key
FROM customer LEFT JOIN ord ON c_custkey = ord.k LEFT JOIN recent ON c_custkey = recent.k LEFT JOIN feature ON c_custkey = feature.k
LEFT JOIN err ON 'org_' || c_custkey = err.k LEFT JOIN supplier ON c_custkey = s_suppkey AND s_acctbal > 0""")
def adoption_flags(t):
    owners = t.customer.select(F.col("c_custkey").alias("id"), _text("org_", "c_custkey").alias("resource_id"), F.col("c_nationkey").alias("token_count"))
    recent = F.col("ts").cast("date") >= F.date_sub(F.lit("2024-01-30").cast("date"), 10)
    issues = t.events.withColumn("owner", _text("org_", "user_id"))
    activities = [
        (t.orders, usage.Activity("o_custkey", "id", {"form_count": F.count(F.lit(1)), "form_activity": usage.recent_count("o_orderdate", AS_OF)})),
        (t.events, usage.Activity("user_id", "id", {"devices_synced": F.count_distinct("event_type")}, recent)),
        (t.events, usage.Activity("user_id", "id", {"feature_uses": sum_if(F.col("value") > 150)})),
        (issues, usage.Activity("owner", "resource_id", {"has_issue": usage.present()}, (F.col("event_type") == "error") & (F.col("value") > 100))),
    ]
    flags = {
        "api_tokens": usage.positive(F.col("token_count")), "feature_services": usage.positive(F.col("feature_uses")),
        "issues": usage.yes_no(F.col("has_issue").isNotNull()),
        "active": usage.yes_no((F.col("form_activity") > 0) | (F.col("devices_synced") > 3))}
    accounts = _org_accounts(t).select(F.col("app_customer_key").alias("resource_id"), "account_key")
    return usage.adoption(owners, activities, flags, accounts, "resource_id")


@query("""
WITH form AS (SELECT o_custkey AS k, count(*) AS n, CAST(sum(CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2001-07-02' THEN 1 ELSE 0 END) AS BIGINT) AS recent,
                count(*) FILTER (o_orderpriority = '5-LOW') AS empty FROM orders GROUP BY 1),
signed AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-07-02' AND o_orderstatus = 'F' GROUP BY 1),
reg AS (SELECT event_id % 700 AS owner, user_id, event_type FROM events WHERE CAST(ts AS DATE) - 8218 >= DATE '2001-07-02'),
dev AS (SELECT owner AS k, count(DISTINCT event_type) AS n FROM reg GROUP BY 1),
memb AS (SELECT owner AS k, count(DISTINCT reg.user_id) AS n FROM reg JOIN (SELECT DISTINCT o_custkey AS user_id FROM orders WHERE o_orderstatus = 'O') o ON reg.user_id = o.user_id GROUP BY 1),
grp AS (SELECT doc_id AS k, count(*) AS n, CAST(sum(CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END) AS BIGINT) AS features FROM documents GROUP BY 1),
geo AS (SELECT user_id AS k, max(CASE WHEN event_type = 'view' AND value > 60 THEN 1 ELSE 0 END) AS line, max(CASE WHEN event_type = 'click' AND value > 60 THEN 2 END) AS polygon FROM events GROUP BY 1)
SELECT c_custkey AS id, 'org_' || c_custkey AS resource_id, c_nationkey AS api_token_count, form.recent AS forms_activity_last_30_days, form.n AS forms_count, signed.n AS members_sign_in_last_30_days,
  dev.n AS devices_sync_last_30_days, memb.n AS members_sync_last_30_days, CASE WHEN c_nationkey > 0 THEN 'yes' ELSE 'no' END AS api_tokens, CASE WHEN form.n > 0 THEN 'yes' ELSE 'no' END AS workflows,
  CASE WHEN line > 0 THEN 'yes' ELSE 'no' END AS lines, CASE WHEN line > 0 OR polygon > 0 THEN 'yes' ELSE 'no' END AS lines_polygons, CASE WHEN grp.n > 0 THEN 'yes' ELSE 'no' END AS groups,
  CASE WHEN features > 0 THEN 'yes' ELSE 'no' END AS feature_services, CASE WHEN c_acctbal > 5000 THEN 'yes' ELSE 'no' END AS data_views, CASE WHEN labels.doc_id IS NOT NULL THEN 'yes' ELSE 'no' END AS issues_tasks,
  CASE WHEN form.n > 0 THEN 'yes' ELSE 'no' END AS projects, CASE WHEN form.empty > 0 THEN 'yes' ELSE 'no' END AS status_field, s_name AS account_key
FROM customer LEFT JOIN form ON c_custkey = form.k LEFT JOIN signed ON c_custkey = signed.k LEFT JOIN dev ON c_custkey = dev.k LEFT JOIN memb ON c_custkey = memb.k LEFT JOIN grp ON c_custkey = grp.k
LEFT JOIN geo ON c_custkey = geo.k LEFT JOIN (SELECT DISTINCT doc_id FROM labels) labels ON c_custkey = labels.doc_id LEFT JOIN supplier ON c_custkey = s_suppkey AND s_acctbal > 0""")
def adoption_report(t):
    org = lambda column: _text("org_", column)
    big = F.col("value") > 60
    tables = {
        "form_report": t.orders.select(org("o_custkey").alias("org_resource_id"), F.col("o_orderdate").alias("record_changed_at")),
        "member_report": t.orders.filter("o_orderstatus = 'F'").select(org("o_custkey").alias("org_resource_id"), F.col("o_orderdate").alias("last_sign_in_at")),
        "forms": t.orders.select(F.col("o_custkey").alias("owner_id"), F.when(F.col("o_orderpriority") == "5-LOW", "{}").alias("status_field")),
        "workflows": t.orders.select(F.col("o_custkey").alias("owner_id")),
        "projects": t.orders.select(F.col("o_custkey").alias("owner_id")),
        "registrations": t.events.select((F.col("event_id") % 700).alias("owner_id"), F.col("event_type").alias("device_id"), "user_id",
                                         F.date_sub(F.col("ts").cast("date"), 8218).alias("updated_at")),
        "memberships": t.orders.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("user_id")),
        "groups": t.documents.select(org("doc_id").alias("org_id")),
        "flows": t.documents.select(org("doc_id").alias("user_org_id"), (F.col("n_chars") > 1000).alias("user_flag_feature_service_layers_enabled")),
        "form_stats": t.labels.select(org("doc_id").alias("resource_id")),
        "geometry": t.events.select(
            org("user_id").alias("organization_id"), F.when((F.col("event_type") == "view") & big, 1).otherwise(0).alias("line"),
            null_column("int").alias("multi_line"), F.when((F.col("event_type") == "click") & big, 2).alias("polygon"), null_column("int").alias("multi_polygon")),
        "app_subscriptions": t.customer.select(F.col("c_custkey").alias("owner_id"), (F.col("c_acctbal") > 5000).alias("shared_views_enabled")),
    }
    orgs = t.customer.select(F.col("c_custkey").alias("id"), org("c_custkey").alias("resource_id"), F.col("c_nationkey").alias("api_token_count"))
    return usage.adoption_report(orgs, _org_accounts(t).select("app_customer_key", "account_key"), tables, AS_OF)


@query("SELECT c_custkey AS id, count(*) AS workflows_count FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def workflow_counts(t):
    return customers.workflow_counts(t.customer.select(F.col("c_custkey").alias("id")), t.orders.select(F.col("o_custkey").alias("owner_id")))


# -- general report -----------------------------------------------------------------------------

def _seen_before(t):
    orgs = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 5000, F.lit("2001-01-01")).alias("converted_at"))
    memberships = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), (F.col("o_orderkey") * 7 % 1000).alias("organization_id"),
                                  (F.col("o_orderkey") % 9).alias("role_id"))
    roles = t.region.select(F.col("r_regionkey").alias("id"), F.when(F.col("r_regionkey") < 2, "Owner").otherwise(F.col("r_name")).alias("name"))
    return general.owners_seen_before(orgs, memberships, roles, t.customer.select(F.col("c_custkey").alias("user_id")))


SEEN_SQL = """
org AS (SELECT c_custkey AS id, c_acctbal > 5000 AS converted FROM customer),
member AS (SELECT o_orderkey AS id, o_custkey AS user_id, o_orderkey * 7 % 1000 AS org_id, o_orderkey % 9 AS role_id FROM orders),
seen AS (SELECT id FROM org WHERE EXISTS (  -- an owner who has one more membership, and that in a converted organisation
  SELECT 1 FROM member owner JOIN region ON owner.role_id = r_regionkey AND r_regionkey < 2 JOIN customer ON owner.user_id = c_custkey
  JOIN member other ON other.user_id = owner.user_id AND other.id <> owner.id JOIN org paid ON other.org_id = paid.id AND paid.converted
  WHERE owner.org_id = org.id))"""


@query(f"WITH {SEEN_SQL} SELECT id AS organization_id FROM seen")
def repeat_buyer_flag(t):
    return _seen_before(t)


def _active_plans(t):
    people = billing_customers(t).withColumn("metadata_organization_id", F.regexp_replace("id", "cus_", "org_"))
    return general.active_plans(people, wide_subscriptions(t), products(t), _mrr(t), BILLING_URL)


PLANS_SQL = f"""
prod AS (SELECT p_partkey AS id, nullif(p_type, 'PROMO') AS name FROM part),
plans AS (SELECT customer AS customer_id, replace(customer, 'cus_', 'org_') AS app_customer_key, c_name AS customer_email, name AS plan, quantity_0 AS licence_count, subs.status AS plan_status,
  CAST(created + 7 AS VARCHAR) AS trial_end_date, CAST(created + 1 AS VARCHAR) AS slot_created, CAST(created AS VARCHAR) AS created_subscription,
  CAST(coalesce(amount_0, 0) * coalesce(quantity_0, 0) + coalesce(amount_1, 0) * coalesce(quantity_1, 0) + coalesce(amount_2, 0) * coalesce(quantity_2, 0) AS DOUBLE) / 100 AS price,
  CASE WHEN unit_0 = 'month' AND times_0 = 1 THEN 'monthly' WHEN unit_0 = 'month' AND times_0 = 3 THEN 'quarterly' WHEN unit_0 = 'year' THEN 'annualy' ELSE '' END AS billing_frequency,
  mrr, '{BILLING_URL}' || customer AS subscription_link
  FROM subs JOIN prod ON product_0 = prod.id JOIN customer ON customer = 'cus_' || c_custkey LEFT JOIN mrr ON customer = mrr.customer_id WHERE subs.status = 'active' AND name <> 'Developer Pack')"""


@query(f"WITH {SUBS_SQL}, {_mrr_sql(False)}, {PLANS_SQL} SELECT * RENAME (app_customer_key AS metadata_organization_id) FROM plans")
def active_plans(t):
    return _active_plans(t)


def _account_report(t):
    accounts = t.customer.select(
        F.col("c_custkey").alias("id"), _text("org_", "c_custkey").alias("app_customer_key"), _text("K", "c_custkey").alias("account_key"), F.col("c_name").alias("name"),
        F.concat(F.lit("K"), (F.col("c_custkey") % 50).cast("string")).alias("top_parent_key"), (F.col("c_nationkey") + 2).alias("owner_id"), F.col("c_mktsegment").alias("account_type"),
        (F.col("c_nationkey") % 4).alias("owners_manager"), F.when(F.col("c_acctbal") > 0, "gold").alias("account_tier"),
        F.lower("c_mktsegment").alias("industry"), (F.col("c_custkey") % 3).alias("billing_country"))
    opps = t.orders.select(F.col("o_custkey").alias("account_id"), F.col("o_orderkey").alias("opportunity_id"),
                           F.col("o_orderdate").cast("date").alias("subscription_end_date"), F.col("o_orderpriority").alias("subscription_term"),
                           (F.col("o_orderstatus") == "F").alias("created_by_billing"), (F.col("o_orderkey") % 2 == 0).alias("self_serve"))
    return general.account_report(accounts, crm_users(t), opps, "https://crm.example.com/")


ACCOUNTS_SQL = """
opp AS (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
accounts AS (SELECT 'org_' || a.c_custkey AS app_customer_key, 'K' || a.c_custkey AS account_key, a.c_name AS account_name, p.c_name AS top_parent_account, n_nationkey AS owner_id,
  n_name AS account_owner, upper(n_name) AS first_name, lower(n_name) AS last_name, a.c_nationkey % 4 AS owners_manager,
  CASE WHEN a.c_acctbal > 0 THEN 'gold' END AS account_tier, lower(a.c_mktsegment) AS industry, a.c_custkey % 3 AS billing_country,
  o_orderpriority AS subscription_term, o_orderstatus = 'F' AS created_by_billing, o_orderkey % 2 = 0 AS self_serve, a.c_mktsegment AS account_type, 'https://crm.example.com/K' || a.c_custkey || '/view' AS account_url,
  CAST(d AS VARCHAR) AS subscription_end_date
  FROM customer a JOIN customer p ON a.c_custkey % 50 = p.c_custkey JOIN nation ON a.c_nationkey + 2 = n_nationkey JOIN opp ON a.c_custkey = o_custkey)"""


@query(f"WITH {ACCOUNTS_SQL} SELECT * FROM accounts")
def account_report(t):
    return _account_report(t)


@query(f"""WITH {SEEN_SQL}, {SUBS_SQL}, {_mrr_sql(False)}, {PLANS_SQL}, {ACCOUNTS_SQL},
cash AS (SELECT 'org_' || o_custkey AS app_customer_key, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS last_month FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '2001-07' GROUP BY 1)
SELECT c_custkey AS org_id, 'org_' || c_custkey AS app_customer_key, c_name AS organization_name, c_nationkey AS media_usage, accounts.* EXCLUDE (app_customer_key), plans.* EXCLUDE (app_customer_key),
  last_month AS last_month_revenue, seen.id IS NOT NULL AS from_existing_user
FROM customer JOIN accounts ON 'org_' || c_custkey = accounts.app_customer_key LEFT JOIN plans ON 'org_' || c_custkey = plans.app_customer_key
LEFT JOIN cash ON 'org_' || c_custkey = cash.app_customer_key LEFT JOIN seen ON c_custkey = seen.id WHERE c_mktsegment <> 'MACHINERY'""")
def general_report(t):
    orgs = t.customer.select(F.col("c_custkey").alias("id"), _text("org_", "c_custkey").alias("resource_id"), F.col("c_name").alias("organization_name"))
    settings = t.customer.filter("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("owner_id"), F.col("c_nationkey").alias("media_usage"))
    cash = t.orders.filter(F.date_format("o_orderdate", "yyyy-MM") == "2001-07").groupBy(_text("org_", "o_custkey").alias("app_customer_key")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("last_month"))
    return general.general_report(orgs, settings, _active_plans(t), _account_report(t), cash, _seen_before(t), ["organization_name"])


# -- by month -----------------------------------------------------------------------------------

PERIODS = months_list(2000, 3, 2001, 8)
BASE_PRICES = [f"price_{n}" for n in (1, 2, 3, 4)]


def _slot_columns(numbers):
    """Slots of a daily copy or of the current state, from three numbers per row."""
    return [c for n, (price, product, quantity, cents) in enumerate(numbers) for c in (
        F.concat(F.lit("price_"), (price % 10).cast("string")).alias(f"items_data_{n}_price_id"), product.alias(f"items_data_{n}_plan_product"),
        quantity.alias(f"items_data_{n}_quantity"), cents.alias(f"items_data_{n}_plan_amount"))]


def _copies(t):
    """Daily copies of subscriptions: one per line, the supplier being the subscription."""
    part, line, quantity = F.col("l_partkey"), F.col("l_linenumber").cast("bigint"), F.col("l_quantity").cast("bigint")
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    return t.lineitem.select(
        F.col("l_suppkey").alias("id"), F.concat(F.lit("cus_"), (F.col("l_suppkey") % 40).cast("string")).alias("customer"),
        F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("run_date"),
        *_slot_columns([(part, part % 5, quantity, cents), (line, line, quantity + 1, cents * 2), (part + line, part % 3, quantity + 2, cents * 3)]))


def _current(t):
    key = F.col("s_suppkey")
    zero = F.lit(0).cast("bigint")
    return t.supplier.select(
        key.alias("id"), F.concat(F.lit("cus_"), (key % 40).cast("string")).alias("customer"), F.when(key % 4 == 0, "canceled").otherwise("active").alias("status"),
        *_slot_columns([(key, key, key % 11, zero), (key + 3, key + 1, key % 13, zero), (key + 6, key + 2, key % 17, zero)]))


def _plan_names(t):
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def _month_accounts(t):
    return t.supplier.filter("s_acctbal > 3000").select(_text("org_", "s_suppkey").alias("app_customer_key"), F.col("s_name").alias("account_owner"))


CURRENT_SQL = """
cur AS (SELECT s_suppkey AS id, 'cus_' || s_suppkey % 40 AS customer, CASE WHEN s_suppkey % 4 = 0 THEN 'canceled' ELSE 'active' END AS status,
  CASE WHEN s_suppkey % 10 BETWEEN 1 AND 4 THEN s_suppkey WHEN (s_suppkey + 3) % 10 BETWEEN 1 AND 4 THEN s_suppkey + 1 WHEN (s_suppkey + 6) % 10 BETWEEN 1 AND 4 THEN s_suppkey + 2 END AS base_plan,
  CASE WHEN s_suppkey % 10 BETWEEN 1 AND 4 THEN s_suppkey % 11 WHEN (s_suppkey + 3) % 10 BETWEEN 1 AND 4 THEN s_suppkey % 13 WHEN (s_suppkey + 6) % 10 BETWEEN 1 AND 4 THEN s_suppkey % 17 ELSE 0 END AS licenses_count
  FROM supplier),
now_plan AS (SELECT cur.*, p_name AS plan_name FROM cur JOIN part ON base_plan = p_partkey),
who AS (SELECT cust.id AS customer_id, metadata_organization_id AS app_customer_key, coalesce(cust.name, description) AS customer_name, membership_count, s_name AS account_owner
  FROM cust JOIN orgs ON metadata_organization_id = resource_id LEFT JOIN supplier ON s_acctbal > 3000 AND 'org_' || s_suppkey = metadata_organization_id)"""


def _period_columns(value: str) -> str:
    return ", ".join(f"CAST(max(CASE WHEN period = '{p}' THEN {value} END) AS BIGINT) AS \"{p}\"" for p in PERIODS)


@query(f"""WITH {ORGS_SQL}, {CURRENT_SQL},
hist AS (SELECT l_suppkey AS id, strftime(l_shipdate, '%Y-%m') AS period, CASE WHEN l_partkey % 10 BETWEEN 1 AND 4 THEN l_quantity WHEN l_linenumber BETWEEN 1 AND 4 THEN l_quantity + 1
    WHEN (l_partkey + l_linenumber) % 10 BETWEEN 1 AND 4 THEN l_quantity + 2 ELSE 0 END AS seats FROM lineitem
  WHERE day(l_shipdate) = 1 AND l_shipdate BETWEEN TIMESTAMP '2000-02-01' AND TIMESTAMP '2001-08-01'),
avgs AS (SELECT id, period, floor(sum(CAST(seats AS BIGINT)) / count(*) + 0.5) AS seats FROM hist GROUP BY 1, 2)
SELECT avgs.id, status, base_plan, plan_name, licenses_count, who.*, {_period_columns('seats')}
FROM avgs JOIN now_plan ON avgs.id = now_plan.id JOIN who ON now_plan.customer = who.customer_id GROUP BY ALL""")
def seats_by_month(t):
    return monthly.seats_by_month(_copies(t), _current(t), billing_customers(t), _month_accounts(t), organizations(t), _plan_names(t), BASE_PRICES, AS_OF, PERIODS)


@query(f"""WITH {ORGS_SQL}, {CURRENT_SQL},
avgs AS (SELECT 'org_' || l_orderkey % 25 AS app_customer_key, strftime(l_shipdate, '%Y-%m') AS period, floor(sum(CAST(l_quantity AS BIGINT)) / count(*) + 0.5) AS members FROM lineitem
  WHERE day(l_shipdate) = 1 AND l_shipdate BETWEEN TIMESTAMP '2000-02-01' AND TIMESTAMP '2001-08-01' GROUP BY 1, 2)
SELECT who.*, now_plan.id, status, base_plan, plan_name, licenses_count, {_period_columns('members')}
FROM avgs JOIN who ON avgs.app_customer_key = who.app_customer_key JOIN now_plan ON now_plan.customer = who.customer_id GROUP BY ALL""")
def members_by_month(t):
    stats = t.lineitem.select(F.concat(F.lit("org_"), (F.col("l_orderkey") % 25).cast("string")).alias("resource_id"),
                              F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("export_date"), F.col("l_quantity").cast("bigint").alias("membership_count"))
    history = stats.withColumnRenamed("membership_count", "members")
    return monthly.members_by_month(history.withColumnRenamed("members", "membership_count"), _current(t), billing_customers(t), _month_accounts(t), organizations(t),
                                    _plan_names(t), BASE_PRICES, AS_OF, PERIODS)


@query(f"""WITH {ORGS_SQL}, {CURRENT_SQL},
every_name AS (SELECT l_linenumber AS id, max(l_returnflag || l_linestatus) AS name, CAST(l_shipdate AS DATE) AS d FROM lineitem GROUP BY 1, 3),
names AS (SELECT * FROM every_name WHERE name IN ('AO', 'NO', 'RF')),
hist AS (SELECT l_suppkey AS id, strftime(l_shipdate, '%Y-%m') AS period, coalesce(a.name, b.name, c.name) AS plan_name,
    CASE WHEN a.name IS NOT NULL THEN 1 WHEN b.name IS NOT NULL THEN 2 ELSE 3 END * round(l_extendedprice * 100) / 100 AS amount
  FROM lineitem LEFT JOIN names a ON l_partkey % 5 = a.id AND CAST(l_shipdate AS DATE) = a.d LEFT JOIN names b ON l_linenumber = b.id AND CAST(l_shipdate AS DATE) = b.d
    LEFT JOIN names c ON l_partkey % 3 = c.id AND CAST(l_shipdate AS DATE) = c.d
  WHERE (a.name IS NOT NULL OR b.name IS NOT NULL OR c.name IS NOT NULL) AND strftime(l_shipdate, '%Y-%m') BETWEEN '2000-02' AND '2001-08'),
avgs AS (SELECT id, period, plan_name, floor(CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DECIMAL(28,4)) / count(*) + 0.5) AS price FROM hist GROUP BY 1, 2, 3)
SELECT avgs.id, plan_name, who.*, {_period_columns('price')} FROM avgs JOIN cur ON avgs.id = cur.id JOIN who ON cur.customer = who.customer_id GROUP BY ALL""")
def prices_by_month(t):
    product_history = t.lineitem.groupBy(F.col("l_linenumber").alias("id"), F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("run_date")).agg(
        F.max(F.concat("l_returnflag", "l_linestatus")).alias("name"))
    return monthly.prices_by_month(_copies(t), product_history, _current(t), billing_customers(t), _month_accounts(t), organizations(t), AS_OF, ["AO", "NO", "RF"], PERIODS)


# -- status, book, touchpoints ------------------------------------------------------------------

def _status_subscriptions(t):
    gone = F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 300).cast("int"))
    open_status = F.when(F.col("o_orderpriority") == "5-LOW", "past_due").when(F.col("o_orderpriority") == "2-HIGH", "trialing").otherwise("active")
    return t.orders.select(
        F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("listed"),
        F.when(F.col("o_orderstatus") != "P", "canceled").otherwise(open_status).alias("status"),
        F.when(F.col("o_orderstatus") != "P", F.unix_timestamp(gone.cast("timestamp"))).alias("canceled_at"))


STATUS_SQL = """
s AS (SELECT o_custkey AS c, o_orderkey AS k, CASE WHEN o_orderstatus <> 'P' THEN 'canceled' WHEN o_orderpriority = '5-LOW' THEN 'past_due' WHEN o_orderpriority = '2-HIGH' THEN 'trialing' ELSE 'active' END AS status,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 300 AS INTEGER) AS gone FROM orders),
st AS (SELECT c AS customer_id, count(*) AS n_subscriptions, CASE WHEN count(*) = count(*) FILTER (status = 'canceled') THEN 'canceled' ELSE arg_max(status, k) FILTER (status <> 'canceled') END AS status,
  CASE WHEN count(*) = count(*) FILTER (status = 'canceled') THEN CAST(max(gone) + 93 AS VARCHAR) ELSE '' END AS delete_by FROM s GROUP BY 1)"""


@query(f"WITH {STATUS_SQL} SELECT * FROM st", name="customer_status")
def statuses(t):
    return status.customer_status(_status_subscriptions(t), "listed")


@query(f"WITH {STATUS_SQL} SELECT customer_id, status, delete_by FROM st JOIN customer ON customer_id = c_custkey WHERE NOT (status = 'active' AND c_mktsegment = 'BUILDING')")
def status_updates(t):
    known = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("customer_id"), F.lit("active").alias("status"), F.lit("").alias("delete_by"))
    return status.status_updates(status.customer_status(_status_subscriptions(t), "listed"), known)


BOOK_MONTHS = months_list(2000, 7, 2001, 8)


def _book_accounts(t):
    accounts = t.customer.select(F.col("c_custkey").alias("account_id"), _text("C", "c_custkey").alias("app_customer_key"), F.col("c_name").alias("account_name"))
    changes = t.events.select(F.col("user_id").alias("account_id"), F.when(F.col("event_type") == "purchase", "Owner").otherwise("Name").alias("field"),
                              F.col("props").alias("old_value"), (F.col("ts").cast("timestamp") - F.expr("INTERVAL 276 MONTHS")).alias("created_date"), "event_id")
    return book.owner_changes(accounts, changes, tie="event_id")


OWNER_SQL = """
chg AS (SELECT user_id, props, CAST(((ts - INTERVAL 276 MONTH) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS d FROM events WHERE event_type = 'purchase'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
acc AS (SELECT c_custkey AS account_id, 'C' || c_custkey AS app_customer_key, c_name AS account_name, props AS previous_owner, d AS last_owner_change FROM customer LEFT JOIN chg ON c_custkey = user_id)"""


@query(f"WITH {OWNER_SQL} SELECT * REPLACE (CAST(last_owner_change AS VARCHAR) AS last_owner_change) FROM acc")
def owner_changes(t):
    return _book_accounts(t)


def _mark_sql(name: str, label: str, source: str) -> str:
    def mark(low: str, high: str) -> str:
        return (f"coalesce(max(CASE WHEN month BETWEEN CASE WHEN last_owner_change > DATE '{low}' THEN last_owner_change ELSE DATE '{low}' END AND DATE '{high}' THEN mrr ELSE 0 END), 0)")
    sums = ", ".join(f"sum(CASE WHEN strftime(month, '%Y-%m') = '{m}' THEN mrr END) AS \"{label}_{m}\"" for m in BOOK_MONTHS)
    return f"""{name} AS (SELECT coalesce(customer, 'null') AS k, {mark('2000-09-01', '2001-08-01')} AS this_{label}, {mark('2000-08-01', '2001-07-01')} AS last_{label}, {sums}
  FROM {source} LEFT JOIN acc ON customer = app_customer_key GROUP BY 1)"""


def _book_outputs() -> str:
    def pair(a, b, name):
        return f"CAST(coalesce({a}, 0) AS DOUBLE) AS \"rgr_{name}\", CAST(coalesce({b}, 0) AS DOUBLE) AS \"msp_{name}\", CAST(coalesce({a}, 0) + coalesce({b}, 0) AS DOUBLE) AS \"total_{name}\""
    recent = BOOK_MONTHS[-13:]
    out = [pair(f'"rgr_{m}"', f'"msp_{m}"', m) for m in BOOK_MONTHS] + [pair(f'"rgr_{m}"', f'"msp_{m}"', str(12 - i)) for i, m in enumerate(recent)]
    for w in ("last", "this"):
        out.append(f"CAST({w}_rgr AS DOUBLE) AS high_water_{w}_month_license, CAST(coalesce({w}_msp, 0) AS DOUBLE) AS high_water_{w}_month_msp, "
                   f"CAST({w}_rgr + coalesce({w}_msp, 0) AS DOUBLE) AS high_water_{w}_month_total")
    return ", ".join(out)


def _books(t):
    licences = t.orders.select(F.when(F.col("o_custkey") % 50 != 0, _text("C", "o_custkey")).alias("customer"),
                               F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"), F.col("o_totalprice").alias("mrr"))
    services = t.lineitem.filter("l_returnflag = 'R'").select(
        _text("C", "l_partkey").alias("customer"), F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month"), F.col("l_extendedprice").alias("mrr"))
    return licences, services


BOOKS_SQL = """
lic AS (SELECT CASE WHEN o_custkey % 50 <> 0 THEN 'C' || o_custkey END AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(o_totalprice AS DECIMAL(18,2)) AS mrr FROM orders),
srv AS (SELECT 'C' || l_partkey AS customer, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(l_extendedprice AS DECIMAL(18,2)) AS mrr FROM lineitem WHERE l_returnflag = 'R')"""


@query(f"""WITH {OWNER_SQL}, {BOOKS_SQL},
{_mark_sql('a', 'rgr', 'lic')}, {_mark_sql('b', 'msp', 'srv')}
SELECT a.k AS customer_key, account_id, account_name, previous_owner, CAST(last_owner_change AS VARCHAR) AS last_owner_change, {_book_outputs()}
FROM a LEFT JOIN b ON a.k = b.k LEFT JOIN acc ON a.k = app_customer_key""", name="high_water_mark")
def revenue_book(t):
    licences, services = _books(t)
    return book.revenue_book(licences, services, _book_accounts(t), BOOK_MONTHS)


@query(f"""WITH {OWNER_SQL}, {BOOKS_SQL}, {_mark_sql('a', 'rgr', 'lic')}, {_mark_sql('b', 'msp', 'srv')}
SELECT 'licence' AS book, k AS customer_key, CAST(this_rgr AS DOUBLE) AS this_month, CAST(last_rgr AS DOUBLE) AS last_month FROM a
UNION ALL SELECT 'service', k, CAST(this_msp AS DOUBLE), CAST(last_msp AS DOUBLE) FROM b""")
def high_water_marks_kept(t):
    """Marks out of states that first held half of what each month of 2001 brought, and a day later all of it."""
    day, accounts, parts = dt.datetime(2001, 8, 1), _book_accounts(t), []
    licences, services = _books(t)
    this_month = book.current_month(licences)
    for name, rows in (("licence", licences), ("service", services)):
        state, new = work_folder(t.spark, "marks"), F.col("month") >= "2001-01-01"
        half = rows.withColumn("mrr", F.when(new, F.col("mrr") / 2).otherwise(F.col("mrr")))
        kept.update_marks(half, state, day, buckets=16)
        kept.update_marks(rows.filter(new), state, day + dt.timedelta(days=1))
        marks = kept.kept_marks(t.spark, state, accounts, name, this_month)
        parts.append(marks.select(F.lit(name).alias("book"), "customer_key", *[
            F.col(f"high_water_{when}_month_{name}").cast("double").alias(f"{when}_month") for when in ("this", "last")]))
    return parts[0].unionByName(parts[1])


@query("""
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k, value AS amount, CAST(NULL AS VARCHAR) AS nested,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS date_created_at, strftime((date_trunc('second', ts) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d %H:%M:%S') AS created_at,
  strftime(ts, '%Y%m%d') AS run_date
FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""", name="touchpoints")
def newest_touchpoints(t):
    document = F.concat(
        F.lit('{"Id": "'), F.col("event_id").cast("string"), F.lit('", "Type": "'), F.col("event_type"), F.lit('", "Amount": '), F.col("value").cast("string"),
        F.lit(', "Detail": '), F.col("props"), F.lit(', "CreatedDate": "'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('.000+00:00"}'))
    raw = t.events.select(document.alias("json_data"), F.date_format("ts", "yyyyMMddHHmmss").alias("run_date"))
    return touchpoints.touchpoints(raw, {"id": "Id", "kind": "Type", "k": ("Detail.k", "bigint"), "amount": ("Amount", "double"), "nested": "Detail",
                                         "created_at": ("CreatedDate", "moment")})


@query("""
SELECT event_type AS "Type", CAST(NULL AS VARCHAR) AS "type_in_lower_case", strftime(ts, '%Y%m%d') AS run_date, count(*) AS n FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY ALL""", name="campaigns")
def newest_campaigns(t):
    raw = t.events.select(F.to_json(F.struct(F.col("event_type").alias("Type"))).alias("json_data"), F.date_format("ts", "yyyyMMddHHmmss").alias("run_date"))
    staged = touchpoints.campaigns(raw, {"Type": "Type", "type_in_lower_case": "type"})
    return staged.groupBy("Type", "type_in_lower_case", "run_date").agg(F.count(F.lit(1)).alias("n"))


# -- the standard columns, and reports on staged sources ------------------------------------------

def _documents_of(t, fields, values):
    """One document per event, with a value for every field."""
    body = F.to_json(F.struct(*[values(path, kind).alias(path) for path, kind in {path: kind for path, kind in fields.values()}.items()]))
    return t.events.select(body.alias("json_data"), F.date_format("ts", "yyyyMMddHHmmss").alias("run_date"))


NEWEST = "FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"


@query("SELECT " + ", ".join(f"'{path}#' || event_id AS \"{name}\"" for name, (path, _) in touchpoints.CAMPAIGN_FIELDS.items())
       + ", strftime(ts, '%Y%m%d') AS run_date " + NEWEST)
def campaigns_standard(t):
    raw = _documents_of(t, touchpoints.CAMPAIGN_FIELDS, lambda path, kind: F.concat(F.lit(f"{path}#"), F.col("event_id").cast("string")))
    return touchpoints.campaigns(raw)


def _touch_sql():
    columns = []
    for k, (name, (path, kind)) in enumerate(touchpoints.TOUCHPOINT_FIELDS.items()):
        if kind == "moment":
            utc = f"(TIMESTAMP '2024-01-01 03:30:00' + CAST(event_id + {k} AS INTEGER) * INTERVAL 1 HOUR)"
            columns += [f"strftime({utc}, '%Y-%m-%d') AS \"date_{name}\"",
                        f"strftime(({utc} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d %H:%M:%S') AS \"{name}\""]
        else:
            value = {"double": f"CAST(event_id + {k} AS DOUBLE) / 4", "bigint": f"CAST(event_id + {k} AS BIGINT)"}.get(kind, f"'{path}#' || event_id")
            columns.append(f"{value} AS \"{name}\"")
    return "SELECT " + ", ".join(columns) + ", strftime(ts, '%Y%m%d') AS run_date " + NEWEST


@query(_touch_sql())
def touchpoints_standard(t):
    place = {path: k for k, (path, _) in enumerate(touchpoints.TOUCHPOINT_FIELDS.values())}

    def value(path, kind):
        number = F.col("event_id") + place[path]
        moment = F.timestamp_seconds(F.lit(1704079800) + number * 3600)
        return {"double": number / 4, "bigint": number, "moment": F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSXX")}.get(
            kind, F.concat(F.lit(f"{path}#"), F.col("event_id").cast("string")))

    return touchpoints.touchpoints(_documents_of(t, touchpoints.TOUCHPOINT_FIELDS, value))


def _crm_sources(t):
    """CRM sources under their raw names, with a value in every column the reports show."""
    def raw(df, id_, owner, name, more, shown):
        known = {c for c, _ in more}
        return df.select(id_.alias("Id"), owner.alias("OwnerId"), *([name.alias("Name")] if name is not None else []), *[v.alias(c) for c, v in more],
                         *[F.concat(F.lit(f"{c}-"), id_.cast("string")).alias(c) for c in shown if c not in known])

    def sources_of(view, shown):
        renames = {new: old for old, new in staging.STAGING[view].renames.items()}
        return [renames.get(c, c) for c in shown]

    day = _hours_after("c_custkey")
    return staging.stage_all({
        "crm_accounts": raw(t.customer, F.col("c_custkey"), F.col("c_nationkey") + 2, F.col("c_name"), [
            ("Top_Parent_Account_ID__c", F.col("c_custkey") - F.col("c_custkey") % 5), ("CreatedDate", day)], sources_of("crm_accounts", crm.ACCOUNT_COLUMNS)),
        "crm_leads": raw(t.orders, F.col("o_orderkey"), F.col("o_custkey") % 30, None, [
            ("ConvertedOpportunityId", F.col("o_custkey")), ("ConvertedDate", F.col("o_orderdate").cast("date")),
            ("GBQ_Reporting_Lead__c", F.col("o_orderstatus") == "F"), ("CreatedDate", F.col("o_orderdate").cast("timestamp"))],
            sources_of("crm_leads", crm.LEAD_COLUMNS)),
        "crm_opportunities": raw(t.customer, F.col("c_custkey"), F.col("c_nationkey") + 2, F.col("c_name"), [
            ("AccountId", F.col("c_custkey") % 120), ("RecordTypeId", F.col("c_custkey") % 6), ("CreatedDate", day)],
            sources_of("crm_opportunities", crm.OPPORTUNITY_COLUMNS)),
        "crm_users": t.nation.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Name"), (F.col("n_regionkey") * 7).alias("ManagerId"))})


def _local_day(hours: str) -> str:
    return f"CAST(CAST((make_timestamp((1577836800 + {hours} * 3600) * 1000000) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS VARCHAR)"


def _shown_sql(view: str, shown, key: str) -> str:
    renames = {new: old for old, new in staging.STAGING[view].renames.items()}
    return ", ".join(f"'{renames.get(c, c)}-' || {key} AS \"{c}\"" for c in shown)


@query(f"""SELECT c_custkey AS account_id, c_custkey // 5 * 5 AS top_parent_id, c_name AS account_name, n_name AS account_owner,
  {_shown_sql('crm_accounts', crm.ACCOUNT_COLUMNS, 'c_custkey')}, CASE WHEN c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS is_top_parent,
  {_local_day('c_custkey')} AS created_date FROM customer JOIN nation ON c_nationkey + 2 = n_nationkey""")
def crm_accounts_staged(t):
    views = _crm_sources(t)
    return crm.accounts(views["crm_accounts"], views["crm_users"])


_LEAD_TEXTS = [c for c in crm.LEAD_COLUMNS if c not in ("converted_opportunity_id", "converted_date", "reporting")]


@query(f"""SELECT o_orderkey AS lead_id, n_name AS owner_name, {_shown_sql('crm_leads', _LEAD_TEXTS, 'o_orderkey')}, o_custkey AS converted_opportunity_id,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS converted_date, true AS reporting,
  CAST(CAST((o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE) AS VARCHAR) AS created_date
  FROM orders JOIN nation ON o_custkey % 30 = n_nationkey WHERE o_orderstatus = 'F'""")
def crm_leads_staged(t):
    views = _crm_sources(t)
    return crm.leads(views["crm_leads"], views["crm_users"])


@query(f"""WITH touch AS (SELECT o_custkey AS opp, arg_max(o_orderkey, (- epoch(date_trunc('day', o_orderdate)), o_orderkey)) AS lead_id FROM orders GROUP BY 1)
SELECT o.c_custkey AS opportunity_id, o.c_custkey % 120 AS account_id, a.c_name AS account_name, a.c_custkey // 5 * 5 AS top_parent_id, o.c_name AS opportunity_name,
  {_shown_sql('crm_opportunities', crm.OPPORTUNITY_COLUMNS, 'o.c_custkey')}, {_shown_sql('crm_accounts', crm.OPPORTUNITY_ACCOUNT_COLUMNS, 'a.c_custkey')},
  m.n_name AS opportunity_owner_manager, n.n_name AS opportunity_owner, r_name AS record_type_name, lead_id AS lead_id_from_converted_lead,
  CASE WHEN a.c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS is_top_parent, {_local_day('o.c_custkey')} AS opportunity_created_date
FROM customer o JOIN customer a ON o.c_custkey % 120 = a.c_custkey JOIN region ON o.c_custkey % 6 = r_regionkey LEFT JOIN touch ON touch.opp = o.c_custkey
LEFT JOIN nation n ON o.c_nationkey + 2 = n.n_nationkey LEFT JOIN nation m ON n.n_regionkey * 7 = m.n_nationkey""")
def crm_opportunities_staged(t):
    views = _crm_sources(t)
    shown = views["crm_accounts"].withColumns({c: F.concat(F.lit(f"{c}-"), F.col("id").cast("string")) for c in ("Top_Parent_Account_Name__c",)})
    kinds = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return crm.opportunities(views["crm_opportunities"], views["crm_leads"], shown, views["crm_users"], kinds)
