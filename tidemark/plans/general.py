"""General report: organisations with plan, account, latest opportunity and repeat ownership."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import billing_period, link
from tidemark.operators.joins import hierarchy_join, latest_join
from tidemark.plans.subscriptions import SLOTS

# Interval labels of the general report (spelled like this), the plan it leaves out
# and the role that owns an organisation.
REPORT_PERIODS = {
    ("month", 1): "monthly",
    ("month", 3): "quarterly",
    ("month", 6): "semiannualy",
    ("year", 1): "annualy",
}
#: Columns of accounts and of their newest opportunity that the report shows as they are.
ACCOUNT_COLUMNS = ("owners_manager", "account_tier", "industry", "account_type", "billing_country")
OPPORTUNITY_COLUMNS = ("subscription_term", "created_by_billing", "self_serve")
LEFT_OUT_PLAN = "Developer Pack"
OWNER_ROLE = "owner"


def active_plans(customers: DataFrame, subs: DataFrame, products: DataFrame, mrr: DataFrame,
                 billing_url: str = "") -> DataFrame:
    """Customers with their active subscription: plan, price over three slots, interval, revenue.

    The plan must have a known name other than the one left out, so both joins are inner joins.
    """
    parts = [F.coalesce(f"items_data_{n}_plan_amount", F.lit(0)).cast("decimal(18,2)")
             * F.coalesce(f"items_data_{n}_quantity", F.lit(0)).cast("decimal(18,2)") for n in SLOTS]
    price = (reduce(lambda a, b: a + b, parts) / 100).cast("double")
    plans = products.filter(F.col("name") != LEFT_OUT_PLAN).select(
        F.col("id").alias("items_data_0_plan_product"), F.col("name").alias("plan"))
    active = subs.filter(F.col("status") == "active").join(plans, "items_data_0_plan_product").select(
        F.col("customer").alias("customer_id"), "plan", F.col("items_data_0_quantity").alias("licence_count"),
        F.col("status").alias("plan_status"), F.col("trial_end").alias("trial_end_date"),
        F.col("items_data_0_created").alias("slot_created"), F.col("created").alias("created_subscription"), price.alias("price"),
        billing_period("items_data_0_plan_interval", "items_data_0_plan_interval_count", REPORT_PERIODS, "")
        .alias("billing_frequency"))
    people = customers.select(F.col("id").alias("customer_id"), "metadata_organization_id",
                              F.col("email").alias("customer_email"))
    return (people.join(active, "customer_id").join(mrr.select("customer_id", "mrr"), "customer_id", "left")
            .withColumn("subscription_link", link(billing_url, "customer_id")))


def account_report(accounts: DataFrame, users: DataFrame, opps: DataFrame, account_url: str = "",
                   tie: str = "opportunity_id", account_columns: Sequence[str] = ACCOUNT_COLUMNS,
                   opportunity_columns: Sequence[str] = OPPORTUNITY_COLUMNS) -> DataFrame:
    """Accounts with top parent, owner and latest opportunity; accounts that lack one are left out.

    accounts(id, app_customer_key, account_key, name, top_parent_key, owner_id, `account_columns`),
    users(id, name, first_name, last_name), opps(account_id, opportunity_id, subscription_end_date,
    `opportunity_columns`).
    """
    whole = hierarchy_join(accounts, "top_parent_key", "account_key", ["name"])
    owners = users.select(F.col("id").alias("owner_id"), F.col("name").alias("account_owner"), "first_name", "last_name")
    newest = opps.withColumnRenamed("account_id", "id")
    joined = latest_join(whole.join(owners, "owner_id"), newest, "id",
                         [F.desc("subscription_end_date"), F.desc(tie)])
    shown = ["owner_id", "account_owner", "first_name", "last_name", *account_columns, *opportunity_columns]
    keys = ["app_customer_key", "account_key", "name", "parent_name", *shown]
    return joined.groupBy(*keys).agg(F.max("subscription_end_date").alias("subscription_end_date")).select(
        "app_customer_key", "account_key", F.col("name").alias("account_name"), F.col("parent_name").alias("top_parent_account"),
        *shown, link(account_url, "account_key", "/view").alias("account_url"), "subscription_end_date")


def owners_seen_before(orgs: DataFrame, memberships: DataFrame, roles: DataFrame, users: DataFrame) -> DataFrame:
    """Organisations with an owner who also belongs to another converted organisation.

    orgs(id, converted_at), memberships(id, user_id, organization_id, role_id), roles(id, name),
    users(user_id).  For a converted organisation the owner needs two converted ones, else one.
    """
    converted = orgs.select(F.col("id").alias("organization_id"), F.col("converted_at").isNotNull().alias("_converted"))
    known = memberships.join(converted, "organization_id")
    counts = known.filter("_converted").groupBy("user_id").agg(F.count("id").alias("_converted_orgs"))
    owner_roles = roles.filter(F.lower("name") == OWNER_ROLE).select(F.col("id").alias("role_id"))
    # An owner without any converted organisation can meet neither rule, so the join may be an inner one.
    owned = (known.join(owner_roles, "role_id").join(users.select("user_id"), "user_id", "left_semi")
             .join(counts, "user_id"))
    seen = owned.filter(F.when(F.col("_converted"), F.col("_converted_orgs") > 1).otherwise(F.col("_converted_orgs") > 0))
    return seen.select("organization_id").distinct()


def general_report(orgs: DataFrame, app_subs: DataFrame, plans: DataFrame, accounts: DataFrame,
                   revenue: DataFrame, seen_before: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Organisations with app settings, active plan, account, last month's revenue and a flag.

    orgs(id, resource_id, `columns`), app_subs(owner_id, ...), plans and accounts as returned above,
    revenue(app_customer_key, last_month), seen_before(organization_id).
    """
    settings = app_subs.withColumnRenamed("owner_id", "org_id")
    base = orgs.select(F.col("id").alias("org_id"), F.col("resource_id").alias("app_customer_key"), *columns).join(
        settings, "org_id")
    flagged = base.join(seen_before.select(F.col("organization_id").alias("org_id"), F.lit(True).alias("_seen")),
                        "org_id", "left")
    paying = plans.withColumnRenamed("metadata_organization_id", "app_customer_key")
    last_month = revenue.select("app_customer_key", F.col("last_month").alias("last_month_revenue"))
    full = (flagged.join(accounts, "app_customer_key").join(paying, "app_customer_key", "left")
            .join(last_month, "app_customer_key", "left"))
    return full.withColumn("from_existing_user", F.coalesce("_seen", F.lit(False))).drop("_seen")
