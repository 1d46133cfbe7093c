"""Subscription dimension and fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import billing_period, from_cents, link, safe_add
from tidemark.operators.joins import role_join
from tidemark.plans.customers import ORG_COUNTERS

SLOTS = (0, 1, 2)

# Plans that are paid for by the seat, and plans whose seats do not count at all.  Plans that
# were made for one customer are for the caller to add.
BASE_PLANS = ("Enterprise", "Professional", "Professional 2019", "Essentials", "Essentials 2019", "Starter")
UNCOUNTED_PLANS = (
    "Developer", "Developer Pack", "Data Block", "Professional Services", "Managed Services",
    "Professional Service PDF Report Template",
)

# Interval labels of the subscription fact, in order of precedence.
FACT_PERIODS = {
    ("month", 1): "monthly",
    ("month", 3): "quarterly",
    ("month", 6): "biannually",
    ("year", None): "annually",
}


def dim_subscriptions(subs: DataFrame, products: DataFrame, customers: DataFrame, bridge: DataFrame,
                      orgs: DataFrame, app_subs: DataFrame, billing_url: str = "") -> DataFrame:
    """Subscriptions with the product names of their three slots and their organisation.

    subs(id, customer, ..., items_data_<n>_plan_product), products(id, name).  Subscriptions
    without customer, organisation or app subscription are left out.
    """
    slim = subs.select(
        F.col("id").alias("billing_subscription_key"), F.col("customer").alias("billing_customer_key"),
        "collection_method", "currency", "plan_active", "plan_interval", "status",
        F.col("trial_end").alias("trial_end_date"), *[f"items_data_{n}_plan_product" for n in SLOTS])
    named = role_join(slim, products, {f"plan_{n}": f"items_data_{n}_plan_product" for n in SLOTS}, "id", ["name"])
    pairs = bridge.select(F.col("customer_id").alias("billing_customer_key"),
                          F.col("organization_id").alias("org_id")).distinct()
    known = customers.select(F.col("id").alias("billing_customer_key"))
    places = orgs.select(F.col("id").alias("org_id"), *ORG_COUNTERS, F.col("created_at").alias("signed_up_date"))
    usage = app_subs.select(F.col("owner_id").alias("org_id"), "media_data_usage", "form_scripts_enabled")
    linked = named.join(known, "billing_customer_key").join(pairs, "billing_customer_key")
    full = linked.join(places, "org_id").join(usage, "org_id")
    return full.select(
        "billing_subscription_key", "billing_customer_key", "collection_method", "currency", "plan_active",
        "plan_interval", "status", *[f"plan_{n}_name" for n in SLOTS], *ORG_COUNTERS, "signed_up_date",
        "trial_end_date", "media_data_usage", "form_scripts_enabled",
        link(billing_url, "billing_subscription_key").alias("billing_subscription_link"))


def _sum_known(values: list[Column]) -> Column:
    """Sum of the values that are known, NULL if none is."""
    return F.when(F.coalesce(*values).isNotNull(), safe_add(*values))


def with_licences(subs: DataFrame, products: DataFrame, paid_names: Sequence[str] = BASE_PLANS,
                  excluded_names: Sequence[str] = UNCOUNTED_PLANS) -> DataFrame:
    """Subscriptions with paid and total licences and the paid amount over their three slots.

    Subscriptions without a product in any slot are left out; a slot whose product has no name
    counts neither as paid nor in the total.  The slots of a subscription stay in its row: the
    product names are looked up once per slot, and nothing is grouped or joined back.
    """
    held = subs.filter(F.coalesce(*[F.col(f"items_data_{n}_plan_product") for n in SLOTS]).isNotNull())
    named = role_join(held, products, {f"_slot_{n}": f"items_data_{n}_plan_product" for n in SLOTS}, "id", ["name"])

    def over_slots(chosen, value) -> Column:
        return _sum_known([
            F.when(F.col(f"items_data_{n}_plan_product").isNotNull(),
                   F.when(chosen(F.col(f"_slot_{n}_name")), value(n)).otherwise(F.lit(0))) for n in SLOTS])

    def quantity(n: int) -> Column:
        return F.col(f"items_data_{n}_quantity")

    def amount(n: int) -> Column:
        return from_cents(f"items_data_{n}_plan_amount").cast("decimal(18,2)")

    counted = named.withColumns({
        "paid_licenses": over_slots(lambda name: name.isin(*paid_names), quantity),
        "total_amount": over_slots(lambda name: name.isin(*paid_names), amount),
        "total_licenses": over_slots(lambda name: ~name.isin(*excluded_names), quantity)})
    return counted.drop(*[f"_slot_{n}_name" for n in SLOTS])


def fct_subscriptions(subs: DataFrame, products: DataFrame, bridge: DataFrame, orgs: DataFrame, app_subs: DataFrame,
                      mrr: DataFrame, paid_names: Sequence[str] = BASE_PLANS,
                      excluded_names: Sequence[str] = UNCOUNTED_PLANS) -> DataFrame:
    """Subscriptions with licences, billing interval, organisation, revenue and app settings, each row once.

    The subscriptions are made distinct after their columns are reduced to those of the fact, and so is each table
    looked up, so that no other column is read or shuffled.
    """
    interval = F.when(F.col("plan_interval") == "month", "monthly").otherwise(
        billing_period("items_data_0_plan_interval", "items_data_0_plan_interval_count", FACT_PERIODS))
    paid, whole = F.col("paid_licenses"), F.col("total_licenses")
    facts = with_licences(subs, products, paid_names, excluded_names).select(
        F.col("id").alias("billing_subscription_key"), F.col("customer").alias("billing_customer_key"),
        interval.alias("plan_interval"), "status",
        *[F.col(c).cast("date").alias(c) for c in ("current_period_start", "current_period_end", "created", "ended_at")],
        "collection_method",
        F.round(paid).cast("bigint").alias("paid_licenses"),
        F.round(whole - paid).cast("bigint").alias("unpaid_licenses"),
        F.round(whole).cast("bigint").alias("total_licenses"),
        F.col("total_amount").cast("double").alias("total_amount")).distinct()
    pairs = bridge.select(F.col("customer_id").alias("billing_customer_key"), "organization_id").distinct()
    places = orgs.select(F.col("id").alias("organization_id"), F.col("resource_id").alias("app_customer_key"),
                         "industry_name", *ORG_COUNTERS, F.col("created_at").alias("signed_up_date"))
    by_customer = pairs.join(places, "organization_id").drop("organization_id")
    revenue = mrr.select(F.col("customer_id").alias("billing_customer_key"), "mrr")
    settings = app_subs.select(F.col("customer_token").alias("billing_customer_key"), "max_users", "min_users",
                               "media_data_usage", "form_scripts_enabled")
    full = facts
    for part in (by_customer, revenue, settings):
        full = full.join(part.distinct(), "billing_customer_key", "left")
    return full.select(
        "app_customer_key", "billing_subscription_key", "billing_customer_key", "plan_interval", "status",
        "current_period_start", "current_period_end", "created", "ended_at", "collection_method",
        "paid_licenses", "unpaid_licenses", "total_licenses", "total_amount", "mrr", "industry_name",
        *ORG_COUNTERS, "signed_up_date", "max_users", "min_users", "media_data_usage",
        "form_scripts_enabled")
