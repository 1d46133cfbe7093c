"""Customer dimension, customer fact and per-owner counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import link
from tidemark.operators.joins import bridge_join

ORG_COUNTERS = ["membership_count", "active_device_count", "form_count", "record_count"]


def dim_customers(customers: DataFrame, bridge: DataFrame, orgs: DataFrame, app_url: str = "",
                  billing_url: str = "") -> DataFrame:
    """Billing customers with their organisation; customers without one are left out.

    customers(id, email, metadata_organization_id), bridge(customer_id, organization_id), orgs(id,
    resource_id, name, locality, region, country, created_by_id, company_size, created_at).
    """
    places = orgs.filter(F.col("resource_id").isNotNull()).select(
        F.col("id").alias("organization_id"), "resource_id", "name", "locality", "region", "country",
        "created_by_id", "company_size", "created_at")
    people = customers.select(F.col("id").alias("customer_id"), "email", "metadata_organization_id")
    matched = bridge_join(people, bridge, places, "customer_id", "organization_id", how="inner")
    return matched.select(
        F.col("metadata_organization_id").alias("app_customer_key"),
        F.col("customer_id").alias("billing_customer_key"),
        "name", "email", "locality", "region", "country", "created_by_id", "company_size", "created_at",
        link(app_url, "resource_id").alias("app_account_link"),
        link(billing_url, "customer_id").alias("billing_customer_link"))


def fct_customers(orgs: DataFrame, bridge: DataFrame, customers: DataFrame, mrr: DataFrame) -> DataFrame:
    """Organisations that have a billing customer, with their counters and current revenue.

    mrr(customer_id, mrr) has at most a few rows per customer.
    """
    people = customers.select(F.col("id").alias("customer_id"))
    counted = orgs.select(F.col("id").alias("organization_id"), "resource_id", *ORG_COUNTERS)
    matched = bridge_join(counted, bridge, people, "organization_id", "customer_id", how="inner")
    return matched.join(mrr.select("customer_id", "mrr"), "customer_id", "left").select(
        F.col("resource_id").alias("app_customer_key"), F.col("customer_id").alias("billing_customer_key"),
        *ORG_COUNTERS, "mrr")


def workflow_counts(orgs: DataFrame, workflows: DataFrame) -> DataFrame:
    """Workflows per organisation, for organisations that have any."""
    counts = workflows.groupBy(F.col("owner_id").alias("id")).agg(F.count(F.lit(1)).alias("workflows_count"))
    return orgs.select("id").join(counts, "id").select("id", "workflows_count")
