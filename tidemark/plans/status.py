"""Status of each customer over all subscriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.lifecycle import changed_rows

# Fixed value: days between the last cancellation and the deletion of a customer.
GRACE_DAYS = 93


def customer_status(subs: DataFrame, order: str, grace_days: int = GRACE_DAYS) -> DataFrame:
    """Cancelled customers with their day of deletion; others with the status listed last.

    subs(customer, status, canceled_at epoch seconds or timestamp).  `order` is a column that says
    in which order subscriptions are listed.  Customers without subscriptions have no row.

    Subscriptions are first reduced to one row per customer and status, by counts and largest
    numbers alone, which each task keeps in a hash table; a customer with very many subscriptions
    costs a task no more than one row per status.
    """
    moment = F.col("canceled_at").cast("timestamp")
    per_status = subs.filter(F.col("customer").isNotNull()).groupBy(F.col("customer").alias("customer_id"), "status").agg(
        F.count(F.lit(1)).alias("_n"), F.max(order).alias("_listed"), F.max(moment).alias("_gone"))
    cancelled = F.col("status") == "canceled"
    rolled = per_status.groupBy("customer_id").agg(
        F.sum("_n").alias("n_subscriptions"),
        F.sum(F.when(cancelled, F.col("_n")).otherwise(0)).alias("_n_cancelled"),
        F.max(F.when(cancelled, F.col("_gone"))).alias("_last_cancel"),
        F.max_by("status", F.when(~cancelled, F.col("_listed"))).alias("_open_status"))
    all_gone = F.col("_n_cancelled") == F.col("n_subscriptions")
    delete_by = F.date_format(F.date_add(F.col("_last_cancel").cast("date"), grace_days), "yyyy-MM-dd")
    return rolled.select(
        "customer_id", "n_subscriptions",
        F.when(all_gone, "canceled").otherwise(F.col("_open_status")).alias("status"),
        F.when(all_gone, F.coalesce(delete_by, F.lit(""))).otherwise("").alias("delete_by"))


def status_updates(statuses: DataFrame, current: DataFrame) -> DataFrame:
    """Statuses that differ from what the billing system holds: current(customer_id, status, delete_by)."""
    return changed_rows(statuses.select("customer_id", "status", "delete_by"), current,
                        ["customer_id", "status", "delete_by"])
