"""Recurring revenue and high-water marks kept up to date by each day's changes.

The states hold reduced facts only: one row per subscription, one per customer and month.  A daily run reads the day's
changes, finds their old rows, and derives the customers anew that they touch; the documents of earlier days
are not read again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.scalars import null_label
from tidemark.plans.book import MONEY, TEST_CUSTOMER
from tidemark.plans.revenue import monthly_cents, months_of_timeline, revenue_timeline
from tidemark.sources.kept_state import BUCKETS, read_state, update_state


def update_revenue(subs: DataFrame, items: DataFrame, location: str, as_of: dt.datetime, first_month="2021-01-01",
                   removed: DataFrame | None = None, buckets: int = BUCKETS) -> int:
    """Bring a day's changed subscriptions and items into the state of recurring revenue.

    `subs` has the new image of each changed subscription, `items` all items of each subscription of which any item
    changed, `removed(id)` subscriptions that are no more; columns as for `recurring_revenue`.  Either side may come
    first: items wait for their subscription, and a subscription that comes without items keeps those it had.  One that has
    lost all items is listed in `items` by a row without quantity.  A cancellation that comes late is a
    change like others.  Returns the number of buckets written.

    Subscriptions without id cannot be known again and are left out.  Repeated rows of a subscription count once, the
    greatest if they differ; one that is both changed and removed stays.  The first call begins the state.
    """
    start, cancel = cal.month_start("start_date"), cal.month_start("canceled_at")
    lasting = F.coalesce(F.col("canceled_at").isNull() | (start != cancel), F.lit(False))
    image = F.struct("customer_id", "status", start.alias("start_month"), cancel.alias("cancel_month"), lasting.alias("lasting"))
    told = subs.select("id", image.alias("sub")).unionByName(
        monthly_cents(items).select("id", F.struct("monthly_cents").alias("price")), allowMissingColumns=True)
    if removed is not None:
        told = told.unionByName(removed.select("id", F.lit(True).alias("gone")), allowMissingColumns=True)
    else:
        told = told.withColumn("gone", F.lit(False))
    changes = told.filter("id IS NOT NULL").groupBy("id").agg(
        F.max("sub").alias("sub"), F.max("price").alias("price"), F.max("gone").alias("gone"))

    def merge(old: Column | None) -> dict[str, Column]:
        def newest(part: str, name: str) -> Column:
            value = F.col(part)[name]
            return value if old is None else F.when(F.col(part).isNotNull(), value).otherwise(old[name])

        columns = {name: newest("sub", name) for name in ("customer_id", "status", "start_month", "cancel_month", "lasting")}
        return {"id": F.col("id"), **columns, "monthly_cents": newest("price", "monthly_cents")}

    def timeline(pieces: DataFrame) -> DataFrame:
        return revenue_timeline(pieces.filter("lasting AND customer_id IS NOT NULL"), first_month)

    return update_state(changes, location, ["id"], "customer_id", merge, timeline, as_of, {"first_month": str(first_month)},
                        F.col("gone") & F.col("sub").isNull(), buckets)


def kept_revenue(spark: SparkSession, location: str, as_of, history: bool = False) -> DataFrame:
    """What `recurring_revenue` gives for all subscriptions and items, out of the state."""
    return months_of_timeline(read_state(spark, location), as_of, history)


def queue_of_maxima(monthly: DataFrame) -> DataFrame:
    """monthly(customer, month, top) with the month `until` in which a later one is as high, and the customer's first month.

    The rows with month <= end < until are a monotonic queue: going back from `end`, tops that no month between
    reaches.  The first of them in a window that ends with `end` is the window's maximum.  A customer has one
    row per month of the calendar, so the months of one fit into a row.
    """
    known = F.filter(F.col("_all"), lambda x: x["month"].isNotNull())
    whole = monthly.groupBy("customer").agg(F.sort_array(F.collect_list(F.struct("month", "top"))).alias("_all"))
    rows = F.transform("_all", lambda row: F.struct(
        row["month"].alias("month"), row["top"].alias("top"),
        F.get(F.filter("_all", lambda x: (x["month"] > row["month"]) & (x["top"] >= row["top"])), F.lit(0))["month"].alias("until"),
        F.array_min(F.transform(known, lambda x: x["month"])).alias("first_month")))
    return whole.select("customer", F.inline(rows))


def update_marks(book: DataFrame, location: str, as_of: dt.datetime, removed: DataFrame | None = None, buckets: int = BUCKETS) -> int:
    """Bring the changed months of customers into the state of high-water marks.

    book(customer, month, mrr) has all rows of each customer and month of which any row changed,
    `removed(customer, month)` those that are no more.  Nulls: a null customer or month is one like others.  A month both
    listed and removed stays.  Returns the number of buckets written.
    """
    told = book.select("customer", F.col("month").cast("date").alias("month"), F.col("mrr").cast(MONEY).alias("top"), F.lit(False).alias("gone"))
    if removed is not None:
        told = told.unionByName(removed.select(
            "customer", F.col("month").cast("date").alias("month"), F.lit(None).cast(MONEY).alias("top"), F.lit(True).alias("gone")))
    changes = told.groupBy("customer", "month").agg(F.max("top").alias("top"), F.min("gone").alias("gone"))
    return update_state(changes, location, ["customer", "month"], "customer", lambda old: {c: F.col(c) for c in ("customer", "month", "top")},
                        queue_of_maxima, as_of, dropped=F.col("gone"), buckets=buckets)


def kept_marks(spark: SparkSession, location: str, accounts: DataFrame, label: str, this_month: Column | None = None) -> DataFrame:
    """High-water marks of this and of the last month per customer, as `revenue_book` gives them, out of the state.

    accounts(app_customer_key, last_owner_change); this month is the newest of the state unless given.  Rows that left
    the queue before the last month are not read.
    """
    queue = read_state(spark, location)
    if this_month is None:
        counted = queue.filter(F.col("until").isNull() & (F.col("customer") != TEST_CUSTOMER))
        this_month = counted.agg(F.max("month")).scalar()
    changes = accounts.select(F.col("app_customer_key").alias("customer"), F.col("last_owner_change").alias("_changed")).distinct()
    live = queue.withColumn("_this_month", this_month).filter(
        F.col("until").isNull() | (F.col("until") > F.add_months("_this_month", -1)))
    dated = live.join(changes, "customer", "left")
    month, changed, zero = F.col("month"), F.col("_changed"), F.lit(0).cast(MONEY)

    def mark(months_back: int) -> Column:
        end = F.add_months("_this_month", -months_back)
        start = F.add_months("_this_month", -11 - months_back)
        since = F.when(changed.isNull() | (changed < start), start).otherwise(changed)
        inside = month.between(since, end)
        queued = F.col("until").isNull() | (F.col("until") > end)
        # A month outside counts as zero, also one that is no longer queued: then the customer's first month is outside.
        top = F.when(inside & queued, F.col("top")).when(~F.coalesce(inside, F.lit(False)), zero)
        return F.coalesce(F.greatest(F.max(top), F.max(F.when(F.col("first_month") < since, zero))), zero)

    return dated.groupBy(null_label("customer").alias("customer_key")).agg(
        mark(0).alias(f"high_water_this_month_{label}"), mark(1).alias(f"high_water_last_month_{label}"))
