"""Paid revenue by month and monthly recurring revenue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.documents import parsed, scalar_at
from tidemark.functions.scalars import exact_sum
from tidemark.operators.reshape import pivot_periods
from tidemark.operators.spines import months_list


# The months the revenue report lists unless told otherwise.
REVENUE_MONTHS = tuple(months_list(2022, 1, 2023, 10))


def revenue_by_month(invoices: DataFrame, bridge: DataFrame, orgs: DataFrame,
                     months: Sequence[str] = REVENUE_MONTHS) -> DataFrame:
    """Paid amounts per customer and organisation, one column per month.

    invoices(customer, amount_paid, created timestamp, paid).  Amounts are summed per customer and
    month before the organisation is looked up, so the joins see one row per customer and month.
    """
    month = cal.month_key("created")
    listed = F.when(month.isin(*months), month)
    paid = invoices.filter(F.col("paid")).groupBy("customer", listed.alias("month")).agg(
        exact_sum("amount_paid").alias("amount"))
    pairs = bridge.select(F.col("customer_id").alias("customer"), F.col("organization_id").alias("org_id")).distinct()
    places = orgs.select(F.col("id").alias("org_id"), "resource_id")
    owned = paid.join(pairs.join(places, "org_id", "left"), "customer", "left")
    wide = pivot_periods(owned, ["customer", "resource_id"], "month", "amount", list(months))
    return wide.select("customer", "resource_id", *[F.col(f"`{m}`").cast("double").alias(m) for m in months])


def subscription_documents(raw_subs: DataFrame, raw_items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed subscriptions and items out of raw documents (`json_data`)."""
    def field(path: str):
        return scalar_at(F.col("_document"), path)

    subs = raw_subs.select("id", parsed("json_data").alias("_document")).select(
        "id", field("customer").alias("customer_id"), field("status").alias("status"),
        cal.from_epoch(field("start_date").try_cast("bigint")).alias("start_date"),
        cal.from_epoch(field("canceled_at").try_cast("bigint")).alias("canceled_at"))
    items = raw_items.select(parsed("json_data").alias("_document")).select(
        field("subscription").alias("subscription"), field("price.id").alias("price_id"),
        field("plan.interval").alias("interval_period"), field("plan.currency").alias("currency"),
        *[field(path).try_cast("bigint").alias(name) for path, name in (
            ("quantity", "quantity"), ("plan.amount", "amount"), ("plan.interval_count", "interval_count"))])
    return subs, items


def monthly_cents(items: DataFrame) -> DataFrame:
    """What each subscription costs per month, in cents, summed over its items.

    A subscription with very many items is summed in the tasks that read them.
    """
    per_interval = F.col("amount") / F.nullif(F.col("interval_count"), F.lit(0))
    monthly = F.when(F.col("interval_period") == "year", per_interval / 12).otherwise(per_interval) * F.col("quantity")
    return items.groupBy(F.col("subscription").alias("id")).agg(
        exact_sum(monthly, 6).alias("monthly_cents"))


def priced_subscriptions(subs: DataFrame, cents: DataFrame) -> DataFrame:
    """Subscriptions with their months of beginning and cancellation and what they cost per month.

    subs(id, customer_id, start_date, canceled_at, status), cents as `monthly_cents` returns them.  Those
    cancelled in the month they began in are left out.
    """
    start, cancel = cal.month_start("start_date"), cal.month_start("canceled_at")
    # Revenue without a customer cannot be carried forward for anyone.
    owned = subs.filter(F.col("customer_id").isNotNull())
    lasting = owned.filter(F.col("canceled_at").isNull() | (start != cancel)).select(
        "id", "customer_id", "status", start.alias("start_month"), cancel.alias("cancel_month"))
    return lasting.join(cents, "id", "left")


def revenue_timeline(priced: DataFrame, first_month="2021-01-01") -> DataFrame:
    """One row per customer, month in which subscriptions began, and status, with what follows up to the next one.

    priced(customer_id, status, start_month, cancel_month, monthly_cents).  The rows hang on no day, so they can be
    kept; `months_of_timeline` writes the months out.
    """
    opening = cal.months_ago(0, first_month)
    gone = F.col("status") == "canceled"
    per_status = priced.groupBy("customer_id", "start_month", "status").agg(
        F.round(F.sum("monthly_cents"), 3).alias("_cents"), F.max("cancel_month").alias("_cancelled"))

    # One row per customer, month and status is left, so a customer's rows fit one window, and all
    # of the following shares one sort.
    along = Window.partitionBy("customer_id").orderBy("start_month", "status")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own_status, in_reach = F.col("status"), F.col("start_month") >= opening
    # Thirds and twelfths of cents have been rounded, so a sum can miss a half by a hair: it is
    # rounded to a thousandth of a cent first, and only then to a whole amount.
    amount = F.round(F.col("_cents") / 100).cast("bigint")
    timeline = per_status.select(
        "customer_id", "start_month", own_status.alias("source_status"), amount.alias("amount"),
        # Status of the customer: any that is not cancelled, else cancelled since the last cancellation.
        F.max(F.when(~gone, own_status)).over(whole).alias("_open"),
        F.max(F.when(gone, own_status)).over(whole).alias("_ended"),
        F.max(F.when(gone, F.col("_cancelled"))).over(whole).alias("_last_cancel"),
        F.last(F.when(in_reach, amount), ignorenulls=True).over(so_far).alias("_known"),
        F.lead("start_month").over(along).alias("next_month"))
    same_month = Window.partitionBy("customer_id", "start_month")
    status = F.coalesce("_open", "_ended")
    return timeline.select(
        "customer_id", "start_month", "source_status", "amount", "next_month", status.alias("status"),
        F.when(status == "canceled", F.col("_last_cancel")).alias("canceled_at"),
        F.max_by("_known", F.coalesce("source_status", F.lit(""))).over(same_month).alias("mrr"),
    ).filter(in_reach & F.col("mrr").isNotNull())


def months_of_timeline(timeline: DataFrame, as_of, history: bool = False) -> DataFrame:
    """The months of a timeline up to `as_of`, or that month alone."""
    this_month, start_month = cal.months_ago(0, as_of), F.col("start_month")
    filled = timeline.filter(start_month <= this_month)
    # The last row of a month also stands for the months up to the next one.
    until = F.least(F.coalesce(F.add_months("next_month", -1), this_month), this_month)
    is_last = F.col("next_month").isNull() | (F.col("next_month") > start_month)
    later = F.when(is_last & (until > start_month),
                   F.sequence(F.add_months(start_month, 1), until, F.expr("INTERVAL 1 MONTH")))

    def month_row(month, begun, source, own):
        return F.struct(month.alias("month"), begun.cast("date").alias("start_date_month"),
                        source.cast("string").alias("source_status"), own.cast("bigint").alias("amount"))

    nothing = F.lit(None)
    rows = F.concat(
        F.array(month_row(start_month, start_month, F.col("source_status"), F.col("amount"))),
        F.transform(F.coalesce(later, F.array().cast("array<date>")), lambda m: month_row(m, nothing, nothing, nothing)))
    if not history:
        rows = F.filter(rows, lambda r: r["month"] == this_month)
    rows = F.filter(rows, lambda r: F.col("canceled_at").isNull() | (r["month"] <= F.col("canceled_at")))
    spelled = filled.select("customer_id", "start_month", F.col("source_status").alias("_status"), "status", "canceled_at", "mrr", rows.alias("_rows"))

    # Ranks and changes are found on the timeline, before its months are written out: written out, the rows of a task
    # are many times what it read, and sorting them again would take that much memory.
    alive = spelled.filter(F.size("_rows") > 0)
    along = Window.partitionBy("customer_id").orderBy("start_month", "_status")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size = F.size("_rows")
    ranked = alive.select("*", (F.sum(size).over(so_far) - size).cast("int").alias("_before"), F.sum(size).over(whole).cast("int").alias("_all"),
                          F.coalesce(F.col("mrr") - F.lag("mrr").over(along), F.col("mrr")).alias("_change"))
    written = ranked.select("customer_id", "status", "canceled_at", "mrr", "_before", "_all", "_change", F.posexplode("_rows").alias("_at", "_row"))
    place = F.col("_before") + F.col("_at") + 1
    return written.select(
        "customer_id", F.col("_row.month").alias("month"), F.col("_row.start_date_month").alias("start_date_month"),
        F.col("_row.amount").alias("monthly_amount_after_discount"), "canceled_at", "status", "mrr",
        F.when(F.col("_at") == 0, F.col("_change")).otherwise(F.col("mrr") - F.col("mrr")).alias("mrr_change"),
        place.alias("mrr_rank_asc"), (F.col("_all") - place + 1).alias("mrr_rank_desc"))


def recurring_revenue(subs: DataFrame, items: DataFrame, as_of, first_month="2021-01-01",
                      history: bool = False) -> DataFrame:
    """Monthly recurring revenue of each customer, carried forward from month to month.

    subs(id, customer_id, start_date, canceled_at, status), items(subscription, quantity, amount in
    cents, interval_period, interval_count).  Without `history` only the month of `as_of`, with it
    all months from `first_month` on.

    The amount of a month is that of the latest month in which subscriptions began.  A month in
    which subscriptions of several statuses began has a row for each, the last status giving the
    amount.  Carrying forward needs no join with a calendar: each such month is written out up to
    the next one.
    """
    priced = priced_subscriptions(subs, monthly_cents(items))
    return months_of_timeline(revenue_timeline(priced, first_month), as_of, history)
