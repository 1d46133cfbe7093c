"""Recurring-revenue book with high-water marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.scalars import exact_sum, null_label
from tidemark.operators.joins import latest_join
from tidemark.operators.reshape import pivot_periods
from tidemark.operators.spines import months_list

# The months the book lists unless told otherwise, the book customer that does not
# count for the current month, and the number of months that are also given under relative names.
BOOK_MONTHS = tuple(months_list(2022, 1, 2024, 1))
TEST_CUSTOMER = "Ops Test"
RECENT_MONTHS = 13
MONEY = "decimal(28,6)"


def owner_changes(accounts: DataFrame, changes: DataFrame, zone: str = cal.DEFAULT_ZONE,
                  tie: str | None = None) -> DataFrame:
    """Accounts with day and previous owner of their latest change of owner.

    accounts(account_id, app_customer_key, ...), changes(account_id, field, old_value, created_date UTC).
    """
    owner = changes.filter(F.col("field") == "Owner").select(
        "account_id", F.col("old_value").alias("previous_owner"), "created_date", *([tie] if tie else []))
    order = [F.desc("created_date"), *([F.desc(tie)] if tie else [])]
    joined = latest_join(accounts.filter(F.col("app_customer_key").isNotNull()), owner, "account_id", order, "left")
    return joined.withColumn("last_owner_change", cal.local_date("created_date", zone)).drop(
        "created_date", *([tie] if tie else []))


def current_month(book: DataFrame) -> Column:
    """Latest month of a book, as a scalar subquery; rows of the test customer or of none do not count."""
    counted = book.filter(F.col("month").isNotNull() & (F.col("customer") != TEST_CUSTOMER))
    return counted.agg(F.max("month").cast("date")).scalar()


def _marks(monthly: DataFrame, changes: DataFrame, this_month: Column, label: str) -> DataFrame:
    """High-water marks of this and of the last month in one pass over customers' months."""
    dated = monthly.join(changes, "customer", "left").withColumn("_this_month", this_month)
    month, changed = F.col("month").cast("date"), F.col("_changed")

    def mark(months_back: int) -> Column:
        end = F.add_months("_this_month", -months_back)
        start = F.add_months("_this_month", -11 - months_back)
        since = F.when(changed.isNull() | (changed < start), start).otherwise(changed)
        # Months outside count as zero, so a mark is never negative unless every month lies inside.
        zero = F.lit(0).cast(MONEY)
        return F.coalesce(F.max(F.when(month.between(since, end), F.col("_top")).otherwise(zero)), zero)

    return dated.groupBy(null_label("customer").alias("customer_key")).agg(
        mark(0).alias(f"high_water_this_month_{label}"), mark(1).alias(f"high_water_last_month_{label}"))


def revenue_book(licences: DataFrame, services: DataFrame, accounts: DataFrame,
                 months: Sequence[str] = BOOK_MONTHS) -> DataFrame:
    """Customers of the licence book with high-water marks and monthly revenue from both books.

    licences and services(customer, month, mrr); accounts(app_customer_key, last_owner_change, ...)
    as returned by `owner_changes`.  The mark of a month is the highest revenue of the twelve months
    up to it, but not from before the last change of owner.
    """
    months = list(months)
    this_month = current_month(licences)
    # Equal days of several accounts of a customer need not be compared twice.
    changes = accounts.select(F.col("app_customer_key").alias("customer"),
                              F.col("last_owner_change").alias("_changed")).distinct()

    def summed(book: DataFrame, label: str) -> DataFrame:
        """Marks and monthly sums.  Both need no more than one row per customer and month."""
        monthly = book.groupBy("customer", "month").agg(
            F.max(F.col("mrr").cast(MONEY)).alias("_top"), exact_sum("mrr", 6).alias("_sum"))
        labelled = monthly.select(null_label("customer").alias("customer_key"), cal.month_key("month").alias("period"),
                                  "_sum")
        wide = pivot_periods(labelled, "customer_key", "period", "_sum", months, alias=label)
        return _marks(monthly, changes, this_month, label).join(wide, "customer_key")

    lic, srv = summed(licences, "rgr"), summed(services, "msp")
    full = lic.join(srv, "customer_key", "left").join(
        accounts.withColumnRenamed("app_customer_key", "customer_key"), "customer_key", "left")

    def triple(left: str, right: str, names: Sequence[str]) -> list[str]:
        """Left, right and their exact sum; a missing one counts as zero."""
        a, b = f"coalesce(`{left}`, 0BD)", f"coalesce(`{right}`, 0BD)"
        return [f"cast({value} as double) as `{name}`" for value, name in zip((a, b, f"{a} + {b}"), names, strict=True)]

    outputs = []
    for when in ("last", "this"):
        mark = f"high_water_{when}_month"
        outputs += triple(f"{mark}_rgr", f"{mark}_msp", [f"{mark}_{kind}" for kind in ("license", "msp", "total")])
    recent = months[-RECENT_MONTHS:]
    for month, name in [(m, m) for m in months] + [(m, len(recent) - 1 - i) for i, m in enumerate(recent)]:
        outputs += triple(f"rgr_{month}", f"msp_{month}", [f"{kind}_{name}" for kind in ("rgr", "msp", "total")])
    others = [f"`{c}`" for c in accounts.columns if c != "app_customer_key"]
    return full.selectExpr("customer_key", *others, *outputs)
