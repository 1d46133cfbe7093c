"""Seats, members and prices per subscription and month, out of daily copies."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.scalars import from_cents
from tidemark.operators.aggregate import rounded_average
from tidemark.operators.reshape import pivot_periods
from tidemark.operators.select import first_slot
from tidemark.operators.spines import months_list
from tidemark.plans.subscriptions import BASE_PLANS, SLOTS
from tidemark.sources.lifecycle import month_start_snapshots

# The months these reports list unless told otherwise.
MONTHLY_PERIODS = tuple(months_list(2022, 1, 2024, 11))


def run_period(column: str = "run_date") -> Column:
    """`YYYY-MM` of a run date."""
    return F.concat_ws("-", F.substring(column, 1, 4), F.substring(column, 5, 2))


def base_slot(field: str, base_prices: Iterable[str], otherwise=None) -> Column:
    """Field of the first slot whose price is a base price."""
    prices = list(base_prices)
    return first_slot([F.col(f"items_data_{n}_price_id").isin(*prices) for n in SLOTS],
                      [F.col(f"items_data_{n}_{field}") for n in SLOTS], otherwise)


def measure_by_month(measured: DataFrame, keys: Sequence[str], measure: str, periods: Sequence[str],
                     dimensions: Sequence[tuple[DataFrame, str | list[str], str]] = (),
                     drop: Sequence[str] = ()) -> DataFrame:
    """Rounded average of a measure per key and month, one column per month.

    measured(keys, period, measure).  The copies of a month are averaged before the dimensions
    (table, join columns, join type) are looked up.  Rows a dimension repeats are summed into the
    same cell only if they agree in all other columns, so distinct rows are kept first.
    """
    averaged = measured.groupBy(*keys, "period").agg(rounded_average(measure).alias("_average"))
    full = averaged
    for table, on, how in dimensions:
        full = full.join(table, on, how)
    labels = [c for c in full.columns if c not in ("period", "_average", *drop)]
    once = full.select(*labels, "period", "_average").distinct()
    return pivot_periods(once, labels, "period", "_average", list(periods))


def seats_by_month(history: DataFrame, current: DataFrame, customers: DataFrame, accounts: DataFrame,
                   orgs: DataFrame, products: DataFrame, base_prices: Iterable[str], as_of,
                   periods: Sequence[str] = MONTHLY_PERIODS, months_back: int = 18) -> DataFrame:
    """Seats of each subscription's base plan on the first of each month.

    history(id, customer, run_date, slots), current(id, status, slots), customers(id, name,
    description, metadata_organization_id), accounts(app_customer_key, ...), orgs(resource_id,
    membership_count), products(id, name).
    """
    base_prices = list(base_prices)
    copies = month_start_snapshots(history, as_of, months_back)
    seats = copies.select("id", "customer", run_period().alias("period"),
                          base_slot("quantity", base_prices, 0).alias("seats"))
    plans = products.select(F.col("id").alias("base_plan"), F.col("name").alias("plan_name"))
    now = current.select("id", "status", base_slot("plan_product", base_prices).alias("base_plan"),
                         base_slot("quantity", base_prices, 0).alias("licenses_count")).join(plans, "base_plan")
    return measure_by_month(seats, ["id", "customer"], "seats", periods, [
        (now, "id", "inner"), *_who(customers, accounts, orgs)], drop=["customer"])


def members_by_month(stats: DataFrame, current: DataFrame, customers: DataFrame, accounts: DataFrame,
                     orgs: DataFrame, products: DataFrame, base_prices: Iterable[str], as_of,
                     periods: Sequence[str] = MONTHLY_PERIODS, months_back: int = 18) -> DataFrame:
    """Members of each subscription's organisation on the first of each month.

    stats(resource_id, export_date, membership_count) holds the daily copies.
    """
    base_prices = list(base_prices)
    copies = month_start_snapshots(stats, as_of, months_back, "export_date")
    counts = copies.select(F.col("resource_id").alias("app_customer_key"), run_period("export_date").alias("period"),
                           "membership_count")
    plans = products.select(F.col("id").alias("base_plan"), F.col("name").alias("plan_name"))
    now = current.select("id", F.col("customer").alias("customer_id"), "status",
                         base_slot("plan_product", base_prices).alias("base_plan"),
                         base_slot("quantity", base_prices, 0).alias("licenses_count")).join(plans, "base_plan")
    people = customers.select(F.col("id").alias("customer_id"),
                              F.col("metadata_organization_id").alias("app_customer_key"),
                              F.coalesce("name", "description").alias("customer_name"))
    places = orgs.select(F.col("resource_id").alias("app_customer_key"), "membership_count")
    return measure_by_month(counts, ["app_customer_key"], "membership_count", periods, [
        (places, "app_customer_key", "inner"), (people.join(now, "customer_id"), "app_customer_key", "inner"),
        (accounts, "app_customer_key", "left")])


def prices_by_month(history: DataFrame, product_history: DataFrame, current: DataFrame, customers: DataFrame,
                    accounts: DataFrame, orgs: DataFrame, as_of, plan_names: Iterable[str] = BASE_PLANS,
                    periods: Sequence[str] = MONTHLY_PERIODS, months_back: int = 18) -> DataFrame:
    """Price of each subscription's base plan per month, out of all copies of the month.

    The base plan is the first slot whose product had one of the plan names on the day of the copy.
    """
    first, last = cal.month_key(cal.months_ago(months_back, as_of)), cal.month_key(cal.day(as_of))
    listed = product_history.filter(F.col("name").isin(*plan_names))
    rows = history.filter(run_period().between(first, last)).withColumn("_day", F.substring("run_date", 1, 8))
    for n in SLOTS:
        names = listed.select(F.col("id").alias(f"items_data_{n}_plan_product"),
                              F.substring("run_date", 1, 8).alias("_day"), F.col("name").alias(f"_name_{n}"))
        rows = rows.join(names, [f"items_data_{n}_plan_product", "_day"], "left")
    hits = [F.col(f"_name_{n}").isNotNull() for n in SLOTS]
    prices = rows.select(
        "id", "customer", run_period().alias("period"),
        F.coalesce(*[F.col(f"_name_{n}") for n in SLOTS]).alias("plan_name"),
        first_slot(hits, [from_cents(f"items_data_{n}_plan_amount") for n in SLOTS]).alias("amount"),
    ).filter(F.col("plan_name").isNotNull())
    return measure_by_month(prices, ["id", "customer", "plan_name"], "amount", periods, [
        (current.select("id"), "id", "inner"), *_who(customers, accounts, orgs)], drop=["customer"])


def _who(customers: DataFrame, accounts: DataFrame, orgs: DataFrame) -> list[tuple[DataFrame, str, str]]:
    people = customers.select(F.col("id").alias("customer"), F.col("id").alias("customer_id"),
                              F.col("metadata_organization_id").alias("app_customer_key"),
                              F.coalesce("name", "description").alias("customer_name"))
    places = orgs.select(F.col("resource_id").alias("app_customer_key"), "membership_count")
    return [(people, "customer", "inner"), (places, "app_customer_key", "inner"),
            (accounts, "app_customer_key", "left")]
