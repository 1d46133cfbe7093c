"""States brought up to date day by day equal what a full rebuild gives on every day."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import book, kept, revenue
from tidemark.sources import kept_state

D, FIRST = dt.date, "2023-01-01"
SUB = "id string, customer_id string, start_date timestamp, canceled_at timestamp, status string"
ITEM = "subscription string, quantity bigint, amount bigint, interval_period string, interval_count bigint"


def _moment(day: int) -> dt.datetime:
    return dt.datetime(2022, 11, 1) + dt.timedelta(days=day)


def _subscription(rng, name: str):
    begun = rng.randrange(0, 500)
    gone = rng.random() < 0.4
    status = "canceled" if gone else rng.choice(["active", "past_due", None])
    return (name, rng.choice(["a", "b", "c", "d", None]), _moment(begun), _moment(begun + rng.randrange(0, 200)) if gone else None, status)


def _items(rng, name: str):
    return [(name, rng.choice([1, 2, 3]), rng.randrange(0, 5000), rng.choice(["month", "year"]), rng.choice([1, 3]))
            for _ in range(rng.randrange(1, 4))]


def test_revenue_day_by_day_equals_a_rebuild(spark, rows, tmp_path):
    rng, state = random.Random(7), str(tmp_path / "state")
    subs: dict = {}
    items: dict = {}
    for day in range(4):
        names = [f"s{n}" for n in range(30)] if day == 0 else [f"s{rng.randrange(40)}" for _ in range(10)]
        new_subs, new_items, removed = {}, {}, []
        for name in names:
            what = rng.choice(["both", "sub", "items", "cancel", "remove"]) if day else rng.choice(["both", "both", "sub", "items"])
            if what in ("both", "sub"):
                new_subs[name] = _subscription(rng, name)  # the customer may change as well
            if what in ("both", "items"):
                new_items[name] = _items(rng, name)
            if what == "cancel" and name in subs:  # a cancellation that comes long after it took effect
                old = subs[name]
                new_subs[name] = (*old[:3], old[2] + dt.timedelta(days=rng.choice([3, 40])), "canceled")
            if what == "remove" and name not in new_subs and name not in new_items:
                removed.append(name)
        for name in removed:
            if name not in new_subs:
                subs.pop(name, None)
                items.pop(name, None)
                new_items.pop(name, None)
        subs |= new_subs
        items |= new_items
        listed = [*new_subs.values(), (None, "a", _moment(60), None, "active")]
        kept.update_revenue(
            spark.createDataFrame([*listed, *listed], SUB), spark.createDataFrame([r for i in new_items.values() for r in i], ITEM),
            state, _moment(600 + day), FIRST, spark.createDataFrame([(n,) for n in removed if n not in new_subs], "id string"), buckets=8)
        all_subs = spark.createDataFrame(list(subs.values()), SUB)
        all_items = spark.createDataFrame([r for i in items.values() for r in i], ITEM)
        for as_of, history in (("2023-06-15", False), ("2024-03-01", True)):
            wanted = revenue.recurring_revenue(all_subs, all_items, as_of, FIRST, history)
            assert rows(kept.kept_revenue(spark, state, as_of, history)) == rows(wanted), (day, as_of, history)


def test_marks_day_by_day_equal_a_rebuild(spark, rows, tmp_path):
    rng, state = random.Random(3), str(tmp_path / "state")
    months = [D(2022 + m // 12, m % 12 + 1, 1) for m in range(26)]
    accounts = spark.createDataFrame([("a", D(2023, 9, 10)), ("b", None), ("c", D(2020, 1, 1)), ("c", D(2023, 12, 1))],
                                     "app_customer_key string, last_owner_change date")
    held: dict = {}
    schema = "customer string, month date, mrr double"
    for day in range(4):
        reach = months[:12 + 4 * day]  # later days bring later months
        cells = [(c, m) for c in ("a", "b", "c", "d", None, book.TEST_CUSTOMER) for m in [*reach, None] if rng.random() < (0.6 if day == 0 else 0.15)]
        removed = [cell for cell in cells if day and rng.random() < 0.3]
        changed = {cell: [float(rng.choice([-5, -1, 2, 3, 3, 7, 9])) if rng.random() < 0.9 else None for _ in range(rng.choice([1, 2]))]
                   for cell in cells if cell not in removed}
        for cell in removed:
            held.pop(cell, None)
        held |= changed
        kept.update_marks(spark.createDataFrame([(*c, v) for c, vs in changed.items() for v in vs], schema), state, _moment(day),
                          spark.createDataFrame(removed, "customer string, month date"), buckets=4)
        full = spark.createDataFrame([(*c, v) for c, vs in held.items() for v in vs], schema)
        monthly = full.groupBy("customer", "month").agg(F.max(F.col("mrr").cast(book.MONEY)).alias("_top"))
        owners = accounts.select(F.col("app_customer_key").alias("customer"), F.col("last_owner_change").alias("_changed")).distinct()
        wanted = book._marks(monthly, owners, book.current_month(full), "x")
        assert rows(kept.kept_marks(spark, state, accounts, "x")) == rows(wanted), day
        earlier = F.lit(D(2022, 11, 1))  # months of the book after the one asked for
        assert rows(kept.kept_marks(spark, state, accounts, "x", earlier)) == rows(book._marks(monthly, owners, earlier, "x")), day


def test_only_touched_buckets_are_written_and_a_failed_run_leaves_the_state(spark, rows, tmp_path, monkeypatch):
    state, schema = str(tmp_path / "state"), "customer string, month date, mrr double"
    month = D(2024, 1, 1)
    first = spark.createDataFrame([(f"c{n}", month, float(n)) for n in range(50)], schema)
    assert kept.update_marks(first, state, _moment(0), buckets=16) > 8
    before = rows(kept_state.read_state(spark, state))
    change = spark.createDataFrame([("c7", month, 70.0)], schema)

    def broken(*args):
        raise OSError("no room")

    with monkeypatch.context() as patch:
        patch.setattr(kept_state, "replace_text", broken)
        with pytest.raises(OSError):
            kept.update_marks(change, state, _moment(1))
    assert rows(kept_state.read_state(spark, state)) == before
    assert kept.update_marks(change, state, _moment(1)) == 1
    after = rows(kept_state.read_state(spark, state))
    assert len(set(after) ^ set(before)) == 2
    assert kept.update_marks(change, state, _moment(1)) == 1 and rows(kept_state.read_state(spark, state)) == after  # started again
    assert kept.update_marks(change.limit(0), state, _moment(2)) == 0
    assert len([n for n in os.listdir(state) if n.startswith("version-")]) <= 4
    with pytest.raises(FileNotFoundError):
        kept_state.read_state(spark, str(tmp_path / "none"))


def test_settings_and_empty_states(spark, tmp_path):
    state = str(tmp_path / "state")
    subs, items = spark.createDataFrame([], SUB), spark.createDataFrame([], ITEM)
    kept.update_revenue(subs, items, state, _moment(0), FIRST)
    assert kept.kept_revenue(spark, state, "2024-01-01").collect() == []
    with pytest.raises(ValueError):
        kept.update_revenue(subs, items, state, _moment(1), "2020-01-01")
