"""Daily copies kept as intervals give the rows that full copies give."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import intervals
from tidemark.sources import lifecycle as life


def test_intervals_equal_full_copies(spark, rows, tmp_path):
    rng, columns = random.Random(11), ["id", "na`me", "value"]
    kept, full = str(tmp_path / "kept"), str(tmp_path / "full")
    first = dt.datetime(2024, 2, 27)
    table = [(n if n % 7 else None, rng.choice(["x", "y", None]), rng.choice([0.0, 1.5, None])) for n in range(40)]
    days = []
    for day in (0, 1, 2, 4):  # a day without a run
        as_of = first + dt.timedelta(days=day)
        if day == 2:
            pass  # nothing changes
        elif day:
            table = [r for r in table if rng.random() < 0.8] + [(rng.randrange(40), "y", 2.0) for _ in range(3)] + table[:2]
        df = spark.createDataFrame([(*r, "no") for r in table], "id long, `na``me` string, value double, other string")
        assert intervals.append_intervals(df, kept, columns, as_of, buckets=4)
        assert life.append_history(df, full, columns, as_of)
        assert not intervals.append_intervals(df, kept, columns, as_of)
        days.append(as_of.date())
    copies = spark.read.parquet(full).withColumn("run_day", F.col("run_day").cast("string"))
    for wanted in (days, days[1:2], [dt.date(2024, 3, 1), days[0]], [dt.date(2024, 3, 1)]):  # the second of March has no copy
        calendar = spark.createDataFrame([(d,) for d in wanted], "month date")
        assert rows(intervals.copies_on(spark, kept, wanted)) == rows(life.snapshots_on(copies, calendar).select("id", "`na``me`", "value", "run_day"))
    spans = intervals.read_intervals(spark, kept)
    assert spans.filter("_until <= _since").count() == 0
    assert spans.count() < copies.count() and spans.filter("_since = '20240229' OR _until = '20240229'").count() == 0
    with pytest.raises(ValueError):
        intervals.append_intervals(spark.createDataFrame([(1,)], "id long"), kept, ["id"], first + dt.timedelta(days=9))


def test_only_changed_buckets_are_written_and_a_failed_run_leaves_the_table(spark, rows, tmp_path, monkeypatch):
    table, day = str(tmp_path / "table"), dt.datetime(2024, 1, 1)
    intervals.append_intervals(spark.range(100), table, ["id"], day, buckets=8)
    before = rows(intervals.read_intervals(spark, table))

    def broken(*args):
        raise OSError("no room")

    with monkeypatch.context() as patch:
        patch.setattr(intervals, "replace_text", broken)
        with pytest.raises(OSError):
            intervals.append_intervals(spark.range(99), table, ["id"], day + dt.timedelta(days=1))
    assert rows(intervals.read_intervals(spark, table)) == before
    assert intervals.append_intervals(spark.range(99), table, ["id"], day + dt.timedelta(days=1))
    assert rows(intervals.read_intervals(spark, table).filter("_until IS NOT NULL")) == [(99, 1, "20240101", "20240102")]
    newest = intervals.listing_of(spark, table)["standing"].values()
    assert len([v for v in newest if v.startswith("version-20240102")]) <= 1
    assert intervals.append_intervals(spark.range(0), table, ["id"], day + dt.timedelta(days=2))  # all rows gone
    assert intervals.copies_on(spark, table, [day.date() + dt.timedelta(days=2)]).collect() == []
    assert intervals.copies_on(spark, table, [day.date()]).count() == 100
    held = {name: sorted(os.listdir(f"{table}/{name}")) for name in os.listdir(table) if name.startswith("version-")}
    assert {name[8:16] for name in held} == {"20240101", "20240102", "20240103"} and len(held) == 3  # the failed run's is gone
    intervals.append_intervals(spark.range(3), table, ["id"], day + dt.timedelta(days=3))
    held = {name[8:16]: os.listdir(f"{table}/{name}") for name in os.listdir(table) if name.startswith("version-")}
    assert "20240101" not in held and held["20240102"] == ["ended"]
    assert [intervals.copies_on(spark, table, [day.date() + dt.timedelta(days=n)]).count() for n in range(4)] == [100, 99, 0, 3]
