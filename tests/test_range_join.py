"""Range joins at quantiles against a plain comparison of all pairs."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins as j


def facts_and_ranges(seed):
    pick = random.Random(seed)
    facts = [(i, None if i % 41 == 0 else 500 if i % 3 == 0 else pick.randrange(2000)) for i in range(1500)]
    ranges = [(k, pick.randrange(-50, 2000), pick.randrange(-50, 2100)) for k in range(60)]
    ranges += [(100, 500, 500), (101, -10**5, 10**5), (102, None, 5), (103, 5, None), (104, 7, 6), (105, 1999, 1999), (106, 500, 10**5), (101, -10**5, 10**5)]
    return facts, ranges


@pytest.mark.parametrize("per_piece,fan", [(20, 4), (7, 3), (200, 64), (10**6, 64)])
@pytest.mark.parametrize("kind", ["int", "double", "date", "string"])
def test_quantile_range_join(spark, per_piece, fan, kind):
    facts, ranges = facts_and_ranges(per_piece)
    of = {"int": lambda c: c, "double": lambda c: c.cast("double") / 4, "date": lambda c: F.date_add(F.lit("2000-01-01").cast("date"), c),
          "string": lambda c: F.concat(F.lit("prefix-"), F.lpad((c + 10**6).cast("string"), 9, "0"))}[kind]
    df = spark.createDataFrame(facts, "id int, v int").withColumn("v", of(F.col("v")))
    spans = spark.createDataFrame(ranges, "k int, lo int, hi int").withColumns({"lo": of(F.col("lo")), "hi": of(F.col("hi"))})
    found = j.quantile_range_join(df, spans, "v", "lo", "hi", per_piece, fan)
    assert found.columns == ["id", "v", "k", "lo", "hi"]
    expected = sorted((i, k) for i, v in facts if v is not None for k, lo, hi in ranges if lo is not None and hi is not None and lo <= v <= hi)
    assert sorted((r.id, r.k) for r in found.collect()) == expected


def test_long_ranges_cost_few_rows_and_hot_values_are_split(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 3000).otherwise(F.col("id") % 5000).cast("int").alias("day"))
    spans = spark.range(200).select(F.col("id").alias("k"), F.lit(0).alias("lo"), F.lit(1000).alias("hi"))
    placed, covered, touched = j.pieces_of_ranges(df, spans.unionAll(spans.select("k", "lo", F.lit(10**9))), "day", "lo", "hi", 100, 10)
    assert max(r["count"] for r in placed.groupBy("_piece").count().collect()) <= 200  # also of the 6,668 facts of one day
    hot = [r._piece for r in placed.filter("day = 3000").select("_piece").distinct().collect()]
    assert len(hot) > 30
    assert covered.count() + touched.count() <= 400 * (20 + 2 * 10 + 2)  # a row per day would make 200 x 1,001 and 200 x 5,000
    plan = j.quantile_range_join(df, spans, "day", "lo", "hi", 100, 10)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_join_of_mixed_types_and_nothing(spark):
    df, spans = spark.createDataFrame([(1,), (2,)], "v int"), spark.createDataFrame([(0.5, 1.5)], "lo double, hi double")
    assert [r.v for r in j.quantile_range_join(df, spans, "v", "lo", "hi", 1, 2).collect()] == [1]
    assert j.quantile_range_join(df.limit(0), spans, "v", "lo", "hi").count() == j.quantile_range_join(df, spans.limit(0), "v", "lo", "hi").count() == 0


def test_matches_of_one_bin_are_spread_over_tasks(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 100).cast("double").alias("v"))
    bands = spark.createDataFrame([(k, k - 1.0, k + 1.5) for k in range(0, 100, 5)] + [(200, None, 4.0), (300, 9.0, 8.0)], "k int, lo double, hi double")
    expected = sorted((i, k) for i in range(40_000) for k in range(0, 100, 5) if k - 1 <= i % 100 <= k + 1.5)
    for found in (j.range_join(df, bands, "v", "lo", "hi", 150), j.quantile_range_join(df, bands, "v", "lo", "hi", 1000, 4)):
        found = found.withColumn("task", F.spark_partition_id()).collect()
        assert sorted((r.id, r.k) for r in found) == expected
        assert len({r.task for r in found}) > 1


def test_long_ranges_join_a_row_a_day(spark, tmp_path, monkeypatch):
    from catalogue import QUERIES, joins

    suppliers = [(k, f"s{k}", 1, 1.0) for k in [*range(1, 90), 5, 5, 41, None]]
    orders = [(k if k % 50 else None, 1, "F", 1.0, None if k % 31 == 0 else f"{1995 + k % 7}-0{1 + k % 9}-{10 + k % 19}") for k in range(4000)]
    orders += orders[:100]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    df = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, at string")
    df.select("*", F.col("at").cast("timestamp_ntz").alias("o_orderdate"), F.lit("x").alias("o_orderpriority")).drop("at").write.parquet(f"{tmp_path}/orders.parquet")

    met, join = [], joins.j.quantile_range_join

    def seen(facts, ranges, *args, **options):
        met.extend([facts.count(), ranges.count()])
        return join(facts, ranges, *args, **options)

    monkeypatch.setattr(joins.j, "quantile_range_join", seen)
    found = sorted(map(tuple, QUERIES["long_ranges"](spark, str(tmp_path)).select("s_suppkey", "lo", "n", "last_order", "n_days").collect()))
    day_of = lambda k, at: dt.date(1998, 1, 5) if k is not None and k % 3 == 0 else at and dt.date.fromisoformat(at)
    facts = [(o[0], day_of(o[0], o[4])) for o in orders]
    expected = {}
    for k, *_ in suppliers:
        if k is not None:
            lo = dt.date(1995, 6, 1) + dt.timedelta(k % 40 * 50)
            hi = dt.date(9999, 12, 31) if k % 5 == 0 else lo + dt.timedelta(k % 4 * 700 - 3)
            expected.setdefault((k, str(lo)), []).extend((o, d) for o, d in facts if d and lo <= d <= hi)
    assert found == sorted((k, lo, len(x), max(o for o, _ in x if o is not None), len({d for _, d in x})) for (k, lo), x in expected.items() if x)
    assert met == [len({d for _, d in facts}), len({s[0] for s in suppliers})]  # not a row an order: 4,100 facts, 93 ranges
