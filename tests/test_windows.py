"""Ordered operators: results with heavy keys cut into pieces equal those of a plain window."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import windows as w
from tidemark.operators.skew import heavy_keys

CUT = {"rows_per_piece": 4}


@pytest.fixture(scope="module")
def sequence(spark):
    """A third of the rows in key 1, NULL keys, NULL values and NULL moments."""
    pick = random.Random(7)
    data = [(1 if i % 3 == 0 else pick.choice([2, 3, 4, None]), None if i == 30 else pick.randrange(1000) * 1000 + i,
             pick.choice([None, None, i])) for i in range(400)]
    return spark.createDataFrame(data, "k int, t int, v int").cache()


@pytest.mark.parametrize("options", [{}, CUT, {"rows_per_piece": 1}])
def test_pieces_change_nothing(sequence, rows, options):
    window = Window.partitionBy("k").orderBy("t")
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    expected = {
        "fill": sequence.withColumn("x", F.last("v", True).over(so_far)),
        "first": sequence.withColumn("x", F.first("v", True).over(so_far)),
        "next": sequence.withColumn("x", F.lead("v").over(window)),
        "previous": sequence.withColumn("x", F.lag("v").over(window)),
        "change": sequence.withColumn("x", F.coalesce(F.col("t") - F.lag("t").over(window), F.col("t"))),
        "ranks": sequence.withColumn("up", F.row_number().over(window).cast("bigint")).withColumn(
            "down", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("t"))).cast("bigint")),
    }
    found = {
        "fill": w.forward_fill(sequence, "k", "t", "v", "x", **options),
        "first": w.first_known(sequence, "k", "t", "v", "x", **options),
        "next": w.next_value(sequence, "k", "t", "v", "x", **options),
        "previous": w.previous_value(sequence, "k", "t", "v", "x", **options),
        "change": w.change_from_previous(sequence, "k", "t", "t", "x", **options),
        "ranks": w.rank_both_ways(sequence, "k", "t", "up", "down", **options),
    }
    for name in expected:
        assert rows(found[name]) == rows(expected[name]), name


def test_whole_table_is_cut(sequence, rows):
    expected = sequence.withColumn("place", F.row_number().over(Window.orderBy("t")).cast("bigint"))
    assert rows(w.ordered_scan(sequence, None, "t", [w.place("place")], **{"rows_per_piece": 9})) == rows(expected)


def test_null_order_values(spark, rows):
    """What lies before NULL moments reaches the stretches after them."""
    df = spark.createDataFrame([(None, 5), (1, None), (2, None), (3, 7), (4, None)], "t int, v int").withColumn("k", F.lit(1))
    for options in ({}, {"rows_per_piece": 1}, {"rows_per_piece": 2}):
        assert rows(w.forward_fill(df, "k", "t", "v", "f", **options).select("t", "f")) == [(None, 5), (1, 5), (2, 5), (3, 7), (4, 7)]
        assert rows(w.previous_value(df, "k", "t", "v", "p", **options).select("t", "p")) == [(None, None), (1, 5), (2, None), (3, None), (4, 7)]


def test_text_orders_are_cut(spark, rows):
    data = [(k, f"{chr(97 + i % 26)}{i:03}" if i % 11 else None, i if i % 3 else None) for k in ("a", "b") for i in range(60)]
    df = spark.createDataFrame(data, "k string, o string, v int")
    window = Window.partitionBy("k").orderBy("o", "v")
    expected = df.withColumn("f", F.last("v", True).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(w.forward_fill(df, "k", ["o", "v"], "v", "f", rows_per_piece=5)) == rows(expected)
    assert rows(w.rank_both_ways(df, None, ["o", "v", "k"], rows_per_piece=7).select("o", "rank_asc")) == rows(
        df.withColumn("rank_asc", F.row_number().over(Window.orderBy("o", "v", "k")).cast("bigint")).select("o", "rank_asc"))
    with pytest.raises(ValueError):
        w.ordered_scan(df, None, "o", [w.place("n")], rows_per_piece=None)


ORDERS = {
    "numbers, one far off": ["CASE WHEN id = 7 THEN -1000000000000000 ELSE id END"],
    "texts of one prefix": ["concat('https://example.org/a/long/prefix/', lpad(id, 8, '0'))"],
    "times as text": ["date_format(timestamp_seconds(1700000000 + 60 * id), \"yyyy-MM-dd'T'HH:mm:ss\")"],
    "equal leading values": ["'same'", "date '2024-01-01'", "id"],
    "few leading values": ["id % 3", "lpad(id, 8, '0')"],
    "bytes": ["CAST(concat('prefix', lpad(id, 8, '0')) AS BINARY)"],
    "arrays": ["array(1, id DIV 1000, id)"],
    "some that repeat": ["CASE WHEN id < 5000 THEN id DIV 10 ELSE id END"],
    "NULL in places": ["CASE WHEN id % 5 > 0 THEN 'x' END", "id"],
}


@pytest.mark.parametrize("name", ORDERS)
@pytest.mark.parametrize("piece", [2000, 50])
def test_stretches_are_even(spark, name, piece):
    """No piece of a heavy key has more than twice the rows asked for, and pieces follow each other along the order."""
    order = [f"o{i}" for i in range(len(ORDERS[name]))]
    df = spark.range(20_000).selectExpr("CASE WHEN id % 50 = 0 THEN id END AS k", *[f"{e} AS {o}" for e, o in zip(ORDERS[name], order)])
    cut, only_cut = w.in_stretches(df, ["k"], order, piece)
    found = only_cut.groupBy("k", "_stretch").agg(
        F.count("*").alias("n"), F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high"))
    follows = (F.lag("high").over(Window.orderBy("_stretch")) < F.col("low")).alias("follows")
    found = found.select("k", "n", "_stretch", follows).orderBy("_stretch").collect()
    assert sum(r.n for r in found) == 19_600 and max(r.n for r in found) <= 2 * piece and len(found) >= 19_600 / piece / 2
    assert all(r.k is None for r in found) and all(r.follows for r in found[1:])
    assert cut.filter("_stretch = -1").count() == 400


def test_cutting_is_the_same_in_every_run(spark):
    """A task that is run again, on rows in another order, must find the same borders."""
    df = spark.range(5_000).selectExpr("id % 2 AS k", "concat('prefix', id) AS o")
    borders = [sorted(map(str, heavy_keys(rows, ["k"], F.struct("o"), 100).collect())) for rows in (df, df.repartition(7).sort(F.desc("o")))]
    assert borders[0] == borders[1] and len(borders[0]) == 2


def test_ties_of_the_whole_order_stay_together(spark, rows):
    df = spark.range(1_000).selectExpr("1 AS k", "id DIV 100 AS o", "id % 7 AS v")
    window = Window.orderBy("o")
    expected = df.withColumn("rank", F.dense_rank().over(window).cast("bigint"))
    assert rows(w.dense_rank_within(df, "k", "o", rows_per_piece=10)) == rows(expected)


def test_heavy_keys(sequence):
    assert [r["k"] for r in heavy_keys(sequence, ["k"], F.struct("t"), rows_per_piece=100).collect()] == [1]


def test_deduplicate(spark, rows):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1), (None, "a", 1), (None, "b", 2)], "user_id int, event string, version int")
    assert rows(w.deduplicate(df, "user_id", F.desc("version"))) == [(None, "b", 2), (1, "play", 2), (2, "pause", 1)]


def test_latest_rows_are_reduced_before_the_shuffle(sequence):
    plan = w.latest_per_key(sequence, "k", F.desc("t"))._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_dense_rank_and_closest(spark, rows):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 9), ("b", 1), (None, 3)], "k string, v int")
    assert rows(w.dense_rank_within(df, "k", "v")) == [(None, 3, 1), ("a", 5, 1), ("a", 5, 1), ("a", 9, 2), ("b", 1, 1)]
    assert rows(w.closest_by(df, "k", F.abs(F.col("v") - 6))) == [(None, 3), ("a", 5), ("a", 5), ("b", 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, None]), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=25))
def test_forward_fill_by_brute_force(spark, data):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(data)], "k int, t int, v int")
    known, expected = {}, []
    for i, (k, v) in enumerate(data):
        known[k] = v if v is not None else known.get(k)
        expected.append((i, known[k]))
    found = w.forward_fill(df, "k", "t", "v", "f", rows_per_piece=2).select("t", "f").collect()
    assert sorted(tuple(r) for r in found) == expected


def test_no_row_carries_all_borders_of_its_key(spark):
    def joined(plan):
        children = [plan.children().apply(i) for i in range(plan.children().size())]
        here = [{plan.output().apply(i).name() for i in range(plan.output().size())}] if plan.nodeName() == "Join" else []
        return here + [names for child in children for names in joined(child)]

    df = spark.range(30_000).select("id", (F.col("id") % 2).alias("k"), F.concat(F.lit("x" * 60), F.lpad("id", 9, "0")).alias("t"))
    for keys in ("k", None):
        plan = w.rank_both_ways(df, keys, "t", "up", "down", rows_per_piece=5)._jdf.queryExecution().optimizedPlan()
        assert joined(plan) and not any("_borders" in names for names in joined(plan))
    cut, only_cut = w.in_stretches(df, ["k"], ["t"], 5)
    for rows in (cut, only_cut):  # some 3,000 pieces a key, more than two steps' worth of one array
        pieces = rows.groupBy("k", "_stretch").agg(F.count("*").alias("n"), F.min("t").alias("low"), F.max("t").alias("high")).orderBy("k", "_stretch").collect()
        assert len(pieces) > 5000 and sum(p.n for p in pieces) == 30_000
        assert all(a.k != b.k or a.high < b.low for a, b in zip(pieces, pieces[1:]))
