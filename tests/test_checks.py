"""Every check once on rows that pass and once on rows that fail."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks as c
from tidemark.operators import suite

D, T = dt.date, dt.datetime


def table(spark, data, kind):
    return spark.createDataFrame(data, kind)


def test_single_column_checks(spark, rows):
    df = table(spark, [(1, "a"), (2, "a"), (None, ""), (None, None)], "id int, kind string")
    assert c.unique(df, "id").count() == 0 and rows(c.unique(df, "kind")) == [("a", 2)]
    assert c.not_null(df.filter("id > 0"), "id").count() == 0 and c.not_null(df, "id").count() == 2
    assert c.accepted_values(df, "kind", ["a", ""]).count() == 0
    assert rows(c.accepted_values(df, "kind", ["a"])) == [("", 1)]
    assert c.not_accepted_values(df, "kind", ["b"]).count() == 0
    assert rows(c.not_accepted_values(df, "kind", ["a", "b"])) == [("a",)]
    assert c.not_empty_string(df.filter("id > 0"), "kind").count() == 0
    blank = table(spark, [(" ",), ("x",)], "s string")
    assert c.not_empty_string(blank, "s").count() == 1 and c.not_empty_string(blank, "s", trim=False).count() == 0


def test_accepted_range(spark):
    df = table(spark, [(-1,), (11,), (None,)], "id int")
    assert c.accepted_range(df, "id", -1, 11).count() == 0
    assert c.accepted_range(df, "id", -2, 11.1, inclusive=False).count() == 0
    assert c.accepted_range(df, "id", -1, 11, inclusive=False).count() == 2
    assert c.accepted_range(df, "id", low=0).count() == 1 and c.accepted_range(df, "id").count() == 0


def test_at_least_one_looks_at_every_group(spark, rows):
    df = table(spark, [("x", "a"), ("x", None), ("y", None)], "g string, field string")
    assert c.at_least_one(df, "field").count() == 0
    assert rows(c.at_least_one(df, "field", "g")) == [("y", 0)]
    assert c.at_least_one(df.filter("g = 'y'"), "field").count() == 1


def test_cardinality_equality(spark, rows):
    a = table(spark, [(1,), (2,), (3,)], "same_name int")
    b = table(spark, [(1, 2), (2, 3), (3, 1)], "same_name int, different_name int")
    assert c.cardinality_equality(a, "same_name", b, "different_name").count() == 0
    more = table(spark, [(1,), (1,), (2,)], "v int")
    assert rows(c.cardinality_equality(a, "same_name", more, "v")) == [
        (1, 1, "a_minus_b"), (1, 2, "b_minus_a"), (3, 1, "a_minus_b")]


def test_row_counts(spark, rows):
    a, b = table(spark, [(1,), (1,), (2,)], "g int"), table(spark, [(1,), (1,), (3,)], "g int")
    assert c.equal_rowcount(a, b).count() == 0 and c.equal_rowcount(a, b, "g").count() == 0
    sides = c.equal_rowcount(a, b, "g", strict=True).select("g_a", "g_b", "count_a", "count_b", "diff_count")
    assert rows(sides) == [(None, 3, None, 1, 1), (2, None, 1, None, 1)]
    assert c.equal_rowcount(a, b.filter("g = 1")).first()["diff_count"] == 1
    four = table(spark, [(1,)] * 4, "g int")
    assert c.fewer_rows_than(a, four).count() == 0 and c.fewer_rows_than(a, four, "g").count() == 0
    assert c.fewer_rows_than(four, a).first()["row_count_delta"] == 1
    assert c.fewer_rows_than(a, a).first()["row_count_delta"] == 1
    assert c.fewer_rows_than(a, four, "g", strict=True).count() == 1


def test_equality_ignores_multiplicity(spark, rows):
    a, b = table(spark, [(1, "x"), (1, "x"), (2, None)], "id int, n string"), table(spark, [(1, "x"), (2, None)], "id int, n string")
    assert c.equality(a, b).count() == 0
    b2 = table(spark, [(1, "x"), (2, "y")], "id int, n string")
    assert rows(c.equality(a, b2)) == [("a_minus_b", 2, None), ("b_minus_a", 2, "y")]
    assert c.equality(a, b2, ["id"]).count() == 0


def test_expression_is_true(spark):
    df = table(spark, [(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0)], "col_a double, col_b double")
    assert c.expression_is_true(df, "col_a + col_b = 1").count() == 0
    assert c.expression_is_true(df, "> 0", column="col_a").count() == 1
    assert c.expression_is_true(df, F.col("col_a") > 0, where="col_b < 1").count() == 0


def test_ranges(spark):
    plain = table(spark, [(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    assert c.mutually_exclusive_ranges(plain, "lo", "hi", gaps="not_allowed", rows_per_piece=1).count() == 0
    assert c.mutually_exclusive_ranges(plain, "lo", "hi", gaps="required").count() == 2
    overlapping = table(spark, [(0, 2), (1, 3)], "lo int, hi int")
    assert c.mutually_exclusive_ranges(overlapping, "lo", "hi").count() == 1
    gaps = table(spark, [(1, D(2019, 1, 1), D(2019, 2, 1)), (1, D(2019, 3, 3), D(2019, 4, 1)), (2, D(2019, 5, 6), D(2019, 7, 2)),
                         (2, D(2019, 7, 3), None)], "id int, lo date, hi date")
    open_end = F.coalesce("hi", F.lit("2099-12-31").cast("date"))
    assert c.mutually_exclusive_ranges(gaps, "lo", open_end, "id", gaps="required").count() == 0
    assert c.mutually_exclusive_ranges(gaps, "lo", open_end, "id", gaps="not_allowed").count() == 2
    assert c.mutually_exclusive_ranges(gaps, "lo", "hi", "id").count() == 1  # an unknown end fails
    zero = table(spark, [(3, D(2020, 5, 8), D(2020, 5, 8)), (3, D(2020, 5, 8), D(2020, 5, 10))], "id int, lo date, hi date")
    assert c.mutually_exclusive_ranges(zero, "lo", "hi", "id", zero_length=True).count() == 0
    assert c.mutually_exclusive_ranges(zero, "lo", "hi", "id").count() == 1
    copies = table(spark, [(0, 5)] * 3 + [(5, 6)], "lo int, hi int")
    assert [r["n_records"] for r in c.mutually_exclusive_ranges(copies, "lo", "hi").collect()] == [2]
    for wrong in ({"gaps": "some"}, {"zero_length": "yes"}):
        with pytest.raises(ValueError):
            c.mutually_exclusive_ranges(plain, "lo", "hi", **wrong)


def test_constants_and_proportions(spark, rows):
    df = table(spark, [(1, 1), (1, 1), (1, 2), (2, None)], "col_a int, field int")
    assert c.not_constant(df, "field").count() == 0 and rows(c.not_constant(df, "field", "col_a")) == []
    assert rows(c.not_constant(df.filter("field = 1"), "field", "col_a")) == [(1, 1)]
    share = table(spark, [(1 if i % 2 else None, None if i == 3 else 1) for i in range(10)], "point_5 int, point_9 int")
    assert c.not_null_proportion(share, "point_5", 0.5, 0.5).count() == 0
    assert c.not_null_proportion(share, "point_9", 0.9).count() == 0
    assert c.not_null_proportion(share, "point_5", 0.6).count() == 1


def test_recency(spark):
    df = table(spark, [(1, T(2024, 1, 30, 1)), (2, None)], "g int, created_at timestamp")
    assert c.recency(df, "created_at", "day", 1, "2024-01-31 00:00:00").count() == 0
    assert c.recency(df, "created_at", "hour", 1, "2024-01-31 00:00:00", group_by="g").count() == 1
    assert c.recency(df, "created_at", "day", 1, "2024-01-31 23:00:00").count() == 1
    assert c.recency(df, "created_at", "day", 1, "2024-01-31 23:00:00", ignore_time=True).count() == 0


def test_relationships(spark, rows):
    child, parent = table(spark, [(1,), (2,), (4,), (4,), (None,)], "id int"), table(spark, [(1,), (2,), (3,)], "id int")
    assert rows(c.relationships(child, "id", parent, "id")) == [(4, 2)]
    assert c.relationships_where(child, "id", parent, "id", from_condition="id <> 4").count() == 0
    assert rows(c.relationships_where(child, "id", parent, "id", "id <> 4", "id > 1")) == [(1, 1)]


def test_sequences(spark, rows):
    df = table(spark, [(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "col_a int, my_even_sequence int")
    for options in ({}, {"rows_per_piece": 1}):
        assert c.sequential_values(df, "my_even_sequence", 2, **options).count() == 0
        assert c.sequential_values(df, "my_even_sequence", 3, **options).count() == 4
    assert c.sequential_values(df, "my_even_sequence", 2, group_by="col_a").count() == 0
    assert c.sequential_values(df, "my_even_sequence", 3, group_by="col_a").count() == 3
    hours = table(spark, [(T(2021, 1, 1, h),) for h in range(4)], "at timestamp")
    assert c.sequential_values(hours, "at", 1, "hour").count() == 0 and c.sequential_values(hours, "at", 2, "hour").count() == 3
    repeated = table(spark, [(1,), (2,), (2,), (2,), (3,)], "v int")
    assert rows(c.sequential_values(repeated, "v")) == [(2, 2, 2)]


def test_combinations_columns_and_pairs(spark, rows):
    df = table(spark, [("2019-01", p, 1) for p in ("jaffle", "lamington", "pavlova")] + [("2019-02", "jaffle", 1)], "month string, product string, revenue int")
    assert c.unique_combination_of_columns(df, ["month", "product"]).count() == 0
    assert rows(c.unique_combination_of_columns(df, ["month", "revenue"])) == [("2019-01", 1, 3)]
    assert c.columns_match_set(df, ["MONTH", "product", "revenue"]).count() == 0
    assert rows(c.columns_match_set(df, ["month", "product", "cost"])) == [("cost", "not_found"), ("revenue", "not_expected")]
    pairs = table(spark, [(1, 1), (None, 1), (2, 3)], "actual int, expected int")
    assert rows(c.assert_equal(pairs, "actual", "expected")) == [(2, 3)]


def test_strict_counts_take_null_for_a_group(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "k int")
    assert c.equal_rowcount(df, df, "k", strict=True).count() == 0
    assert c.equal_rowcount(df, df.limit(0), "k", strict=True).count() == 2
    found = c.fewer_rows_than(df, df, "k", strict=True).collect()
    assert sorted(r["row_count_delta"] for r in found) == [1, 1]


MESSY = "k int, g string, v double, at timestamp"


def messy(spark):
    rows = [(i % 7 if i % 5 else None, "ab"[i % 2] if i % 11 else "", float(i % 3) if i % 4 else None, dt.datetime(2024, 1, 1 + i % 9)) for i in range(200)]
    return spark.createDataFrame(rows + [(None, None, None, None)] * 3 + [(9, "only", 1.0, None)], MESSY)


def test_a_suite_finds_what_its_checks_find(spark, tmp_path):
    path = str(tmp_path / "t")
    messy(spark).write.parquet(path)
    df = spark.read.schema(MESSY).parquet(path)
    now = "2024-01-10"
    pairs = [
        (suite.not_null("k"), c.not_null(df, "k"), ()),
        (suite.not_empty_string("g"), c.not_empty_string(df, "g"), ()),
        (suite.accepted_range("v", 1), c.accepted_range(df, "v", 1), ()),
        (suite.accepted_range("v", high=1, inclusive=False, name="below one"), c.accepted_range(df, "v", high=1, inclusive=False), ()),
        (suite.expression_is_true("k > v"), c.expression_is_true(df, "k > v"), ()),
        (suite.assert_equal("k", "v"), c.assert_equal(df, "k", "v"), ()),
        (suite.at_least_one("at"), c.at_least_one(df, "at"), ()),
        (suite.not_constant("at"), c.not_constant(df, "at"), ()),
        (suite.unique("k"), c.unique(df, "k"), ("unique_field",)),
        (suite.unique_combination_of_columns(["k", "g"]), c.unique_combination_of_columns(df, ["k", "g"]), ("k", "g")),
        (suite.accepted_values("k", [1, 2]), c.accepted_values(df, "k", [1, 2]), ("value_field",)),
        (suite.not_accepted_values("g", ["a"]), c.not_accepted_values(df, "g", ["a"]), ("value_field",)),
        (suite.at_least_one("at", "g", name="at by g"), c.at_least_one(df, "at", "g"), ("g",)),
        (suite.not_constant("v", "g", name="v by g"), c.not_constant(df, "v", "g"), ("g",)),
        (suite.not_null_proportion("v", 0.8, group_by="k"), c.not_null_proportion(df, "v", 0.8, group_by="k"), ("k",)),
        (suite.recency("at", "day", 1, now, group_by="g"), c.recency(df, "at", "day", 1, now, group_by="g"), ("g",)),
    ]
    found = suite.run_suite(df, [check for check, _, _ in pairs])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    found = found.collect()
    failed = 0
    for check, single, keys in pairs:
        mine, rows = [r for r in found if r.check == check.name], single.collect()
        failed += bool(rows)
        if keys:
            assert sorted(r.key for r in mine) == sorted(", ".join("NULL" if r[k] is None else str(r[k]) for k in keys) for r in rows), check.name
            if "n_records" in single.columns:
                assert sorted(r.n_records for r in mine) == sorted(r.n_records for r in rows), check.name
        elif check.measures.keys() == {f"{check.name} n"}:
            assert [r.n_records for r in mine] == [len(rows)] * bool(rows), check.name
        else:
            assert len(mine) == len(rows), check.name
    assert failed >= 13


def test_a_suite_over_no_rows(spark):
    none = messy(spark).limit(0)
    checks = [suite.at_least_one("v"), suite.not_null("v"), suite.unique("v"), suite.at_least_one("v", "k", name="by k"), suite.not_null_proportion("v", 0.5)]
    assert [r.check for r in suite.run_suite(none, checks).collect()] == ["at_least_one v"] and c.at_least_one(none, "v").count() == 1
    assert suite.run_suite(none, [suite.not_null("v")]).count() == 0
    with pytest.raises(ValueError, match="same name"):
        suite.run_suite(none, [suite.not_null("v"), suite.not_null("v")])


def test_equality_by_digest(spark, rows):
    a = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'x' END AS p", "CASE WHEN id % 3 > 0 THEN 'x' END AS q")
    swapped = a.withColumn("p", F.when(F.col("id") == 77, F.col("q")).otherwise(F.col("p"))).withColumn(
        "q", F.when(F.col("id") == 77, F.lit(None)).otherwise(F.col("q")))  # the same values, NULL in another place
    b = swapped.filter("id <> 5").unionAll(a.filter("id = 9"))  # a lost row, and one that comes twice
    assert rows(suite.equality_by_digest(a, b)) == rows(c.equality(a, b)) and c.equality(a, b).count() == 3
    ours, theirs = suite.differing_rows(a, b.repartition(5), a.columns)
    assert ours.count() <= 20 and theirs.count() <= 20  # of 20,000: the rest is never shuffled
    assert suite.differing_rows(a, a.sort(F.desc("id")), a.columns)[0].count() == 0
    twice = a.limit(2).unionAll(a.limit(2))
    assert suite.equality_by_digest(a.limit(2), twice).count() == 0
    assert suite.equality_by_digest(a.limit(0), a.limit(0)).count() == 0 and suite.equality_by_digest(a.limit(0), a.limit(3)).count() == 3
