"""Pivots, unpivots, unions and value lists on the published examples."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import reshape as r


def test_pivot_cols(spark, rows):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    quoted = df.groupBy("size").agg(*r.pivot_cols("color", ["red", "blue"]))
    assert quoted.columns == ["size", "red", "blue"] and rows(quoted) == [("M", 1, 0), ("S", 1, 1)]
    slugged = df.groupBy("size").agg(*r.pivot_cols("color", ["red", "blue's"], quote=False, prefix="n "))
    assert slugged.columns == ["size", "n_red", "n_blues"] and rows(slugged) == [("M", 1, 0), ("S", 1, 1)]


def test_pivot_periods_keeps_keys_without_listed_periods(spark, rows):
    df = spark.createDataFrame([("a", "2022-01", 5), ("a", "2022-01", 7), ("b", "2019-05", 1)], "k string, m string, v int")
    wide = r.pivot_periods(df, "k", "m", "v", ["2022-01", "2022-02"], alias="msp")
    assert wide.columns == ["k", "msp_2022-01", "msp_2022-02"]
    assert rows(wide) == [("a", 12, None), ("b", None, None)]


def test_unpivot(spark, rows):
    d = dt.date
    data = [(123, d(2017, 1, 1), "active", "tier 1", "name 1", True), (234, d(2017, 2, 1), "active", "tier 3", "name 3", False),
            (567, d(2017, 3, 1), "churned", "tier 2", "name 2", None)]
    df = spark.createDataFrame(data, "customer_id int, created_at date, status string, segment string, name string, is_updated boolean")
    melted = r.unpivot(df, "string", exclude=["customer_id", "created_at"], remove=["NAME"], field_name="prop", value_name="val")
    assert melted.columns == ["customer_id", "created_at", "prop", "val"]
    found = {(x["customer_id"], x["prop"]): x["val"] for x in melted.collect()}
    assert len(found) == 9 and found[123, "is_updated"] == "true" and found[234, "is_updated"] == "false"
    assert found[567, "is_updated"] is None and found[567, "segment"] == "tier 2"


def test_union_aligned(spark, rows):
    one = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    two = spark.createDataFrame([(1, "green", 7), (2, "pink", 13)], "id int, favorite_color string, favorite_number int")
    union = r.union_aligned({"t1": one, "t2": two})
    assert union.columns == [r.SOURCE_COLUMN, "id", "name", "favorite_number", "favorite_color"]
    assert dict(union.dtypes)["favorite_number"] == "string"
    assert rows(union)[3:] == [("t2", 1, None, "7", "green"), ("t2", 2, None, "13", "pink")]
    for name in ("name", "NAME"):
        assert "name" not in r.union_aligned({"t1": one, "t2": two}, exclude=[name], source_col=None).columns
    assert r.union_aligned({"t1": one, "t2": two}, include=["id"], source_col=None, where="id = 2").count() == 2
    assert dict(r.union_aligned({"t1": one, "t2": two}, overrides={"id": "bigint"}).dtypes)["id"] == "bigint"
    with pytest.raises(ValueError):
        r.union_aligned({"t1": one}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        r.union_aligned({"t1": one}, include=["nothing"])


def test_column_values(spark):
    df = spark.createDataFrame([(f, "left" if f in "aceg" else "right") for f in "abcdef" + "g" * 5], "field string, side string")
    assert r.column_values(df, "field").first()["n_records"] == 5
    assert r.list_column_values(df, "field", where="side = 'left'") == ["g", "a", "c", "e"]
    assert r.list_column_values(df, "field", max_records=1) == ["g"]
    assert r.list_column_values(None, "field", default=["x"]) == ["x"]
    with pytest.raises(ValueError):
        r.list_column_values(None, "field")


def test_single_value_and_dict(spark):
    df = spark.createDataFrame([(19, "string_a")], "n int, s string")
    assert r.single_value(df) == 19 and r.single_value(df.filter("n = 0"), default=7) == 7
    assert r.as_dict(df) == {"n": [19], "s": ["string_a"]}
    with pytest.raises(ValueError):
        r.as_dict(spark.range(5), limit=4)


def test_slots_and_except(spark, rows):
    df = spark.createDataFrame([(1, "a", 2, None, 3), (2, None, 4, "b", 5)], "id int, p0 string, q0 int, p1 string, q1 int")
    long = r.slots_to_rows(df, ["id"], [{"p": "p0", "q": "q0"}, {"p": "p1", "q": "q1"}], "p", "slot")
    assert rows(long) == [(1, 0, "a", 2), (2, 1, "b", 5)]
    left, right = spark.createDataFrame([(1,), (1,), (2,)], "x int"), spark.createDataFrame([(2,)], "x int")
    assert rows(r.except_distinct(left, right)) == [(1,)]
    assert df.select(F.lit(1)).count() == 2
