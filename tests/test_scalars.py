"""Scalar functions on the published example values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as sc
from tidemark.functions.documents import json_value, project_json
from tidemark.functions.web import url_host, url_param, url_path
from tidemark.operators import select


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"i int, {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_safe_arithmetic(spark):
    triples = "a int, b int, c int"
    assert column(spark, [(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], triples,
                  sc.safe_add("a", "b", "c")) == [6, 4, 2, 0]
    assert column(spark, [(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], triples,
                  sc.safe_subtract("a", "b", "c")) == [0, 1, -2, 0]
    pairs = [(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)]
    assert column(spark, pairs, "n int, d int", sc.safe_divide("n", "d")) == [None, 2, None, None, None, None, None, 0]


def test_width_bucket(spark):
    values = [190000, 290000, 320000, 399999.99, 400000, 470000, 510000, 610000]
    for formula in (False, True):
        found = column(spark, [(float(v),) for v in values], "v double",
                       sc.width_bucket("v", 200000, 600000, 4, edge_formula=formula))
        assert found == [0, 1, 2, 2, 3, 3, 4, 5]


def test_surrogate_key(spark):
    data = [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)]
    kind = "x string, y string, z string"
    assert column(spark, data, kind, sc.surrogate_key("x")) == [
        "0cc175b9c0f1b6a831c399e269772661"] * 2 + ["f14cc5cdce0420f4a5a6b6d9d7b85f39"] * 2
    assert column(spark, data, kind, sc.surrogate_key("x", "y", "z")) == [
        "7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05", "2fa5491950d66d153d23cfbcfea4e164"]
    assert column(spark, [(None, "b", None)], kind, sc.surrogate_key("x", "y", nulls_as_empty=True)) == column(
        spark, [("", "b", None)], kind, sc.surrogate_key("x", "y"))


def test_haversine(spark):
    place = [(48.864716, 2.349014, 52.379189, 4.899431)]
    kind = "a double, b double, c double, d double"
    assert round(column(spark, place, kind, sc.haversine("a", "b", "c", "d"))[0]) == 267
    assert round(column(spark, place, kind, sc.haversine("a", "b", "c", "d", "km"))[0]) == 430
    with pytest.raises(ValueError):
        sc.haversine("a", "b", "c", "d", "ly")


def test_urls(spark):
    urls = [("www.google.co.uk?utm_source=google",), ("http://witanddelight.com/2018/01/tips-tricks/",),
            ("https://www.nytimes.com/2018/01/01/blog",), ("android-app://m.facebook.com/",),
            ("docs.nytimes.com/2021/01/01/index.js?utm_source=google",), ("https://m.facebook.com/",)]
    assert column(spark, urls, "u string", url_host("u")) == [
        "www.google.co.uk", "witanddelight.com", "www.nytimes.com", "m.facebook.com", "docs.nytimes.com", "m.facebook.com"]
    assert column(spark, urls[:3], "u string", url_path("u")) == ["", "2018/01/tips-tricks/", "2018/01/01/blog"]
    assert column(spark, [("http://witanddelight.com/2018/01/tips-tricks/?a=1",)], "u string", url_path("u")) == ["2018/01/tips-tricks/"]
    assert column(spark, [("no-slash-or-query",)], "u string", url_path("u")) == ["no-slash-or-query"]
    milky = [("https://example.com/milky?utm_medium=organic",), ("https://example.com/milky?utm_medium=organic&utm_source=github",)]
    assert column(spark, milky, "u string", url_param("u", "utm_medium")) == ["organic", "organic"]
    assert column(spark, milky, "u string", url_param("u", "utm_source")) == [None, "github"]
    assert column(spark, [("x?my_utm_source=z",)], "u string", url_param("u", "utm_source")) == ["z"]


def test_json_scalars(spark):
    text = '{"a": {"b": 5}, "c": "{}", "d": null, "e": [1], "f": 1.5, "G": true}'
    df = spark.createDataFrame([(text,), ("not json",)], "j string")
    paths = ("a", "a.b", "c", "d", "e", "f", "G", "g")
    found = df.select(*[json_value("j", p) for p in paths]).collect()
    assert list(found[0]) == [None, "5", "{}", None, None, "1.5", "true", None]
    assert set(found[1]) == {None}
    typed = project_json(df, "j", {"b": ("$.a.b", "bigint"), "c": ("c", "double"), "e0": ("$.e[0]", "int")}).collect()
    assert [tuple(r) for r in typed] == [(5, None, 1), (None, None, None)]


def test_slugify_and_labels(spark):
    assert select.slugify("!Hell0 world-hi") == "hell0_world_hi"
    assert select.slugify("0Hell0 world-hi") == "_0hell0_world_hi"
    flags = [(True,), (False,), (None,)]
    assert column(spark, flags, "f boolean", sc.yes_no(F.col("f"))) == ["yes", "no", "no"]
    pairs = [(1, 2), (None, 2)]
    assert column(spark, pairs, "a int, b int", sc.largest("a", "b")) == [2, None]
    assert column(spark, pairs, "a int, b int", sc.smallest("a", "b")) == [1, None]
    assert column(spark, [(2.5,), (3.5,), (-2.5,)], "v double", sc.rounded_int("v")) == [3, 4, -3]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1] * 10 + [1e6 + 0.2, -1e6]
    for order in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "v double")
        assert df.agg(sc.money_sum("v")).first()[0] == 1.2
    assert spark.createDataFrame([], "v double").agg(sc.money_sum("v")).first()[0] is None


def test_column_selection(spark):
    df = spark.createDataFrame([(1, "", None)], "field_1 int, field_2 string, field_3 string")
    assert select.filtered_columns(df, ["FIELD_3"]) == ["field_1", "field_2"]
    assert select.star(df, prefix="prefix_", suffix="_suffix").columns == [f"prefix_field_{n}_suffix" for n in (1, 2, 3)]
    assert select.star(df, except_=df.columns).columns == []
    assert tuple(select.empty_to_null(df).first()) == (1, None, None)
    staged = select.stage(df, columns=["field_1", "field_2"], renames={"field_1": "id"}, casts={"field_2": "int"})
    assert staged.dtypes == [("id", "int"), ("field_2", "int")]
    with pytest.raises(ValueError):
        select.stage(df, columns=["nowhere"])


def test_exact_sums_round_away_from_zero_and_never_saturate(spark):
    halves = spark.createDataFrame([(0.125,), (-0.125,), (-0.125,)], "x double")
    assert str(halves.agg(sc.exact_sum("x")).first()[0]) == "-0.13"
    large = spark.createDataFrame([(1e18,), (1e18,)], "x double")
    assert float(large.agg(sc.exact_sum("x", 6)).first()[0]) == 2e18
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|ARITHMETIC_OVERFLOW|cannot be represented"):
        spark.createDataFrame([(1e27,)], "x double").agg(sc.exact_sum("x", 6)).collect()


def test_slugified_column_equals_slugify(spark):
    texts = ["!Hell0 world-hi", "0Hell0 world-hi", "A  -- b", "", "1"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(select.slugified(F.col("t"))).collect()] == [select.slugify(t) for t in texts]
