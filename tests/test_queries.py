"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import pytest

import __spark_entry__ as entry
from catalogue import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def canonical(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(value):
        return "NULL" if value is None else repr(round(value, 6)) if isinstance(value, float) else str(value)

    return [names[i] for i in order], sorted(tuple(text(row[i]) for i in order) for row in data)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = database.execute(SQL[name])
    expected = canonical([c[0] for c in result.description], result.fetchall())
    assert found == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython") if step in plan]


def test_filters_and_columns_reach_the_scan(spark):
    df = entry.queries()["revenue_by_month_pivot"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan
    scans = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    assert all("o_orderpriority" not in scan and "c_acctbal" not in scan for scan in scans)


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["customer", "resource_id"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_csv_in_blocks_is_written_by_several_tasks(spark, tmp_path):
    import glob

    from catalogue import QUERIES
    from tidemark.session import checkpoint_dir

    text = "first\nsecond, \"quoted\"\n" + "x" * 100
    documents = [(k, text, "en", "web", len(text)) for k in range(40)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    folder = checkpoint_dir(spark).removeprefix("file:")
    known = set(glob.glob(f"{folder}/tidemark-csv-*"))
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task a file
    try:
        assert QUERIES["csv_in_blocks"](spark, str(tmp_path)).count() == 160
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
    new = set(glob.glob(f"{folder}/tidemark-csv-*")) - known
    assert len(new) == 1 and len(glob.glob(f"{new.pop()}/part-*.csv")) == 2
