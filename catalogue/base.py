"""Registry of queries and access to the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.common import quoted
from tidemark.session import checkpoint_dir, tune

# Known schemas, so that no job has to read file footers before a query is planned.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The driver's tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder for files a query writes, below the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/tidemark-{label}-{uuid.uuid4().hex}"


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that no client's date types get in the way of a comparison."""
    def output(f: T.StructField):
        column = quoted(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return column

    return df.select(*[output(f) for f in df.schema.fields])


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the tables under its name, with the SQL that must give the same rows."""
    def register(build: Callable[[Tables], DataFrame]):
        label = name or build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Tables(tune(spark), folder)))

        if label in QUERIES:
            raise ValueError(f"query {label} is registered twice")
        QUERIES[label] = run
        if sql is not None:
            SQL[label] = sql
        return build

    return register
