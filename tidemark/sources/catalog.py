"""Tables found by name, and their union."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.reshape import SOURCE_COLUMN, union_aligned


def _like(pattern: str) -> re.Pattern:
    """A SQL LIKE pattern (% and _) as a regular expression that ignores case."""
    glob = "".join({"%": "*", "_": "?"}.get(ch, f"[{ch}]" if ch in "*?[" else ch) for ch in pattern)
    return re.compile(fnmatch.translate(glob), re.IGNORECASE)


def tables_like(spark: SparkSession, schema_like: str, table_like: str, exclude: str = "") -> list[str]:
    """Names `schema.table` of the tables and views whose names match, sorted."""
    in_schema, in_table = _like(schema_like), _like(table_like)
    left_out = _like(exclude) if exclude else None
    found = []
    for database in spark.catalog.listDatabases():
        if not in_schema.match(database.name):
            continue
        for table in spark.catalog.listTables(database.name):
            if table.isTemporary or not in_table.match(table.name) or (left_out and left_out.match(table.name)):
                continue
            found.append(f"{database.name}.{table.name}")
    return sorted(found)


def tables_with_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> list[str]:
    return tables_like(spark, schema, prefix + "%", exclude)


def union_tables(spark: SparkSession, tables: Iterable[str], source_col: str | None = SOURCE_COLUMN,
                 where: str | None = None) -> DataFrame:
    """Union of the named tables, such as all shards of one dated table."""
    return union_aligned({name: spark.table(name) for name in tables}, source_col=source_col, where=where)
