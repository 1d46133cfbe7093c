"""Grouping helpers.  Sums and counts are combined within each task before they are shuffled."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.common import ColumnLike, as_column, names


def group_agg(df: DataFrame, keys: str | list[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """Group by `keys` and name the aggregates."""
    return df.groupBy(*names(keys)).agg(*[value.alias(name) for name, value in aggregates.items()])


def group_by_first(df: DataFrame, n: int, aggregates: Mapping[str, Column]) -> DataFrame:
    """Group by the first n columns of the table."""
    if not 0 < n <= len(df.columns):
        raise ValueError(f"cannot group by the first {n} of {len(df.columns)} columns")
    return group_agg(df, df.columns[:n], aggregates)


def having(df: DataFrame, keys: str | list[str], aggregates: Mapping[str, Column], condition: Column) -> DataFrame:
    """Groups whose aggregates meet a condition."""
    return group_agg(df, keys, aggregates).filter(condition)


def distinct_count(value: ColumnLike) -> Column:
    """Exact number of distinct values."""
    return F.count_distinct(as_column(value))


def rounded_average(value: ColumnLike) -> Column:
    """Average as the nearest whole number, halves away from zero.

    Averaged as decimals: the result does not depend on the order of the rows.
    """
    return F.round(F.avg(as_column(value).cast("decimal(18,4)"))).cast("bigint")


def any_of(value: ColumnLike) -> Column:
    """One value of the group, always the same one: the largest."""
    return F.max(as_column(value))


def pick_first(value: Column, order: Column) -> Column:
    """Value of the row with the smallest order value."""
    return F.min_by(value, order)


def total(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregates of the whole table, one row."""
    return df.agg(*[value.alias(name) for name, value in aggregates.items()])
