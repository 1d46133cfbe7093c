"""Shared helpers for arguments that may be column names or Columns."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Union[Column, str]


def as_column(value) -> Column:
    """A Column from a Column, a column name or a plain number."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def names(value: str | Iterable[str] | None) -> list[str]:
    """A list of column names from one name, several or none."""
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def quoted(name: str) -> Column:
    """The column with exactly this name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fold(items: Iterable[str]) -> set[str]:
    return {item.lower() for item in items}


def missing_from(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    have = fold(df.columns)
    return [name for name in wanted if name.lower() not in have]
