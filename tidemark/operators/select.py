"""Projections and column selection."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import from_epoch
from tidemark.functions.common import fold, missing_from, quoted


@dataclass(frozen=True)
class StageSpec:
    """What a staging view keeps of its source: plain data, one record per view."""

    columns: tuple[str, ...] | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    casts: Mapping[str, str] = field(default_factory=dict)
    epochs: tuple[str, ...] = ()
    where: str | None = None


def stage(df: DataFrame, spec: StageSpec | None = None, *, columns: Iterable[str] | None = None,
          renames: Mapping[str, str] | None = None, casts: Mapping[str, str] | None = None,
          epochs: Iterable[str] = (), where: str | None = None) -> DataFrame:
    """Explicit column list with renames, casts and epoch columns turned into timestamps.

    `where` is applied to the source columns, before anything is renamed.
    """
    spec = spec or StageSpec(tuple(columns) if columns is not None else None, renames or {}, casts or {},
                             tuple(epochs), where)
    chosen = list(spec.columns) if spec.columns is not None else df.columns
    absent = missing_from(df, chosen)
    if absent:
        raise ValueError(f"the source has no columns {absent}")
    seconds = fold(spec.epochs)
    renamed = {old.lower(): new for old, new in spec.renames.items()}
    source = df.filter(spec.where) if spec.where else df

    def output(name: str) -> Column:
        column = quoted(name)
        if name.lower() in seconds:
            column = from_epoch(column)
        if name in spec.casts:
            column = column.try_cast(spec.casts[name])
        return column.alias(renamed.get(name.lower(), name))

    return source.select(*[output(name) for name in chosen])


def epoch_to_ts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace epoch-second columns by timestamps."""
    return df.withColumns({name: from_epoch(quoted(name)) for name in columns})


def filtered_columns(df: DataFrame, except_: Iterable[str] = ()) -> list[str]:
    """Column names without the given ones, whatever their case."""
    left_out = fold(except_)
    return [name for name in df.columns if name.lower() not in left_out]


def star(df: DataFrame, except_: Iterable[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    """All columns but the given ones, optionally with a prefix and a suffix on their names."""
    kept = filtered_columns(df, except_)
    return df.select(*[quoted(name).alias(f"{prefix}{name}{suffix}") for name in kept])


def empty_to_null(df: DataFrame) -> DataFrame:
    """NULL in place of empty text, in every text column."""
    def output(f: T.StructField) -> Column:
        column = quoted(f.name)
        return F.nullif(column, F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else column

    return df.select(*[output(f) for f in df.schema.fields])


def slugify(text: str) -> str:
    """A safe lower-case column name: runs of blanks and dashes become one underscore."""
    joined = re.sub(r"[ -]+", "_", text.lower())
    safe = re.sub(r"[^a-z0-9_]+", "", joined)
    return "_" + safe if safe[:1].isdigit() else safe


def slugified(text: Column) -> Column:
    """`slugify` of the values of a column."""
    safe = F.regexp_replace(F.regexp_replace(F.lower(text), "[ -]+", "_"), "[^a-z0-9_]+", "")
    return F.regexp_replace(safe, "^(?=[0-9])", "_")


def first_slot(tests: Iterable[Column], values: Iterable[Column], otherwise=None) -> Column:
    """Value of the first of several parallel slots whose test holds."""
    result: Column | None = None
    for test, value in zip(tests, values, strict=True):
        result = F.when(test, value) if result is None else result.when(test, value)
    if result is None:
        raise ValueError("no slots given")
    return result.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def null_column(kind: str) -> Column:
    """A column that is NULL in every row."""
    return F.lit(None).cast(kind)


def top_parent_flag(own_id: str, parent_id: str) -> Column:
    """"Yes" for a row that is its own top parent, otherwise "No"."""
    return F.when(F.col(parent_id) == F.col(own_id), "Yes").otherwise("No")
