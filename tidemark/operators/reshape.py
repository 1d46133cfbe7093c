"""Pivot, unpivot, unions and other changes of shape."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.common import as_column, fold, names, quoted
from tidemark.operators.select import slugify

# Fixed value: the default name of the column that says which table a row came from.
SOURCE_COLUMN = "_dbt_source_relation"
MAX_LISTED_VALUES = 10_000


def pivot_periods(df: DataFrame, keys: str | list[str], period: Column | str, value: Column | str,
                  periods: Sequence[str], agg: str = "sum", alias: str | None = None) -> DataFrame:
    """One column per listed period, NULL where a key has no rows in it.

    Rows of other periods add nothing, but their keys stay.  Columns are named by the period, or
    `alias_period`.  Other periods are folded into one before the first aggregation, so that it
    returns at most len(periods) + 1 rows per key from each task.
    """
    label = as_column(period)
    source = df.select(*[quoted(k) for k in names(keys)],
                       F.when(label.isin(*periods), label).alias("_period"), as_column(value).alias("_value"))
    aggregate = getattr(F, agg)(F.col("_value"))
    wide = source.groupBy(*names(keys)).pivot("_period", list(periods)).agg(aggregate)
    if alias is None:
        return wide
    return wide.select(*[quoted(k) for k in names(keys)], *[quoted(p).alias(f"{alias}_{p}") for p in periods])


def pivot_cols(column: str, values: Sequence, agg: str = "sum", cmp: str = "=", prefix: str = "", suffix: str = "",
               then_value=1, else_value=0, distinct: bool = False, quote: bool = True) -> list[Column]:
    """One conditional aggregate per value, for use in `agg`.

    Rows that do not match count as `else_value`.  Without `quote` the names are slugged.
    """
    comparisons = {
        "=": lambda c, v: c == v, "!=": lambda c, v: c != v, "<>": lambda c, v: c != v,
        ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
    }
    if cmp not in comparisons:
        raise ValueError(f"unknown comparison {cmp!r}")
    functions = {"count": F.count_distinct, "sum": F.sum_distinct} if distinct else {}
    aggregate = functions.get(agg) or getattr(F, agg)

    def literal(value):
        return value if isinstance(value, Column) else F.lit(value)

    outputs = []
    for value in values:
        hit = comparisons[cmp](F.col(column), F.lit(value))
        name = f"{prefix}{value}{suffix}"
        chosen = F.when(hit, literal(then_value)).otherwise(literal(else_value))
        outputs.append(aggregate(chosen).alias(name if quote else slugify(name)))
    return outputs


def union_aligned(tables: Mapping[str, DataFrame], include: Iterable[str] = (), exclude: Iterable[str] = (),
                  overrides: Mapping[str, str] | None = None, source_col: str | None = SOURCE_COLUMN,
                  where: str | None = None) -> DataFrame:
    """UNION ALL of tables with different columns.

    Columns come in the order in which they are first seen, with the type they first have (or the
    one in `overrides`); a table without a column gives NULL.  `where` filters each table before
    its columns are aligned.
    """
    include, exclude = fold(include), fold(exclude)
    if include and exclude:
        raise ValueError("give columns to include or to exclude, not both")
    if not tables:
        raise ValueError("no tables to union")
    types = {name.lower(): kind for name, kind in (overrides or {}).items()}
    layout: dict[str, tuple[str, str | T.DataType]] = {}
    for df in tables.values():
        for f in df.schema.fields:
            key = f.name.lower()
            if key in exclude or (include and key not in include):
                continue
            layout.setdefault(key, (f.name, types.get(key, f.dataType)))
    if not layout:
        raise ValueError(f"no columns left to union of {list(tables)}")

    def aligned(label: str, df: DataFrame) -> DataFrame:
        have = fold(df.columns)
        source = df.filter(where) if where else df
        tag = [] if source_col is None else [F.lit(label).alias(source_col)]
        return source.select(*tag, *[
            (quoted(name) if key in have else F.lit(None)).cast(kind).alias(name)
            for key, (name, kind) in layout.items()])

    parts = [aligned(label, df) for label, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def unpivot(df: DataFrame, cast_to: str = "string", exclude: Iterable[str] = (), remove: Iterable[str] = (),
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """One row per remaining column and source row; NULL values are kept.

    `exclude` columns are repeated on every row, `remove` columns are dropped.  The table is read once.
    """
    kept, dropped = fold(exclude), fold(remove)
    ids = [c for c in df.columns if c.lower() in kept]
    melted = [c for c in df.columns if c.lower() not in kept | dropped]
    if not melted:
        raise ValueError("no columns left to unpivot")
    casted = df.select(*[quoted(c) for c in ids], *[quoted(c).cast(cast_to).alias(c) for c in melted])
    return casted.unpivot([quoted(c) for c in ids], [quoted(c) for c in melted], field_name, value_name)


def slots_to_rows(df: DataFrame, keys: Sequence[str], slots: Sequence[Mapping[str, str]], required: str,
                  slot_name: str | None = None) -> DataFrame:
    """Parallel column groups ("slots") as rows; slots without a `required` value are left out.

    Each slot maps the output name to the source column.  The table is read once.
    """
    def packed(number: int, slot: Mapping[str, str]) -> Column:
        return F.struct(F.lit(number).alias("_slot"), *[quoted(source).alias(name) for name, source in slot.items()])

    items = F.array(*[packed(i, slot) for i, slot in enumerate(slots)])
    rows = df.select(*[quoted(k) for k in keys], F.explode(items).alias("_item"))
    fields = [F.col(f"_item.{name}").alias(name) for name in slots[0]]
    number = [F.col("_item._slot").alias(slot_name)] if slot_name else []
    return rows.select(*[quoted(k) for k in keys], *number, *fields).filter(F.col(required).isNotNull())


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left table that the right one lacks; columns are matched by name."""
    return left.subtract(right.select(*left.columns))


def column_values(df: DataFrame, column: str, order: str = "count", max_records: int | None = None,
                  where: str | None = None) -> DataFrame:
    """Distinct values of a column with their counts, by falling count or rising value."""
    if order not in ("count", "value"):
        raise ValueError("order must be 'count' or 'value'")
    source = df.filter(where) if where else df
    counted = source.groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))
    by = [F.desc("n_records"), F.asc("value")] if order == "count" else [F.asc("value")]
    ordered = counted.orderBy(*by)
    return ordered.limit(max_records) if max_records is not None else ordered


def list_column_values(df: DataFrame | None, column: str, order: str = "count", max_records: int | None = None,
                       default: list | None = None, where: str | None = None) -> list:
    """The same values as a Python list, for column names of a pivot.  Runs at once.

    `df` None stands for a table that does not exist.  More than MAX_LISTED_VALUES values are an error.
    """
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and there is no default")
        return default
    rows = column_values(df, column, order, max_records, where).limit(MAX_LISTED_VALUES + 1).collect()
    if len(rows) > MAX_LISTED_VALUES:
        raise ValueError(f"{column} has more than {MAX_LISTED_VALUES} values; use column_values")
    return [row["value"] for row in rows] or (default if default is not None else [])


def single_value(df: DataFrame, default=None):
    """First value of the first row, or `default` if there is no row.  Runs at once."""
    row = df.limit(1).first()
    return default if row is None else row[0]


def as_dict(df: DataFrame, limit: int = MAX_LISTED_VALUES) -> dict[str, list]:
    """A small result as column lists.  Runs at once; a result beyond `limit` rows is an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"the result has more than {limit} rows")
    return {name: [row[i] for row in rows] for i, name in enumerate(df.columns)}
