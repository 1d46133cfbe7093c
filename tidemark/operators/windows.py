"""Row-to-row operators along an order: latest row, fill, change, neighbours and ranks.

Ordered operators keep one sort per key.  A key that is too heavy for one task is cut into
stretches of its order; each stretch is a window of its own, and what a stretch needs from the ones
before or after it (one row per heavy key and stretch) is joined back.  Results equal those of a
plain window, NULL order values included.  Borders are tuples of all order columns, of any type that
can be sorted by; only rows that agree in all of them stay in one stretch for certain.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.common import names, quoted
from tidemark.operators.skew import ROWS_PER_PIECE, heavy_keys, same_keys, with_stretch


def _order(order) -> list:
    return list(order) if isinstance(order, (list, tuple)) else [order]


def latest_per_key(df: DataFrame, keys: str | list[str], order, rows: int = 1) -> DataFrame:
    """The first `rows` rows of each key in the given order (e.g. `F.desc("ts")`).

    Spark keeps only that many rows per key in each task before it shuffles, so a heavy key does
    not travel whole.  End the order with a unique column if the answer must not depend on ties.
    """
    window = Window.partitionBy(*names(keys)).orderBy(*_order(order))
    return df.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= rows).drop("_place")


def deduplicate(df: DataFrame, keys: str | list[str], order) -> DataFrame:
    """Exactly one whole row per key, a NULL key included."""
    return latest_per_key(df, keys, order, 1)


# -- ordered scans ------------------------------------------------------------------------------

@dataclass(frozen=True)
class Scan:
    """One output column of an ordered scan.

    in_window  the value within a stretch, given the ascending window of the stretch
    summary    what a stretch tells the others (an aggregate)
    carry      what reaches a stretch, given the summary column and the ascending window of stretches
    merge      final value out of the value within the stretch and what reached it
    """

    name: str
    in_window: Callable[[Window], Column]
    summary: Column
    carry: Callable[[Column, Window], Column]
    merge: Callable[[Column, Column], Column]


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _so_far(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _whole(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _moment(order: Column) -> Column:
    """The order value in a struct, for `max_by` and `min_by` pass over rows whose order is NULL."""
    return F.struct(order.alias("at"))


def _present(value: Column, order: Column) -> Column:
    return F.when(value.isNotNull(), _moment(order))


def filled(name: str, column: str, order: Column) -> Scan:
    value = F.col(column)
    return Scan(
        name,
        lambda w: F.last(value, ignorenulls=True).over(_so_far(w)),
        F.max_by(value, _present(value, order)),
        lambda s, w: F.last(s, ignorenulls=True).over(_before(w)),
        lambda own, carried: F.coalesce(own, carried),
    )


def first_seen(name: str, column: str, order: Column) -> Scan:
    value = F.col(column)
    return Scan(
        name,
        lambda w: F.first(value, ignorenulls=True).over(_so_far(w)),
        F.min_by(value, _present(value, order)),
        lambda s, w: F.first(s, ignorenulls=True).over(_before(w)),
        lambda own, carried: F.coalesce(carried, own),
    )


def neighbour(name: str, column: str, order: Column, following: bool) -> Scan:
    """Value of the row before (or after).  Held in a struct, so that "no row" and NULL differ."""
    value = F.struct(F.col(column).alias("v"))
    shift = F.lead if following else F.lag
    edge = F.min_by if following else F.max_by
    return Scan(
        name,
        lambda w: shift(value).over(w),
        edge(value, _moment(order)),
        lambda s, w: shift(s).over(w),
        lambda own, carried: F.coalesce(own, carried)["v"],
    )


def place(name: str, descending: bool = False) -> Scan:
    """Row number from the start or, descending, from the end."""
    def own(window):
        number = F.row_number().over(window).cast("bigint")
        return F.count(F.lit(1)).over(_whole(window)) - number + 1 if descending else number

    def others(size, window):
        if descending:
            return F.sum(size).over(_whole(window)) - F.sum(size).over(_so_far(window))
        return F.sum(size).over(_before(window))

    return Scan(
        name,
        own,
        F.count(F.lit(1)),
        others,
        lambda own_place, carried: own_place + F.coalesce(carried, F.lit(0)),
    )


def dense_place(name: str, order: Column) -> Scan:
    """Dense rank: equal order values share a number, and none is left out."""
    return Scan(
        name,
        lambda w: F.dense_rank().over(w).cast("bigint"),
        F.count_distinct(_moment(order)),
        lambda s, w: F.sum(s).over(_before(w)),
        lambda own, carried: own + F.coalesce(carried, F.lit(0)),
    )


def ordered_scan(df: DataFrame, keys: str | list[str] | None, order: str | list[str], scans: list[Scan],
                 rows_per_piece: int | None = ROWS_PER_PIECE) -> DataFrame:
    """Add the columns of `scans`, computed along ascending `order` (column names) within `keys`.

    Without keys the whole table is one key.  Heavy keys are found by counting rows per key beforehand;
    where no key can be heavy, for example after an aggregation by key and month, `rows_per_piece=None`
    spares the count.
    """
    keys, order, columns = names(keys), names(order), df.columns
    whole_table = not keys
    if whole_table:
        if rows_per_piece is None:
            raise ValueError("a sequence over a whole table is always cut")
        # One key for all rows; no literal, for a join on literals would be a nested loop.
        keys, df = ["_all"], df.withColumn("_all", F.xxhash64(quoted(order[0])).bitwiseAND(F.lit(0)))
    if rows_per_piece is None:
        window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*[quoted(c) for c in order])
        plain = df.select("*", *[s.in_window(window).alias(f"_own_{i}") for i, s in enumerate(scans)])
        return _finish(plain, columns, scans, carried=False)
    cut, only_cut = in_stretches(df, keys, order, rows_per_piece, whole_table)
    by_key = [quoted(k) for k in keys]
    summary = only_cut.groupBy(*by_key, "_stretch").agg(*[s.summary.alias(f"_sum_{i}") for i, s in enumerate(scans)])
    across = Window.partitionBy(*by_key).orderBy("_stretch")
    carry = summary.select(
        *[quoted(k).alias(f"_c_{k}") for k in keys],
        F.col("_stretch").alias("_c_stretch"),
        *[s.carry(F.col(f"_sum_{i}"), across).alias(f"_carry_{i}") for i, s in enumerate(scans)],
    )
    inside = Window.partitionBy(*by_key, "_stretch").orderBy(*[quoted(c) for c in order])
    own = cut.select("*", *[s.in_window(inside).alias(f"_own_{i}") for i, s in enumerate(scans)])
    match = same_keys(keys, "_c_") & (F.col("_stretch") == F.col("_c_stretch"))
    return _finish(own.join(carry, match, "left"), columns, scans, carried=True)


def in_stretches(df: DataFrame, keys: list[str], order: list[str], rows_per_piece: int,
                 one_key: bool = False) -> tuple[DataFrame, DataFrame]:
    """All rows with `_stretch`, which rises along the order (-1: the key is not cut), and the rows of cut keys alone."""
    value = _order_value(order)
    heavy = heavy_keys(df, keys, value, rows_per_piece).select(*[quoted(k) for k in keys], "_borders")
    cut = with_stretch(df, heavy, keys, value, one_key=one_key).withColumn("_stretch", F.coalesce("_stretch", F.lit(-1)))
    return cut, with_stretch(df, heavy, keys, value, how="inner", one_key=one_key)


def _finish(df: DataFrame, columns: list[str], scans: list[Scan], carried: bool) -> DataFrame:
    def value(i, scan):
        own = F.col(f"_own_{i}")
        return scan.merge(own, F.col(f"_carry_{i}") if carried else F.lit(None))

    replaced = {s.name.lower() for s in scans}
    kept = [quoted(c) for c in columns if c.lower() not in replaced]
    return df.select(*kept, *[value(i, s).alias(s.name) for i, s in enumerate(scans)])


def _order_value(order: list[str]) -> Column:
    return F.struct(*[quoted(c) for c in order])


def forward_fill(df: DataFrame, keys, order, column: str, name: str | None = None, **heavy) -> DataFrame:
    """Last known value so far, in place of NULLs."""
    by = names(order)
    return ordered_scan(df, keys, by, [filled(name or column, column, _order_value(by))], **heavy)


def first_known(df: DataFrame, keys, order, column: str, name: str | None = None, **heavy) -> DataFrame:
    """Earliest value that is not NULL, among the rows so far."""
    by = names(order)
    return ordered_scan(df, keys, by, [first_seen(name or column, column, _order_value(by))], **heavy)


def previous_value(df: DataFrame, keys, order, column: str, name: str, **heavy) -> DataFrame:
    by = names(order)
    return ordered_scan(df, keys, by, [neighbour(name, column, _order_value(by), following=False)], **heavy)


def next_value(df: DataFrame, keys, order, column: str, name: str, **heavy) -> DataFrame:
    by = names(order)
    return ordered_scan(df, keys, by, [neighbour(name, column, _order_value(by), following=True)], **heavy)


def change_from_previous(df: DataFrame, keys, order, column: str, name: str = "change", **heavy) -> DataFrame:
    """Difference to the row before; the whole value where there is none to compare with."""
    with_previous = previous_value(df, keys, order, column, "_previous", **heavy)
    difference = F.col(column) - F.col("_previous")
    return with_previous.withColumn(name, F.coalesce(difference, F.col(column))).drop("_previous")


def rank_both_ways(df: DataFrame, keys, order, up: str = "rank_asc", down: str = "rank_desc", **heavy) -> DataFrame:
    """Row numbers from the first and from the last row of each key."""
    return ordered_scan(df, keys, order, [place(up), place(down, descending=True)], **heavy)


def dense_rank_within(df: DataFrame, keys, order, name: str = "rank", **heavy) -> DataFrame:
    """Dense rank of an order value: equal values share a rank, no rank is left out."""
    by = names(order)
    return ordered_scan(df, keys, by, [dense_place(name, _order_value(by))], **heavy)


def closest_by(df: DataFrame, keys, distance: Column) -> DataFrame:
    """Rows of each key with the smallest distance; ties are all kept.

    Each task drops all rows but its closest ones before they are shuffled.
    """
    window = Window.partitionBy(*names(keys)).orderBy("_distance")
    ranked = df.withColumn("_distance", distance).withColumn("_rank", F.rank().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_distance", "_rank")


def top_n(df: DataFrame, order, n: int) -> DataFrame:
    """The first n rows of the whole table in the given order (each task keeps at most n)."""
    return df.orderBy(*_order(order)).limit(n)
