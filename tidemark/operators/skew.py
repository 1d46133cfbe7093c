"""Keys with too many rows for one task, and where to cut them along an order.

A key is cut by its own rows alone, whatever share of the table they are.  Borders are whole order tuples out of a
sample of its rows, so texts with one long prefix, and rows that agree in the leading columns, are cut as numbers
are; rows are dealt out by binary search over the borders.  Only rows whose whole tuples are equal stay together.
No row ever carries all borders of its key: it meets them in two steps of at most `LOT` each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.common import quoted

ROWS_PER_PIECE = 1_000_000
MOST_PIECES = 4096  # pieces of a key; a key of more rows than this many pieces hold is cut into larger ones
LOT = math.isqrt(MOST_PIECES)  # borders a row meets at once
SAMPLED = 64  # sampled rows a piece, which keeps pieces below twice their size
DICE = 1 << 40


def heavy_keys(df: DataFrame, keys: list[str], order: Column, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Keys of more than `rows_per_piece` rows, with `_rows` and `_borders` (ascending values of `order`).

    Rows are counted with partial results, so a heavy key costs one row per task; heavy keys alone are sampled.
    The sample hangs on a hash of the rows themselves, so a task that is run again draws the same one; equal rows
    of it are counted, not kept.  Where no key is heavy, adaptive execution drops everything behind the count.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows_per_piece)
    known = counted.select(*[quoted(k).alias(f"_k_{k}") for k in keys], "_rows")
    pieces = F.least(F.ceil(F.col("_rows") / rows_per_piece), F.lit(MOST_PIECES))
    dice = F.pmod(F.xxhash64(*[quoted(f.name) for f in df.schema.fields if hashable(f.dataType)]), F.lit(DICE))
    sample = df.select(*[quoted(k) for k in keys], order.alias("_order"), dice.alias("_dice")).join(known, same_keys(keys, "_k_"))
    sample = sample.filter(F.col("_dice") < SAMPLED * pieces / F.col("_rows") * DICE)
    sample = sample.groupBy(*keys, "_rows", "_order").agg(F.count(F.lit(1)).alias("_times"))
    by_key = Window.partitionBy(*[quoted(k) for k in keys], "_rows")
    upto = by_key.orderBy("_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    piece = F.floor((F.sum("_times").over(upto) - 1) * pieces / F.sum("_times").over(by_key))
    borders = sample.select(*[quoted(k) for k in keys], "_rows", "_order", piece.alias("_piece"))
    borders = borders.groupBy(*keys, "_rows", "_piece").agg(F.min("_order").alias("_border"))
    return borders.groupBy(*keys, "_rows").agg(F.sort_array(F.collect_list("_border")).alias("_borders"))


def hashable(kind: T.DataType) -> bool:
    """Whether values of a type have a hash; maps and variants have none."""
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind.fields)
    return hashable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def same_keys(keys: list[str], prefix: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & quoted(key).eqNullSafe(quoted(prefix + key))
    return condition


def with_stretch(df: DataFrame, heavy: DataFrame, keys: list[str], value: Column, name: str = "_stretch", how: str = "left",
                 one_key: bool = False) -> DataFrame:
    """Adds how many of the ascending `_borders` of a row's key are not above `value`: rises with it from 0 on, NULL
    where the key is not in `heavy`; `how="inner"` leaves such rows out.

    Joined whole, the borders of a heavy key would be written out beside each of its rows.  So a row meets every
    `LOT`-th border first and then those between two of them.  `one_key` says that there is at most one heavy key, so
    that its borders, bounded in number, may be broadcast.
    """
    small = F.broadcast if one_key else lambda borders: borders
    own = [quoted(c) for c in df.columns]
    of_key = [quoted(k).alias(f"_h_{k}") for k in keys]
    every = F.filter("_borders", lambda border, at: (at + 1) % LOT == 0)
    coarse = small(heavy.select(*of_key, every.alias("_every")))
    lot = F.when(F.col("_every").isNotNull(), _not_above(value, F.col("_every")))
    if how == "inner":
        lot = F.coalesce(lot, F.lit(0))
    rough = df.join(coarse, same_keys(keys, "_h_"), how).select(*own, lot.alias("_lot"))

    lots = heavy.select(*of_key, "_borders", F.explode(F.sequence(F.lit(0), F.size(every))).alias("_h__lot"))
    fine = small(lots.select(*[quoted(f"_h_{k}") for k in (*keys, "_lot")], F.slice("_borders", F.col("_h__lot") * LOT + 1, LOT - 1).alias("_between")))
    same_lot = same_keys(keys, "_h_") & (F.col("_lot") == F.col("_h__lot"))
    return rough.join(fine, same_lot, how).select(*own, (F.col("_lot") * LOT + _not_above(value, F.col("_between"))).cast("long").alias(name))


def _not_above(value: Column, borders: Column) -> Column:
    """How many of at most `LOT` ascending borders are not above the value, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in range(math.ceil(math.log2(LOT + 1)) - 1, -1, -1)])
    fits = lambda at, step: (at + step <= F.size(borders)) & (F.get(borders, at + step - 1) <= value)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(at, step), at + step).otherwise(at))
