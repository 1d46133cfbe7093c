"""Join shapes of a customer data mart.

Which side is broadcast, sorted or split is left to Spark, which knows the sizes at run time; only
tables whose size is bounded by construction (one row, one calendar) are marked for broadcast.
Right sides are reduced to one row per key before they are joined wherever the meaning allows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.common import names, quoted
from tidemark.operators.skew import hashable, heavy_keys, with_stretch
from tidemark.operators.windows import latest_per_key


def enrich(fact: DataFrame, dimensions: Iterable[tuple[DataFrame, str | list[str]]], how: str = "left") -> DataFrame:
    """Join one dimension after the other to a fact on columns of the same name."""
    for dimension, on in dimensions:
        fact = fact.join(dimension, names(on), how)
    return fact


def bridge_join(left: DataFrame, bridge: DataFrame, right: DataFrame, left_key: str, right_key: str,
                bridge_left: str | None = None, bridge_right: str | None = None,
                how: str = "left", right_how: str | None = None) -> DataFrame:
    """Join two tables through a bridge of key pairs that may hold repeated pairs.

    The pairs are made distinct first.  The result has the columns of both tables, those of the right
    one NULL where a pair leads nowhere.  `how` applies to the bridge and, unless `right_how` says
    otherwise, to the right.
    """
    first, second = bridge_left or left_key, bridge_right or right_key
    pairs = bridge.select(quoted(first).alias("_pair_left"), quoted(second).alias("_pair_right")).distinct()
    linked = left.join(pairs, left[left_key] == pairs["_pair_left"], how).drop("_pair_left")
    far = right.withColumnRenamed(right_key, "_right_key")
    joined = linked.join(far, F.col("_pair_right") == F.col("_right_key"), right_how or how)
    kept = [quoted(c) for c in left.columns]
    return joined.select(*kept, F.col("_right_key").alias(right_key),
                         *[quoted(c) for c in right.columns if c != right_key])


def latest_join(left: DataFrame, right: DataFrame, on: str | list[str], order, how: str = "inner") -> DataFrame:
    """Join each left row with the latest right row of its key."""
    return left.join(latest_per_key(right, on, order), names(on), how)


def hierarchy_join(df: DataFrame, child_key: str, parent_key: str, columns: Iterable[str], prefix: str = "parent_",
                   how: str = "inner") -> DataFrame:
    """Join a table with itself: `child_key` refers to `parent_key` of another row."""
    above = df.select(quoted(parent_key).alias("_above_key"), *[quoted(c).alias(prefix + c) for c in columns])
    return df.join(above, quoted(child_key) == F.col("_above_key"), how).drop("_above_key")


def role_join(df: DataFrame, dimension: DataFrame, roles: Mapping[str, str], key: str, columns: Iterable[str],
              how: str = "left") -> DataFrame:
    """Join the same dimension once per role; `roles` maps a name prefix to the fact's key column."""
    columns = list(columns)
    for role, fact_key in roles.items():
        part = dimension.select(quoted(key).alias("_role_key"), *[quoted(c).alias(f"{role}_{c}") for c in columns])
        df = df.join(part, quoted(fact_key) == F.col("_role_key"), how).drop("_role_key")
    return df


def cross_spine(df: DataFrame, start, end, step: str = "INTERVAL 1 MONTH", name: str = "month") -> DataFrame:
    """Every row once per date of a calendar from `start` to `end`, both included.

    The dates are written out row by row, so nothing is joined or shuffled.
    """
    first = start if isinstance(start, Column) else F.lit(start).cast("date")
    last = end if isinstance(end, Column) else F.lit(end).cast("date")
    return df.select("*", F.explode(F.sequence(first, last, F.expr(step))).alias(name))


def with_scalar(df: DataFrame, aggregate: Column, of: DataFrame, name: str) -> DataFrame:
    """Add one aggregate of a whole table to every row."""
    return df.withColumn(name, of.agg(aggregate).scalar())


def _span(df: DataFrame, column: str) -> tuple[Column, Column]:
    return df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()


def date_range_join(df: DataFrame, ranges: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """Join on `column BETWEEN low AND high` for dates: each range is written out as its days.

    Ranges are first clipped to the dates there are, so an open end such as 9999-12-31 costs no more rows.
    """
    first, last = _span(df, column)
    inside = ranges.filter(F.col(low) <= F.col(high)).withColumns({"_low": F.greatest(low, first), "_high": F.least(high, last)})
    days = inside.filter(F.col("_low") <= F.col("_high")).select(
        *[quoted(c) for c in ranges.columns], F.explode(F.sequence("_low", "_high")).alias("_range_day"))
    return df.join(days, F.col(column) == F.col("_range_day"), "inner").drop("_range_day")


VALUES_PER_PART = 10_000


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt out to all shuffle partitions: the matches of a few MB can be very many, and adaptive execution, which goes by
    size, would leave them to one task.  Both sides of a join need it, for either may be the one that is not broadcast."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def range_join(df: DataFrame, ranges: DataFrame, column: str, low: str, high: str, bin_width: float) -> DataFrame:
    """Join on `column BETWEEN low AND high` for numbers, as an equi-join on bins.

    A range is repeated once per bin it touches and a value lies in one bin, so each match is found
    once.  Pick a width close to that of a usual range; bins end where the values do.
    """
    width = F.lit(bin_width)
    first, last = _span(df, column)
    inside = ranges.filter((F.col(low) <= F.col(high)) & (F.col(high) >= first) & (F.col(low) <= last))
    binned = inside.select(
        "*", F.explode(F.sequence(F.floor(F.greatest(F.col(low), first) / width), F.floor(F.least(F.col(high), last) / width))).alias("_range_bin"))
    placed = df.withColumn("_value_bin", F.floor(F.col(column) / width))
    # A bin of many values is dealt out to several tasks by a hash of the rows; its ranges go to each of them.
    parts = placed.filter(F.col("_value_bin").isNotNull()).groupBy(F.col("_value_bin").alias("_bin")).agg(
        F.ceil(F.count(F.lit(1)) / VALUES_PER_PART).alias("_parts"))
    dice = F.xxhash64(*[quoted(f.name) for f in df.schema.fields if hashable(f.dataType)])
    dealt = placed.join(parts, F.col("_value_bin") == F.col("_bin")).select(
        *[quoted(c) for c in df.columns], "_value_bin", F.pmod(dice, "_parts").alias("_value_part"))
    copied = binned.join(parts, F.col("_range_bin") == F.col("_bin")).select(
        *[quoted(c) for c in ranges.columns], "_range_bin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_range_part"))
    match = ((F.col("_value_bin") == F.col("_range_bin")) & (F.col("_value_part") == F.col("_range_part"))
             & F.col(column).between(F.col(low), F.col(high)))
    found = _spread(dealt, "_value_bin", "_value_part").join(_spread(copied, "_range_bin", "_range_part"), match, "inner")
    return found.drop("_value_bin", "_value_part", "_range_bin", "_range_part")


FACTS_PER_PIECE, FAN = 1000, 64


def pieces_of_ranges(df: DataFrame, ranges: DataFrame, column: str, low: str, high: str, rows_per_piece: int = FACTS_PER_PIECE,
                     fan: int = FAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts with the piece they lie in, and ranges once per group of `fan` pieces that they cover as a whole and once
    per further piece that they touch.

    Pieces end at sampled quantiles of the facts.  A border is a value and a hash of the row, so a value that very
    many facts share spreads over several pieces.
    """
    kind = ranges.select(F.coalesce(F.lit(None).cast(df.schema[column].dataType), low, high).alias("k")).schema["k"].dataType
    facts = df.filter(F.col(column).isNotNull())
    dice = F.xxhash64(*[quoted(f.name) for f in df.schema.fields if hashable(f.dataType)])
    place = F.struct(F.col(column).cast(kind).alias("at"), dice.alias("dice"))
    # One key for all rows; nothing that may fold to a literal, for a join on literals would be a nested loop.
    keyed = facts.withColumn("_all", F.xxhash64(column).bitwiseAND(F.lit(0)))
    borders = heavy_keys(keyed, ["_all"], place, rows_per_piece).select("_all", "_borders")

    def in_piece(rows: DataFrame, value: Column, name: str) -> DataFrame:
        return with_stretch(rows, borders, ["_all"], value, name, one_key=True).withColumn(name, F.coalesce(name, F.lit(0).cast("long")))

    def end(bound: str, least: bool) -> Column:
        return F.struct(F.col(bound).cast(kind).alias("at"), F.lit(-(2**63) if least else 2**63 - 1).cast("long").alias("dice"))

    placed = in_piece(keyed, place, "_piece").drop("_all")
    spans = ranges.filter(F.col(low) <= F.col(high)).withColumn("_all", F.monotonically_increasing_id().bitwiseAND(F.lit(0)))
    spans = in_piece(in_piece(spans, end(low, True), "_from"), end(high, False), "_to").drop("_all")
    # Pieces between the first and the last one hold no fact outside the range.
    spans = spans.withColumns({"_first": F.ceil((F.col("_from") + 1) / fan), "_last": F.floor(F.col("_to") / fan) - 1})
    some = F.col("_first") <= F.col("_last")
    kept = [quoted(c) for c in ranges.columns]
    covered = spans.filter(some).select(*kept, F.explode(F.sequence("_first", "_last")).alias("_group"))
    before = F.sequence(F.col("_from"), F.col("_first") * fan - 1)
    after = F.sequence((F.col("_last") + 1) * fan, F.col("_to"))
    touched = spans.select(*kept, F.explode(F.when(some, F.concat(before, after)).otherwise(F.sequence("_from", "_to"))).alias("_touched"))
    return placed, covered, touched


def quantile_range_join(df: DataFrame, ranges: DataFrame, column: str, low: str, high: str, rows_per_piece: int = FACTS_PER_PIECE,
                        fan: int = FAN) -> DataFrame:
    """Join on `column BETWEEN low AND high` for any sortable type, whatever the lengths of the ranges.

    Two equi-joins: groups of pieces that a range covers, where nothing is compared, and the pieces at its ends,
    where values are.  A range costs a row per group and some 2 x `fan` for its ends, not one per day or bin.
    NULL values and bounds match nothing, as do ranges that end before they begin.
    """
    placed, covered, touched = pieces_of_ranges(df, ranges, column, low, high, rows_per_piece, fan)
    kept = [quoted(c) for c in (*df.columns, *ranges.columns)]
    grouped = _spread(placed.withColumn("_group", F.floor(F.col("_piece") / fan)), "_group")
    inside = grouped.join(_spread(covered, "_group"), "_group").select(*kept)
    at_ends = (F.col("_piece") == F.col("_touched")) & F.col(column).between(F.col(low), F.col(high))
    return inside.unionAll(_spread(placed, "_piece").join(_spread(touched, "_touched"), at_ends).select(*kept))


def full_join(left: DataFrame, right: DataFrame, keys: str | list[str]) -> DataFrame:
    return left.join(right, names(keys), "full")


def anti_join(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Left rows without a partner.  Only distinct right keys travel."""
    keys = names(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def flag_exists(df: DataFrame, other: DataFrame, on: str, name: str, other_key: str | None = None) -> DataFrame:
    """True where the key occurs in the other table."""
    present = other.select(quoted(other_key or on).alias("_present")).distinct()
    return df.join(present, quoted(on) == F.col("_present"), "left").select(
        *[quoted(c) for c in df.columns], F.col("_present").isNotNull().alias(name))
