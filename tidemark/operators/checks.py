"""Data-quality checks.  Each returns the failing rows; an empty result is a pass.

Where equal failing rows would only repeat each other, they come as one row with their number in
`n_records`, so that a value held by a third of a table is counted inside the tasks and not shipped.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.common import ColumnLike, as_column, fold, names, quoted
from tidemark.operators.select import slugify
from tidemark.operators.windows import neighbour, ordered_scan, place

GAP_RULES = {"not_allowed": "equal_to", "allowed": "less_than_or_equal_to", "required": "less_than"}


def _records() -> Column:
    return F.count(F.lit(1)).alias("n_records")


def _keys_match(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool = False) -> Column:
    def same(key: str) -> Column:
        a, b = left[f"{key}_a"], right[f"{key}_b"]
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda a, b: a & b, map(same, keys))


# -- one table ----------------------------------------------------------------------------------

def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    known = df.filter(quoted(column).isNotNull())
    return known.groupBy(quoted(column).alias("unique_field")).agg(_records()).filter(F.col("n_records") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(quoted(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list; NULL passes."""
    counted = df.groupBy(quoted(column).alias("value_field")).agg(_records())
    return counted.filter(~F.col("value_field").isin(*values))


def not_accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Distinct values that are on the list of forbidden ones."""
    return df.filter(quoted(column).isin(*values)).select(quoted(column).alias("value_field")).distinct()


def accepted_range(df: DataFrame, column: ColumnLike, low=None, high=None, inclusive: bool = True) -> DataFrame:
    """Rows outside the bounds; NULL passes, and so does everything if there are no bounds."""
    value = as_column(column)
    outside = F.lit(False)
    if low is not None:
        outside = outside | ~(value >= low if inclusive else value > low)
    if high is not None:
        outside = outside | ~(value <= high if inclusive else value < high)
    return df.filter(outside)


def at_least_one(df: DataFrame, column: str, group_by: str | list[str] | None = None) -> DataFrame:
    """Groups (or the whole table) without a single known value."""
    keys = names(group_by)
    counted = df.groupBy(*keys).agg(F.count(quoted(column)).alias("n_known"))
    return counted.filter(F.col("n_known") == 0)


def not_constant(df: DataFrame, column: str, group_by: str | list[str] | None = None) -> DataFrame:
    """Groups with exactly one distinct value; a group of NULLs passes.

    One distinct value means that the smallest equals the largest, so no distinct set is built.
    """
    value = quoted(column)
    ends = df.groupBy(*names(group_by)).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    constant = ends.filter(F.col("_low") == F.col("_high"))
    return constant.select(*names(group_by), F.lit(1).cast("bigint").alias("n_distinct"))


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    text = F.trim(quoted(column)) if trim else quoted(column)
    return df.filter(text == "")


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
                        group_by: str | list[str] | None = None) -> DataFrame:
    """Groups whose share of known values lies outside [at_least, at_most]."""
    keys = names(group_by)
    share = (F.count(quoted(column)) / F.count(F.lit(1))).alias("not_null_proportion")
    measured = df.groupBy(*keys).agg(share)
    return measured.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def expression_is_true(df: DataFrame, expression: str | Column, column: str | None = None,
                       where: str | None = None) -> DataFrame:
    """Rows for which the expression is false; unknown passes.

    With `column` the expression is the rest of a comparison, such as '> 0'.
    """
    rows = df.filter(where) if where else df
    if isinstance(expression, Column):
        return rows.filter(~expression)
    return rows.filter(f"NOT ({column or ''} {expression})")


def unique_combination_of_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once; NULL counts as a value."""
    return df.groupBy(*columns).agg(_records()).filter(F.col("n_records") > 1)


def recency(df: DataFrame, column: str, part: str, interval: int, now, ignore_time: bool = False,
            group_by: str | list[str] | None = None) -> DataFrame:
    """Groups whose latest moment lies more than `interval` parts before `now`; no moment passes."""
    keys = names(group_by)
    unit = {"quarter": ("MONTH", 3)}.get(part, (part.upper(), 1))
    now_column = now if isinstance(now, Column) else F.lit(str(now))
    limit = now_column.cast("timestamp") - F.expr(f"INTERVAL {int(interval) * unit[1]} {unit[0]}")
    kind = "date" if ignore_time else "timestamp"
    latest = df.groupBy(*keys).agg(F.max(quoted(column)).cast(kind).alias("most_recent"))
    return latest.withColumn("threshold", limit.cast(kind)).filter(F.col("most_recent") < F.col("threshold"))


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
                      group_by: str | list[str] | None = None, **heavy) -> DataFrame:
    """Values that are not the value before plus the interval, with that previous value.

    Equal values are counted first: their repeats follow each other, so they show up as
    (value, value) unless the interval is zero, with the number of such rows in `n_records`.
    """
    keys = names(group_by)
    previous = f"previous_{slugify(column)}"
    known = df.filter(quoted(column).isNotNull())  # a NULL neither fails nor can be compared with
    counted = known.groupBy(*keys, quoted(column).alias(column)).agg(_records())
    by = F.struct(quoted(column))
    lined_up = ordered_scan(counted, keys, [column], [neighbour(previous, column, by, following=False)], **heavy)

    def expected(value: Column) -> Column:
        if datepart is None:
            return value + F.lit(interval)
        unit = {"quarter": ("MONTH", 3)}.get(datepart, (datepart.upper(), 1))
        return value.cast("timestamp") + F.expr(f"INTERVAL {int(interval) * unit[1]} {unit[0]}")

    own = quoted(column) if datepart is None else quoted(column).cast("timestamp")
    repeats = F.when(own != expected(quoted(column)), F.col("n_records") - 1).otherwise(F.lit(0))
    steps = F.array(
        F.struct(quoted(previous).alias("p"),
                 F.when(own != expected(quoted(previous)), F.lit(1)).otherwise(0).cast("bigint").alias("n")),
        F.struct(quoted(column).alias("p"), repeats.cast("bigint").alias("n")),
    )
    rows = lined_up.select(*keys, quoted(column), F.explode(steps).alias("_step")).filter(F.col("_step.n") > 0)
    return rows.select(*keys, quoted(column), F.col("_step.p").alias(previous), F.col("_step.n").alias("n_records"))


def mutually_exclusive_ranges(df: DataFrame, lower: ColumnLike, upper: ColumnLike,
                              partition_by: ColumnLike | None = None, gaps: str = "allowed",
                              zero_length: bool = False, **heavy) -> DataFrame:
    """Ranges that are not proper, overlap the next one, or break the rule for gaps.

    Bounds and partition may be expressions.  Ranges that occur several times are counted first
    and come as one row per kind of failure, with their number in `n_records`.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {sorted(GAP_RULES)}, not {gaps!r}")
    if not isinstance(zero_length, bool):
        raise ValueError("zero_length must be True or False")
    keys = [] if partition_by is None else ["partition_by_col"]
    key_columns = [] if partition_by is None else [as_column(partition_by).alias("partition_by_col")]
    ranges = df.select(*key_columns, as_column(lower).alias("lower_bound"), as_column(upper).alias("upper_bound"))
    counted = ranges.groupBy(*keys, "lower_bound", "upper_bound").agg(_records())
    order = ["lower_bound", "upper_bound"]
    by = F.struct(*order)
    scanned = ordered_scan(counted, keys, order, [
        neighbour("next_lower_bound", "lower_bound", by, following=True), place("_from_end", descending=True)], **heavy)

    # Of n equal ranges, n - 1 are followed by their own lower bound and one by the next range.
    def step(bound, last, n):
        return F.struct(bound.alias("b"), last.alias("last"), n.cast("bigint").alias("n"))

    own, after, last = F.col("lower_bound"), F.col("next_lower_bound"), F.col("_from_end") == 1
    following = F.when(~last & own.eqNullSafe(after), F.array(step(own, F.lit(False), F.col("n_records")))).otherwise(
        F.array(step(after, last, F.lit(1)), step(own, F.lit(False), F.col("n_records") - 1)))
    rows = scanned.select(*keys, *order, F.explode(following).alias("_next")).filter(F.col("_next.n") > 0).select(
        *keys, *order, F.col("_next.b").alias("next_lower_bound"), F.col("_next.last").alias("is_last_record"),
        F.col("_next.n").alias("n_records"))

    low, high, after = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    unknown = low.isNull() | high.isNull()
    reversed_ = unknown | (low > high if zero_length else low >= high)
    breaks_rule = {"not_allowed": high != after, "allowed": high > after, "required": high >= after}[gaps]
    collides = ~F.col("is_last_record") & F.coalesce(breaks_rule, F.lit(True))
    return rows.filter(reversed_ | collides).select(
        "*", (~reversed_).alias(f"lower_bound_{'less_than_or_equal_to' if zero_length else 'less_than'}_upper_bound"),
        (~collides).alias(f"upper_bound_{GAP_RULES[gaps]}_next_lower_bound"))


def columns_match_set(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Column names that only the table or only the list has, whatever their case."""
    have, want = fold(df.columns), fold(columns)
    problems = [(name, "not_expected") for name in sorted(have - want)] + [
        (name, "not_found") for name in sorted(want - have)]
    pairs = [F.struct(F.lit(name).alias("column_name"), F.lit(problem).alias("problem")) for name, problem in problems]
    rows = F.array(*pairs).cast("array<struct<column_name:string,problem:string>>")
    return df.sparkSession.range(1).select(F.inline(rows))


def assert_equal(df: DataFrame, actual: ColumnLike, expected: ColumnLike) -> DataFrame:
    """Rows whose two columns differ; NULL passes."""
    return df.filter(as_column(actual) != as_column(expected))


# -- two tables ---------------------------------------------------------------------------------

def relationships(df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str | None = None,
                  to_condition: str | None = None) -> DataFrame:
    """Child values without a parent, with the number of rows that hold them; NULL passes.

    Both sides are reduced to distinct values before they meet.
    """
    children = df.filter(from_condition) if from_condition else df
    parents = to.filter(to_condition) if to_condition else to
    held = children.filter(quoted(column).isNotNull()).groupBy(quoted(column).alias("id")).agg(_records())
    known = parents.filter(quoted(field).isNotNull()).select(quoted(field).alias("id")).distinct()
    return held.join(known, "id", "left_anti")


def relationships_where(df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str = "true",
                        to_condition: str = "true") -> DataFrame:
    return relationships(df, column, to, field, from_condition, to_condition)


def _counts_side_by_side(a: DataFrame, b: DataFrame, keys: list[str], count_a: str, count_b: str,
                         strict: bool) -> DataFrame:
    left = a.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_a))
    right = b.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_b))
    if not keys:
        return left.select(count_a, right.scalar().alias(count_b))
    left = left.select(*[quoted(k).alias(f"{k}_a") for k in keys], count_a)
    right = right.select(*[quoted(k).alias(f"{k}_b") for k in keys], count_b)
    return left.join(right, _keys_match(left, right, keys, strict), "full")


def equal_rowcount(df: DataFrame, other: DataFrame, group_by: str | list[str] | None = None,
                   strict: bool = False) -> DataFrame:
    """Groups with different numbers of rows.  A group that one side lacks fails only if `strict`."""
    counts = _counts_side_by_side(df, other, names(group_by), "count_a", "count_b", strict)
    difference = F.abs(F.col("count_a") - F.col("count_b"))
    if strict:
        difference = F.abs(F.coalesce(F.col("count_a"), F.lit(0)) - F.coalesce(F.col("count_b"), F.lit(0)))
    return counts.withColumn("diff_count", difference).filter(F.col("diff_count") > 0)


def fewer_rows_than(df: DataFrame, other: DataFrame, group_by: str | list[str] | None = None,
                    strict: bool = False) -> DataFrame:
    """Groups that do not have fewer rows than in the other table.

    Equal numbers count as a difference of 1.  A group that one side lacks passes; with `strict`
    it counts as one of no rows.
    """
    counts = _counts_side_by_side(df, other, names(group_by), "count_our_model", "count_comparison_model", strict)
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    if strict:
        ours, theirs = F.coalesce(ours, F.lit(0)), F.coalesce(theirs, F.lit(0))
    excess = F.when(ours > theirs, ours - theirs).when(ours == theirs, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return counts.withColumn("row_count_delta", excess).filter(F.col("row_count_delta") > 0)


def _tagged(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both tables below each other, with one count column per side."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return a.select("*", one.alias("_in_a"), none.alias("_in_b")).unionAll(
        b.select("*", none.alias("_in_a"), one.alias("_in_b")))


def equality(df: DataFrame, other: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows that only one table has, tagged `a_minus_b` or `b_minus_a`.

    One aggregation over both tables; how often a row occurs does not matter.
    """
    columns = columns or df.columns
    picked = [quoted(c) for c in columns]
    sides = _tagged(df.select(*picked), other.select(*picked)).groupBy(*picked).agg(
        F.max("_in_a").alias("_in_a"), F.max("_in_b").alias("_in_b"))
    which = F.when(F.col("_in_a") == 1, "a_minus_b").otherwise("b_minus_a").alias("which_diff")
    return sides.filter(F.col("_in_a") != F.col("_in_b")).select(which, *picked)


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Values that occur a different number of times in the two columns, once per side that has them."""
    a, b = df.select(quoted(column).alias("value_field")), to.select(quoted(field).alias("value_field"))
    sides = _tagged(a, b).groupBy("value_field").agg(F.sum("_in_a").alias("_a"), F.sum("_in_b").alias("_b"))
    counts = F.array(F.struct(F.lit("a_minus_b").alias("d"), F.col("_a").alias("n")),
                     F.struct(F.lit("b_minus_a").alias("d"), F.col("_b").alias("n")))
    rows = sides.filter(F.col("_a") != F.col("_b")).select("value_field", F.explode(counts).alias("_side"))
    return rows.filter(F.col("_side.n") > 0).select(
        "value_field", F.col("_side.n").alias("num_rows"), F.col("_side.d").alias("which_diff"))
