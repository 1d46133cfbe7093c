"""Null-safe arithmetic, bucketing, surrogate keys, distance and flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.common import ColumnLike, as_column

# The text that stands for NULL in a surrogate key, the radius of the earth in
# miles and the length of a mile in kilometres.  Keys and distances only match with these.
KEY_NULL_MARK = "_dbt_utils_surrogate_key_null_"
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def _zero_if_null(value: ColumnLike) -> Column:
    return F.coalesce(as_column(value), F.lit(0))


def safe_add(*values: ColumnLike) -> Column:
    """Sum in which NULL counts as zero."""
    return reduce(lambda left, right: left + right, map(_zero_if_null, values))


def safe_subtract(*values: ColumnLike) -> Column:
    """First value minus all the others, NULL counting as zero (also in first place)."""
    return reduce(lambda left, right: left - right, map(_zero_if_null, values))


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient, NULL where the denominator is zero or NULL."""
    return as_column(numerator) / F.nullif(as_column(denominator), F.lit(0))


def width_bucket(value: ColumnLike, low: float, high: float, buckets: int, edge_formula: bool = False) -> Column:
    """Number (1..buckets) of the equal-width bucket; 0 below `low`, buckets + 1 from `high` on.

    `edge_formula` computes the bucket as ceiling plus one at multiples of the bucket width.  It
    gives the same numbers while `low` is a multiple of the width and `value` stays below `high`.
    """
    column = as_column(value)
    if not edge_formula:
        return F.width_bucket(column.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(int(buckets)))
    width = (high - low) / buckets
    exact = column.cast("decimal(38,9)")
    on_edge = F.when(exact % F.lit(width).cast("decimal(38,9)") == 0, 1).otherwise(0)
    raised = F.ceil((column - F.lit(low)) / F.lit(width))
    return (on_edge + F.least(raised, F.lit(buckets + 1))).cast("bigint")


def surrogate_key(*values: ColumnLike, nulls_as_empty: bool = False) -> Column:
    """MD5 over the text of the values joined with a dash; NULL gets its own mark."""
    stand_in = F.lit("" if nulls_as_empty else KEY_NULL_MARK)
    return F.md5(F.concat_ws("-", *[F.coalesce(as_column(v).cast("string"), stand_in) for v in values]))


def degrees_to_radians(degrees: ColumnLike) -> Column:
    return F.radians(as_column(degrees))


def haversine(lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike, unit: str = "mi") -> Column:
    """Great-circle distance between two points in degrees, in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    phi1, lam1, phi2, lam2 = map(degrees_to_radians, (lat1, lon1, lat2, lon2))
    half_chord = (
        F.pow(F.sin((phi2 - phi1) / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin((lam2 - lam1) / 2), 2)
    )
    miles = 2 * EARTH_RADIUS_MILES * F.asin(F.sqrt(half_chord))
    return miles * KM_PER_MILE if unit == "km" else miles


def yes_no(condition: Column, yes: str = "yes", no: str = "no") -> Column:
    """Text flag; an unknown condition counts as no."""
    return F.when(condition, yes).otherwise(no)


def null_label(value: ColumnLike, label: str = "null") -> Column:
    """Text in place of NULL, so that missing keys can be joined and grouped."""
    return F.coalesce(as_column(value), F.lit(label))


def rounded_int(value: ColumnLike) -> Column:
    """Whole number nearest to the value, halves away from zero."""
    return F.round(as_column(value)).cast("bigint")


def exact_sum(value: ColumnLike, scale: int = 2) -> Column:
    """Sum of fractional numbers, each rounded to `scale` places, that does not depend on the order of rows.

    Each number becomes a whole number of its smallest unit, halves away from zero.  Numbers of 10^28
    units or more are an error, never a wrong sum.
    """
    units = F.round(as_column(value).cast("double") * 10**scale).cast("decimal(28,0)")
    return (F.sum(units) * F.lit(10.0**-scale).cast(f"decimal({scale + 1},{scale})")).cast(f"decimal(38,{scale})")


def money_sum(value: ColumnLike, scale: int = 2) -> Column:
    """Exact sum of amounts as a double."""
    return exact_sum(value, scale).cast("double")


def from_cents(value: ColumnLike) -> Column:
    return as_column(value) / 100


def sum_if(condition: Column, value: ColumnLike = 1) -> Column:
    """Sum of `value` over rows that meet the condition; false and unknown add zero."""
    chosen = as_column(value) if not isinstance(value, (int, float)) else F.lit(value)
    return F.sum(F.when(condition, chosen).otherwise(F.lit(0)))


def link(prefix: str, value: ColumnLike, suffix: str = "") -> Column:
    """URL around an identifier; NULL for a missing identifier."""
    parts = [F.lit(prefix), as_column(value).cast("string")]
    return F.concat(*parts, F.lit(suffix)) if suffix else F.concat(*parts)


def largest(*values: ColumnLike) -> Column:
    """Greatest value, NULL if any argument is NULL."""
    columns = [as_column(v) for v in values]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in columns])
    return F.when(~any_null, F.greatest(*columns))


def smallest(*values: ColumnLike) -> Column:
    """Least value, NULL if any argument is NULL."""
    columns = [as_column(v) for v in values]
    any_null = reduce(lambda a, b: a | b, [c.isNull() for c in columns])
    return F.when(~any_null, F.least(*columns))


def billing_period(interval: ColumnLike, count: ColumnLike, labels: dict[tuple[str, int | None], str],
                   other: str | None = None) -> Column:
    """Label of a billing interval.  `labels` maps (interval, count) to text; count None means any."""
    unit, times = as_column(interval), as_column(count)
    result: Column | None = None
    for (name, number), label in labels.items():
        hit = (unit == name) if number is None else (unit == name) & (times == number)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    if result is None:
        raise ValueError("no labels given")
    return result.otherwise(F.lit(other))
