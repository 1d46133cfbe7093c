"""Calendar functions.  Nothing here reads the clock: "today" is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.common import ColumnLike, as_column

DEFAULT_ZONE = "America/Los_Angeles"
EPOCH_READERS = {
    "seconds": F.timestamp_seconds,
    "milliseconds": F.timestamp_millis,
    "microseconds": F.timestamp_micros,
}


def moment(value) -> Column:
    """A literal for a Python date or time or ISO text; Columns and column names pass through."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (dt.date, dt.datetime)):
        return F.lit(value)
    return as_column(value)


def day(value) -> Column:
    """A date from a Column, a Python date or ISO text such as '2024-01-31'."""
    if isinstance(value, (Column, dt.date, dt.datetime)):
        return moment(value).cast("date")
    return F.lit(value).cast("date")


# -- zones and epochs ---------------------------------------------------------------------------

def convert_timezone(value: ColumnLike, target: str = DEFAULT_ZONE, source: str = "UTC") -> Column:
    """Wall-clock time in `target` of a wall-clock time in `source`.

    Text may carry an offset; it is then taken as that moment, and a timestamp with a zone as its time in
    UTC.  The session's zone plays no part.
    """
    return F.convert_timezone(F.lit(source), F.lit(target), _utc_clock(as_column(value)))


def _utc_clock(value: Column) -> Column:
    """Wall-clock time in UTC; text and times without a zone are read as UTC."""
    text = value.cast("string")
    has_zone = text.rlike(r"(Z|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+/[A-Za-z_]+|UTC|GMT)$") & text.contains(":")
    is_moment = F.typeof(value) == "timestamp"
    moment = F.when(is_moment, value.cast("timestamp")).when(
        has_zone, F.when(~is_moment, text).cast("timestamp")).otherwise(
        F.when(~is_moment, F.concat(F.when(text.contains(":"), text).otherwise(F.concat(text, F.lit(" 00:00:00"))), F.lit("+00:00"))).cast("timestamp"))
    seconds = (F.unix_micros(moment).cast("decimal(20,0)") / 1000000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def local_date(value: ColumnLike, zone: str = DEFAULT_ZONE) -> Column:
    """Date in `zone` of a UTC time or of UTC time text."""
    return convert_timezone(value, zone).cast("date")


def from_epoch(value: ColumnLike, unit: str = "seconds") -> Column:
    """Timestamp of an epoch number.  Whole numbers that arrive as floats or text are accepted;
    text that is no number gives NULL.
    """
    if unit not in EPOCH_READERS:
        raise ValueError(f"unit must be one of {sorted(EPOCH_READERS)}, not {unit!r}")
    return EPOCH_READERS[unit](as_column(value).try_cast("decimal(38,6)").cast("bigint"))


def to_epoch(value: ColumnLike) -> Column:
    return F.unix_timestamp(as_column(value).cast("timestamp"))


# -- parts of a date ----------------------------------------------------------------------------

def date_part(part: str, value: ColumnLike) -> Column:
    return F.date_part(F.lit(part), as_column(value))


def day_of_month(value: ColumnLike) -> Column:
    return F.dayofmonth(as_column(value))


def day_of_year(value: ColumnLike) -> Column:
    return F.dayofyear(as_column(value))


def day_of_week(value: ColumnLike, iso: bool = True) -> Column:
    """1..7, from Monday (iso) or from Sunday."""
    return F.weekday(as_column(value)) + 1 if iso else F.dayofweek(as_column(value))


def day_name(value: ColumnLike, short: bool = True) -> Column:
    return F.date_format(as_column(value), "EEE" if short else "EEEE")


def month_name(value: ColumnLike, short: bool = True) -> Column:
    return F.date_format(as_column(value), "LLL" if short else "LLLL")


def month_key(value: ColumnLike) -> Column:
    """`YYYY-MM`."""
    return F.date_format(as_column(value), "yyyy-MM")


def week_of_year(value: ColumnLike) -> Column:
    """Week number with Sunday as first day; days before the first Sunday are week 0."""
    column = as_column(value)
    return F.floor((F.dayofyear(column) + 7 - F.dayofweek(column)) / 7).cast("int")


def iso_week_of_year(value: ColumnLike) -> Column:
    return F.weekofyear(as_column(value))


# -- first and last days ------------------------------------------------------------------------

def week_start(value: ColumnLike) -> Column:
    """The Sunday on or before the day."""
    date = as_column(value).cast("date")
    return F.date_sub(date, F.dayofweek(date) - 1)


def week_end(value: ColumnLike) -> Column:
    return F.date_add(week_start(value), 6)


def iso_week_start(value: ColumnLike) -> Column:
    """The Monday on or before the day."""
    date = as_column(value).cast("date")
    return F.date_sub(date, F.weekday(date))


def iso_week_end(value: ColumnLike) -> Column:
    return F.date_add(iso_week_start(value), 6)


def month_start(value: ColumnLike) -> Column:
    return F.trunc(as_column(value).cast("date"), "month")


def month_end(value: ColumnLike) -> Column:
    return F.last_day(as_column(value).cast("date"))


def quarter_start(value: ColumnLike) -> Column:
    return F.trunc(as_column(value).cast("date"), "quarter")


def quarter_end(value: ColumnLike) -> Column:
    return F.last_day(F.add_months(quarter_start(value), 2))


def year_start(value: ColumnLike) -> Column:
    return F.trunc(as_column(value).cast("date"), "year")


def year_end(value: ColumnLike) -> Column:
    return F.last_day(F.add_months(year_start(value), 11))


def round_to_day(value: ColumnLike) -> Column:
    """Nearest midnight."""
    return F.date_trunc("day", as_column(value) + F.expr("INTERVAL 12 HOURS"))


# -- relative to a given day --------------------------------------------------------------------

def now(as_of, zone: str = DEFAULT_ZONE) -> Column:
    """The given UTC moment as wall-clock time in `zone`."""
    return convert_timezone(moment(as_of) if not isinstance(as_of, str) else F.lit(as_of), zone)


def today(as_of, zone: str = DEFAULT_ZONE) -> Column:
    return now(as_of, zone).cast("date")


def days_ago(n: int, as_of) -> Column:
    return F.date_sub(day(as_of), int(n))


def days_away(n: int, as_of) -> Column:
    return F.date_add(day(as_of), int(n))


def yesterday(as_of) -> Column:
    return days_ago(1, as_of)


def tomorrow(as_of) -> Column:
    return days_away(1, as_of)


def weeks_ago(n: int, as_of) -> Column:
    """Start of the Sunday week n weeks before."""
    return week_start(days_ago(7 * int(n), as_of))


def weeks_away(n: int, as_of) -> Column:
    return weeks_ago(-int(n), as_of)


def months_ago(n: int, as_of) -> Column:
    """First day of the month n months before."""
    return F.trunc(F.add_months(day(as_of), -int(n)), "month")


def months_away(n: int, as_of) -> Column:
    return months_ago(-int(n), as_of)


def last_week(as_of) -> Column:
    return weeks_ago(1, as_of)


def next_week(as_of) -> Column:
    return weeks_away(1, as_of)


def last_month(as_of) -> Column:
    return months_ago(1, as_of)


def next_month(as_of) -> Column:
    return months_away(1, as_of)


def last_month_name(as_of, short: bool = True) -> Column:
    return month_name(last_month(as_of), short)


def next_month_name(as_of, short: bool = True) -> Column:
    return month_name(next_month(as_of), short)


def last_month_number(as_of) -> Column:
    return F.month(last_month(as_of))


def next_month_number(as_of) -> Column:
    return F.month(next_month(as_of))


def within_days(value: ColumnLike, n: int, as_of) -> Column:
    """True for days from n days before `as_of` on."""
    return as_column(value).cast("date") >= days_ago(n, as_of)


def boundaries_between(part: str, first, second) -> Column:
    """How many starts of `part` lie after `first` and up to `second` (negative if reversed).

    31 January to 1 February is one month: boundaries are counted, not full periods.
    """
    a, b = moment(first), moment(second)
    if part == "year":
        return F.year(b) - F.year(a)
    if part == "quarter":
        return (F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)
    if part == "month":
        return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    if part == "day":
        return F.datediff(b, a)
    if part in ("week", "isoweek"):
        start = week_start if part == "week" else iso_week_start
        return F.floor(F.datediff(start(b), start(a)) / 7).cast("int")
    seconds = {"hour": 3600, "minute": 60, "second": 1}
    if part not in seconds:
        raise ValueError(f"cannot count {part!r} boundaries")
    size = F.lit(seconds[part])
    return F.floor(to_epoch(b) / size) - F.floor(to_epoch(a) / size)


def periods_since(value: ColumnLike, as_of, part: str = "day") -> Column:
    return boundaries_between(part, as_column(value), as_of)
