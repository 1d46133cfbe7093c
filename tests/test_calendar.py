"""Calendar functions and spines on the published example days."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.operators import spines

D = dt.date


def on(spark, day, *columns):
    return list(spark.createDataFrame([(day,)], "d date").select(*columns).first())


@pytest.mark.parametrize("day,expected", [
    (D(2020, 11, 29), [D(2020, 11, 28), D(2020, 11, 30), "Sunday", "Sun", 29, 1, 7, 334, D(2020, 11, 29), D(2020, 12, 5), 48,
                       D(2020, 11, 23), D(2020, 11, 29), 48, 11, "November", "Nov"]),
    (D(2020, 12, 1), [D(2020, 11, 30), D(2020, 12, 2), "Tuesday", "Tue", 1, 3, 2, 336, D(2020, 11, 29), D(2020, 12, 5), 48,
                      D(2020, 11, 30), D(2020, 12, 6), 49, 12, "December", "Dec"]),
])
def test_published_days(spark, day, expected):
    d = F.col("d")
    assert on(spark, day, cal.yesterday(d), cal.tomorrow(d), cal.day_name(d, False), cal.day_name(d), cal.day_of_month(d),
              cal.day_of_week(d, iso=False), cal.day_of_week(d), cal.day_of_year(d), cal.week_start(d), cal.week_end(d),
              cal.week_of_year(d), cal.iso_week_start(d), cal.iso_week_end(d), cal.iso_week_of_year(d),
              cal.date_part("month", d), cal.month_name(d, False), cal.month_name(d)) == expected


def test_epochs_and_rounding(spark):
    moment = cal.from_epoch(F.lit(1623076520))
    local = cal.convert_timezone(moment)
    found = on(spark, D(2020, 1, 1), F.date_format(moment, "yyyy-MM-dd HH:mm:ss"), F.date_format(local, "yyyy-MM-dd HH:mm:ss"),
               cal.to_epoch(moment), cal.round_to_day(moment).cast("date"), cal.round_to_day(local).cast("date"))
    assert found == ["2021-06-07 14:35:20", "2021-06-07 07:35:20", 1623076520, D(2021, 6, 8), D(2021, 6, 7)]
    with pytest.raises(ValueError):
        cal.from_epoch(F.lit(1), "fortnights")


def test_local_date_of_text(spark):
    texts = ["2024-01-01T07:59:00.000+0000", "2024-01-01T08:00:00Z", "2024-01-01T09:59:00+02:00", "2024-01-01 07:00:00"]
    assert on(spark, D(2024, 1, 1), *[cal.local_date(F.lit(x)) for x in texts]) == [
        D(2023, 12, 31), D(2024, 1, 1), D(2023, 12, 31), D(2023, 12, 31)]


def test_relative_days(spark):
    as_of = "2024-03-31"
    assert on(spark, D(2024, 1, 1), cal.last_month(as_of), cal.next_month(as_of), cal.months_ago(13, as_of), cal.last_week(as_of),
              cal.next_week(as_of), cal.last_month_name(as_of), cal.next_month_number(as_of)) == [
        D(2024, 2, 1), D(2024, 4, 1), D(2023, 2, 1), D(2024, 3, 24), D(2024, 4, 7), "Feb", 4]


def test_boundaries_are_counted_not_periods(spark):
    a, b = F.lit("2024-01-31").cast("date"), F.lit("2024-02-01").cast("date")
    assert on(spark, D(2024, 1, 1), *[cal.boundaries_between(p, a, b) for p in ("day", "month", "quarter", "year")]) == [1, 1, 0, 0]
    late, early = F.lit("2023-12-31 23:59:59").cast("timestamp"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert on(spark, D(2024, 1, 1), *[cal.boundaries_between(p, late, early) for p in ("year", "hour", "minute", "second", "week")]) == [1, 1, 1, 1, 0]


def test_week_zero_before_the_first_sunday(spark):
    assert on(spark, D(2020, 1, 4), cal.week_of_year("d")) == [0]
    assert on(spark, D(2020, 1, 5), cal.week_of_year("d")) == [1]


def test_series_and_spines(spark):
    assert [r[0] for r in spines.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        spines.generate_series(spark, 0)
    days = [r[0].date() for r in spines.date_spine(spark, "day", "2018-01-01", "2018-01-10").collect()]
    assert days == [D(2018, 1, n) for n in range(1, 10)]
    assert spines.date_spine(spark, "day", "2018-01-10", "2018-01-10").count() == 0
    quarters = [r[0].date() for r in spines.date_spine(spark, "quarter", "2020-01-01", "2021-01-01").collect()]
    assert quarters == [D(2020, m, 1) for m in (1, 4, 7, 10)]
    months = [r[0] for r in spines.month_spine(spark, "2024-01-01", "2024-03-01").collect()]
    assert months == [D(2024, m, 1) for m in (1, 2, 3)]
    assert spines.months_list(2022, 11, 2023, 2) == ["2022-11", "2022-12", "2023-01", "2023-02"]
    assert spines.base_dates(spark, n=28, part="day", as_of="2024-01-31").count() == 29
    assert spines.base_dates(spark, n=52, part="week", as_of="2024-01-31").count() == 52


def test_date_dimension_and_fiscal_calendar(spark):
    dates = spines.date_dimension(spark, "2015-01-01", "2022-12-31").cache()
    assert dates.count() == 2921 and len(dates.columns) == 36
    fiscal = spines.fiscal_periods(dates, 1, 1, 1).cache()
    years = {r["fiscal_year_number"]: r["n"] for r in fiscal.groupBy("fiscal_year_number").agg(F.count_distinct("week_start_date").alias("n")).collect()}
    assert set(years.values()) <= {52, 53} and 53 in years.values()
    assert fiscal.filter("fiscal_week_of_year = 53 and fiscal_period_of_quarter <> 3").count() == 0
    per_quarter = fiscal.filter("fiscal_year_number = 2018").groupBy("fiscal_quarter_number", "fiscal_period_of_quarter").agg(
        F.count_distinct("week_start_date").alias("n")).collect()
    assert {(r[1], r[2]) for r in per_quarter} == {(1, 4), (2, 5), (3, 4)}


def test_epochs_out_of_text(spark):
    df = spark.createDataFrame([("1700000000",), ("1700000000.0",), ("no",), (None,)], "e string")
    found = [r[0] for r in df.select(cal.to_epoch(cal.from_epoch("e"))).collect()]
    assert found == [1700000000, 1700000000, None, None]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_zones_do_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("""SELECT timestamp_micros(1704074400000000) AS moment, timestamp_ntz'2024-01-01 02:00:00' AS clock, '2024-01-01 02:00:00' AS text,
                                 '2024-01-01T02:00:00Z' AS zulu, '2024-01-01T11:00:00+09:00' AS offset, '2024-01-01' AS day""")
        row = df.select(*[cal.convert_timezone(c, "America/Los_Angeles").cast("string").alias(c) for c in df.columns],
                        cal.local_date("clock").cast("string").alias("date")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [row[c] for c in ("moment", "clock", "text", "zulu", "offset")] == ["2023-12-31 18:00:00"] * 5
    assert row["day"] == "2023-12-31 16:00:00" and row["date"] == "2023-12-31"
