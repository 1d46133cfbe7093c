"""Calendar functions, spines, the date dimension and the fiscal calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import query
from tidemark.functions import calendar as cal
from tidemark.operators import spines

AS_OF = "2001-08-01"


@query("""
SELECT o_orderkey, CAST(date_part('month', d) AS BIGINT) AS part_month,
       CAST(date_part('quarter', d) AS BIGINT) AS part_quarter, CAST(date_part('year', d) AS BIGINT) AS part_year,
       strftime(d, '%a') AS day_short, strftime(d, '%A') AS day_long, CAST(day(d) AS BIGINT) AS day_of_month,
       CAST(isodow(d) AS BIGINT) AS dow_iso, CAST(dayofweek(d) + 1 AS BIGINT) AS dow_sunday,
       CAST(dayofyear(d) AS BIGINT) AS day_of_year, strftime(d, '%b') AS month_short, strftime(d, '%B') AS month_long,
       strftime(d, '%Y-%m') AS month_key, CAST(strftime(d, '%U') AS BIGINT) AS week_of_year,
       CAST(weekofyear(d) AS BIGINT) AS iso_week
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_parts(t):
    d = F.col("o_orderdate")

    def big(column):
        return column.cast("bigint")

    return t.orders.select(
        "o_orderkey", big(cal.date_part("month", d)).alias("part_month"),
        big(cal.date_part("quarter", d)).alias("part_quarter"), big(cal.date_part("year", d)).alias("part_year"),
        cal.day_name(d).alias("day_short"), cal.day_name(d, short=False).alias("day_long"),
        big(cal.day_of_month(d)).alias("day_of_month"), big(cal.day_of_week(d)).alias("dow_iso"),
        big(cal.day_of_week(d, iso=False)).alias("dow_sunday"), big(cal.day_of_year(d)).alias("day_of_year"),
        cal.month_name(d).alias("month_short"), cal.month_name(d, short=False).alias("month_long"),
        cal.month_key(d).alias("month_key"), big(cal.week_of_year(d)).alias("week_of_year"),
        big(cal.iso_week_of_year(d)).alias("iso_week"))


@query("""
SELECT o_orderkey, CAST(d - CAST(dayofweek(d) AS INTEGER) AS VARCHAR) AS week_start,
       CAST(d - CAST(dayofweek(d) AS INTEGER) + 6 AS VARCHAR) AS week_end,
       CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS iso_week_start,
       CAST(CAST(date_trunc('week', d) AS DATE) + 6 AS VARCHAR) AS iso_week_end,
       CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start, CAST(last_day(d) AS VARCHAR) AS month_end,
       CAST(CAST(date_trunc('quarter', d) AS DATE) AS VARCHAR) AS quarter_start,
       CAST(CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS quarter_end,
       CAST(CAST(date_trunc('year', d) AS DATE) AS VARCHAR) AS year_start,
       CAST(CAST(date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS year_end
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_edges(t):
    edges = ["week_start", "week_end", "iso_week_start", "iso_week_end", "month_start", "month_end", "quarter_start",
             "quarter_end", "year_start", "year_end"]
    return t.orders.select("o_orderkey", *[getattr(cal, e)("o_orderdate").alias(e) for e in edges])


@query("""
SELECT o_orderkey, CAST(d - 1 AS VARCHAR) AS yesterday, CAST(d + 1 AS VARCHAR) AS tomorrow,
       CAST(d - 45 AS VARCHAR) AS days_ago, CAST(d + 45 AS VARCHAR) AS days_away,
       CAST((d - 7) - CAST(dayofweek(d) AS INTEGER) AS VARCHAR) AS last_week,
       CAST((d + 7) - CAST(dayofweek(d) AS INTEGER) AS VARCHAR) AS next_week,
       CAST((d - 21) - CAST(dayofweek(d) AS INTEGER) AS VARCHAR) AS weeks_ago,
       CAST((d + 21) - CAST(dayofweek(d) AS INTEGER) AS VARCHAR) AS weeks_away,
       CAST(CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS last_month,
       CAST(CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_month,
       CAST(CAST(date_trunc('month', d) - INTERVAL 5 MONTH AS DATE) AS VARCHAR) AS months_ago,
       CAST(CAST(date_trunc('month', d) + INTERVAL 5 MONTH AS DATE) AS VARCHAR) AS months_away,
       strftime(date_trunc('month', d) - INTERVAL 1 MONTH, '%b') AS last_month_name,
       strftime(date_trunc('month', d) + INTERVAL 1 MONTH, '%B') AS next_month_name,
       CAST(month(date_trunc('month', d) - INTERVAL 1 MONTH) AS BIGINT) AS last_month_number,
       CAST(month(date_trunc('month', d) + INTERVAL 1 MONTH) AS BIGINT) AS next_month_number
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_neighbours(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", cal.yesterday(d).alias("yesterday"), cal.tomorrow(d).alias("tomorrow"),
        cal.days_ago(45, d).alias("days_ago"), cal.days_away(45, d).alias("days_away"),
        cal.last_week(d).alias("last_week"), cal.next_week(d).alias("next_week"),
        cal.weeks_ago(3, d).alias("weeks_ago"), cal.weeks_away(3, d).alias("weeks_away"),
        cal.last_month(d).alias("last_month"), cal.next_month(d).alias("next_month"),
        cal.months_ago(5, d).alias("months_ago"), cal.months_away(5, d).alias("months_away"),
        cal.last_month_name(d).alias("last_month_name"), cal.next_month_name(d, short=False).alias("next_month_name"),
        cal.last_month_number(d).cast("bigint").alias("last_month_number"),
        cal.next_month_number(d).cast("bigint").alias("next_month_number"))


@query("""
SELECT event_id, date_diff('year', ts, n) AS years, date_diff('quarter', ts, n) AS quarters,
       date_diff('month', ts, n) AS months,
       CAST(((CAST(n AS DATE) - CAST(dayofweek(n) AS INTEGER)) - (CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER))) / 7 AS BIGINT) AS weeks,
       CAST((CAST(date_trunc('week', n) AS DATE) - CAST(date_trunc('week', ts) AS DATE)) / 7 AS BIGINT) AS iso_weeks, date_diff('day', ts, n) AS days, date_diff('hour', ts, n) AS hours,
       date_diff('minute', ts, n) AS minutes, date_diff('second', ts, n) AS seconds,
       CAST(ts AS DATE) >= DATE '2024-01-21' AS in_last_ten
FROM (SELECT *, TIMESTAMP '2024-01-31 12:00:00' AS n FROM events)""")
def periods_since(t):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    names = {"year": "years", "quarter": "quarters", "month": "months", "week": "weeks", "isoweek": "iso_weeks",
             "day": "days", "hour": "hours", "minute": "minutes", "second": "seconds"}
    return t.events.select("event_id", *[cal.periods_since("ts", now, part).cast("bigint").alias(name)
                                         for part, name in names.items()],
                           cal.within_days("ts", 10, "2024-01-31").alias("in_last_ten"))


@query("""
WITH z AS (SELECT event_id, ts, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS la,
                  (ts AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'Asia/Tokyo' AS tokyo FROM events)
SELECT event_id, strftime(la, '%Y-%m-%d %H:%M:%S') AS la, strftime(tokyo, '%Y-%m-%d %H:%M:%S') AS tokyo,
       CAST(CAST(la AS DATE) AS VARCHAR) AS la_day, CAST(CAST(la AS DATE) AS VARCHAR) AS la_today,
       strftime(date_trunc('day', ts + INTERVAL 12 HOUR), '%Y-%m-%d %H:%M:%S') AS rounded
FROM z""")
def zones_and_rounding(t):
    return t.events.select(
        "event_id", cal.convert_timezone("ts").alias("la"),
        cal.convert_timezone("ts", "Asia/Tokyo", "Europe/Berlin").alias("tokyo"),
        cal.local_date("ts").alias("la_day"), cal.today(F.col("ts")).alias("la_today"),
        cal.round_to_day("ts").alias("rounded"))


def _order_days(t):
    """Bounds of the order dates as scalar subqueries: first day and the day after the last."""
    day = F.col("o_orderdate").cast("date")
    return t.orders.agg(F.min(day)).scalar(), t.orders.agg(F.date_add(F.max(day), 1)).scalar()


@query("""
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
x AS (SELECT d, CAST(d - INTERVAL 1 YEAR AS DATE) AS py, d - 364 AS pw FROM d),
n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT CAST(x.d AS VARCHAR) AS date_day, CAST(x.d - 1 AS VARCHAR) AS prior_date_day, CAST(x.d + 1 AS VARCHAR) AS next_date_day,
  CAST(py AS VARCHAR) AS prior_year_date_day, CAST(pw AS VARCHAR) AS prior_year_over_year_date_day,
  CAST(dayofweek(x.d) + 1 AS BIGINT) AS day_of_week, CAST(isodow(x.d) AS BIGINT) AS day_of_week_iso,
  strftime(x.d, '%A') AS day_of_week_name, strftime(x.d, '%a') AS day_of_week_name_short,
  CAST(day(x.d) AS BIGINT) AS day_of_month, CAST(dayofyear(x.d) AS BIGINT) AS day_of_year,
  CAST(x.d - CAST(dayofweek(x.d) AS INTEGER) AS VARCHAR) AS week_start_date,
  CAST(x.d - CAST(dayofweek(x.d) AS INTEGER) + 6 AS VARCHAR) AS week_end_date,
  CAST(pw - CAST(dayofweek(pw) AS INTEGER) AS VARCHAR) AS prior_year_week_start_date,
  CAST(pw - CAST(dayofweek(pw) AS INTEGER) + 6 AS VARCHAR) AS prior_year_week_end_date,
  CAST(strftime(x.d, '%U') AS BIGINT) AS week_of_year,
  CAST(CAST(date_trunc('week', x.d) AS DATE) AS VARCHAR) AS iso_week_start_date,
  CAST(CAST(date_trunc('week', x.d) AS DATE) + 6 AS VARCHAR) AS iso_week_end_date,
  CAST(CAST(date_trunc('week', pw) AS DATE) AS VARCHAR) AS prior_year_iso_week_start_date,
  CAST(CAST(date_trunc('week', pw) AS DATE) + 6 AS VARCHAR) AS prior_year_iso_week_end_date,
  CAST(weekofyear(x.d) AS BIGINT) AS iso_week_of_year, CAST(strftime(pw, '%U') AS BIGINT) AS prior_year_week_of_year,
  CAST(weekofyear(pw) AS BIGINT) AS prior_year_iso_week_of_year, CAST(month(x.d) AS BIGINT) AS month_of_year,
  strftime(x.d, '%B') AS month_name, strftime(x.d, '%b') AS month_name_short,
  CAST(CAST(date_trunc('month', x.d) AS DATE) AS VARCHAR) AS month_start_date, CAST(last_day(x.d) AS VARCHAR) AS month_end_date,
  CAST(CAST(date_trunc('month', py) AS DATE) AS VARCHAR) AS prior_year_month_start_date,
  CAST(last_day(py) AS VARCHAR) AS prior_year_month_end_date, CAST(quarter(x.d) AS BIGINT) AS quarter_of_year,
  CAST(CAST(date_trunc('quarter', x.d) AS DATE) AS VARCHAR) AS quarter_start_date,
  CAST(CAST(date_trunc('quarter', x.d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS quarter_end_date,
  CAST(year(x.d) AS BIGINT) AS year_number, CAST(CAST(date_trunc('year', x.d) AS DATE) AS VARCHAR) AS year_start_date,
  CAST(CAST(date_trunc('year', x.d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS year_end_date,
  coalesce(n_orders, 0) AS n_orders
FROM x LEFT JOIN n ON x.d = n.d""")
def date_dimension(t):
    first, end = _order_days(t)
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(F.count(F.lit(1)).alias("_n"))
    full = spines.date_dimension(t.spark, first, end).join(daily, "date_day", "left")
    wide = full.withColumn("n_orders", F.coalesce("_n", F.lit(0))).drop("_n")
    return wide.select(*[F.col(f.name).cast("bigint").alias(f.name) if f.dataType.typeName() == "integer"
                         else F.col(f.name) for f in wide.schema.fields])


#: A fiscal year ends on the Saturday closest to the end of January, which is the one from 28 January to 3 February.  Its weeks are
#: numbered, and their place in the 4-5-4 calendar is looked up in a table of the twelve periods.
FISCAL_SQL = """
WITH known AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
closing AS (SELECT y - 1 AS fy, make_date(y, 1, 28) + CAST(6 - dayofweek(make_date(y, 1, 28)) AS INTEGER) AS fe
            FROM known, unnest(generate_series(year(lo), year(hi))) g(y)),
weeks AS (SELECT this.fy, before.fe + 1 AS fs, this.fe, CAST(wk AS BIGINT) AS wk, before.fe + 1 + CAST(7 * (wk - 1) AS INTEGER) AS ws
          FROM known, closing this JOIN closing before ON before.fy = this.fy - 1, unnest(generate_series(1, 53)) g(wk)
          WHERE before.fe - 6 >= lo AND this.fe - 6 <= hi AND before.fe + CAST(7 * (wk - 1) AS INTEGER) < this.fe),
period(number, first, last) AS (VALUES (1, 1, 4), (2, 5, 9), (3, 10, 13), (4, 14, 17), (5, 18, 22), (6, 23, 26),
                                       (7, 27, 30), (8, 31, 35), (9, 36, 39), (10, 40, 43), (11, 44, 48), (12, 49, 53)),
days AS (SELECT ws + CAST(i AS INTEGER) AS d, fy, fs, fe, wk, ws, ws + 6 AS we, number, first
         FROM known, weeks JOIN period ON wk BETWEEN first AND last, unnest(generate_series(0, 6)) g(i) WHERE ws + CAST(i AS INTEGER) <= hi),
n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders FROM orders GROUP BY 1)
"""


def _fiscal_input(t):
    first, end = _order_days(t)
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    return spines.date_dimension(t.spark, first, end), daily


@query(FISCAL_SQL + """
SELECT fy AS fiscal_year_number, CAST(fs AS VARCHAR) AS fiscal_year_start_date, CAST(fe AS VARCHAR) AS fiscal_year_end_date,
       CAST(ws AS VARCHAR) AS week_start_date, CAST(we AS VARCHAR) AS week_end_date, wk AS fiscal_week_of_year,
       CAST(coalesce(sum(n_orders), 0) AS BIGINT) AS n_orders
FROM days LEFT JOIN n ON days.d = n.d GROUP BY fy, fs, fe, ws, we, wk""")
def fiscal_years(t):
    dates, daily = _fiscal_input(t)
    days = spines.fiscal_year_dates(dates, 1, 1, 1).join(daily, "date_day", "left")
    keys = ["fiscal_year_number", "fiscal_year_start_date", "fiscal_year_end_date", "week_start_date", "week_end_date",
            "fiscal_week_of_year"]
    return days.groupBy(*keys).agg(F.coalesce(F.sum("n_orders"), F.lit(0)).alias("n_orders"))


@query(FISCAL_SQL + """
SELECT CAST(days.d AS VARCHAR) AS date_day, fy AS fiscal_year_number, CAST(ws AS VARCHAR) AS week_start_date, CAST(we AS VARCHAR) AS week_end_date,
       wk AS fiscal_week_of_year, wk - first + 1 AS fiscal_week_of_period, number AS fiscal_period_number, (number + 2) // 3 AS fiscal_quarter_number,
       (number - 1) % 3 + 1 AS fiscal_period_of_quarter, coalesce(n_orders, 0) AS n_orders
FROM days LEFT JOIN n ON days.d = n.d""")
def fiscal_periods(t):
    dates, daily = _fiscal_input(t)
    days = spines.fiscal_periods(dates, 1, 1, 1).join(daily, "date_day", "left")
    return days.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query("""
WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events),
h AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h FROM b),
n AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1)
SELECT strftime(h.h, '%Y-%m-%d %H:%M:%S') AS date_hour, coalesce(n, 0) AS n_events FROM h LEFT JOIN n ON h.h = n.h""")
def date_spine_hours(t):
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    first = t.events.agg(F.min(hour)).scalar()
    end = t.events.agg(F.max(hour) + F.expr("INTERVAL 1 HOUR")).scalar()
    counted = t.events.groupBy(hour.alias("date_hour")).agg(F.count(F.lit(1)).alias("n"))
    return spines.date_spine(t.spark, "hour", first, end).join(counted, "date_hour", "left").select(
        "date_hour", F.coalesce("n", F.lit(0)).alias("n_events"))


@query("""
WITH b AS (SELECT date_trunc('day', min(ts)) AS lo FROM events),
s AS (SELECT unnest(generate_series(lo, lo + INTERVAL 259199 SECOND, INTERVAL 1 SECOND)) AS s FROM b)
SELECT strftime(date_trunc('hour', s), '%Y-%m-%d %H:%M:%S') AS hour, count(*) AS n, strftime(max(s), '%Y-%m-%d %H:%M:%S') AS last FROM s GROUP BY 1""")
def date_spine_seconds(t):
    first = F.date_trunc("day", F.col("ts").cast("timestamp"))
    start, end = t.events.agg(F.min(first)).scalar(), t.events.agg(F.min(first) + F.expr("INTERVAL 3 DAYS")).scalar()
    seconds = spines.date_spine(t.spark, "second", start, end)
    return seconds.groupBy(F.date_trunc("hour", "date_second").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.max("date_second").alias("last"))


@query("""
WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi FROM orders),
m AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM b),
n AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)
SELECT strftime(m.m, '%Y-%m-%d') AS month, coalesce(n, 0) AS n_orders FROM m LEFT JOIN n ON m.m = n.m""")
def month_spine_counts(t):
    month = cal.month_start("o_orderdate")
    counted = t.orders.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("n"))
    bounds = t.orders.agg(F.min(month)).scalar(), t.orders.agg(F.max(month)).scalar()
    return spines.month_spine(t.spark, *bounds).join(counted, "month", "left").select(
        "month", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query("""
WITH s AS (SELECT unnest(generate_series(1, 7)) AS generated_number),
n AS (SELECT l_linenumber, count(*) AS n FROM lineitem GROUP BY 1)
SELECT generated_number, coalesce(n, 0) AS n_lines FROM s LEFT JOIN n ON generated_number = l_linenumber""")
def number_series(t):
    counted = t.lineitem.groupBy(F.col("l_linenumber").cast("bigint").alias("generated_number")).agg(
        F.count(F.lit(1)).alias("n"))
    return spines.generate_series(t.spark, 7).join(counted, "generated_number", "left").select(
        "generated_number", F.coalesce("n", F.lit(0)).alias("n_lines"))


@query("""
WITH d AS (SELECT unnest(generate_series(DATE '2001-08-01' - 60, DATE '2001-08-01', INTERVAL 1 DAY)) AS d),
n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT strftime(d.d, '%Y-%m-%d %H:%M:%S') AS date_day, coalesce(n, 0) AS n_orders FROM d LEFT JOIN n ON d.d = n.d""")
def base_dates_back(t):
    counted = t.orders.groupBy(F.col("o_orderdate").cast("date").cast("timestamp").alias("date_day")).agg(
        F.count(F.lit(1)).alias("n"))
    return spines.base_dates(t.spark, n=60, as_of=AS_OF).join(counted, "date_day", "left").select(
        "date_day", F.coalesce("n", F.lit(0)).alias("n_orders"))
