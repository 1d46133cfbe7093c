"""Number and date sequences, the date dimension and the 4-5-4 fiscal calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal

SPINE_BLOCK = 100_000
STEPS = {
    "second": "SECOND", "minute": "MINUTE", "hour": "HOUR", "day": "DAY", "week": "WEEK",
    "month": "MONTH", "quarter": "QUARTER", "year": "YEAR",
}


def generate_series(spark: SparkSession, n: int) -> DataFrame:
    """The numbers 1..n."""
    if n <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, n + 1).withColumnRenamed("id", "generated_number")


def _step(part: str, times: str = "1") -> str:
    if part not in STEPS:
        raise ValueError(f"unknown date part {part!r}")
    if part == "quarter":
        return f"make_interval(0, 3 * ({times}))"
    place = ["YEAR", "MONTH", "WEEK", "DAY", "HOUR", "MINUTE", "SECOND"].index(STEPS[part])
    return "make_interval(" + ", ".join("0" if i != place else times for i in range(place + 1)) + ")"


def date_spine(spark: SparkSession, part: str, start, end) -> DataFrame:
    """Moments `start`, `start` + 1 part, ... before `end` (column `date_<part>`).

    `start` and `end` are ISO text, Python dates or Columns such as `df.agg(F.min("d")).scalar()`.
    """
    as_moment = [(v if isinstance(v, Column) else F.lit(str(v))).cast("timestamp") for v in (start, end)]
    bounds = spark.range(1).select(as_moment[0].alias("low"), as_moment[1].alias("high"))
    steps = cal.boundaries_between(part, F.col("low"), F.col("high")).cast("bigint")
    # Long spines are dealt out in blocks, so no task writes out more than a few of them.
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.greatest(F.col("steps") - 1, F.lit(0)) / SPINE_BLOCK), F.lit(1).cast("bigint")))
    blocks = bounds.select("low", "high", steps.alias("steps")).filter("low < high AND steps > 0").select(
        "low", "high", "steps", block.alias("block")).repartition("block")
    first = F.col("block") * SPINE_BLOCK
    numbers = blocks.select("low", "high", F.explode(F.sequence(first, F.greatest(F.least(first + SPINE_BLOCK, F.col("steps")) - 1, first))).alias("n"))
    name = f"date_{part}"
    moments = numbers.select(
        (F.col("low") + F.expr(_step(part, "cast(n as int)"))).alias(name), "high")
    return moments.filter(F.col(name) <= F.col("high")).select(name)


def month_spine(spark: SparkSession, start, end) -> DataFrame:
    """First days `start`, + 1 month, ... up to and including `end` (column `month`)."""
    first, last = [(v if isinstance(v, Column) else F.lit(str(v))).cast("date") for v in (start, end)]
    return spark.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("month"))


def month_starts(spark: SparkSession, as_of, months_back: int) -> DataFrame:
    """First days of all months from `months_back` months before `as_of` to that of `as_of`."""
    return month_spine(spark, cal.months_ago(months_back, as_of), cal.months_ago(0, as_of))


def months_list(first_year: int, first_month: int, last_year: int, last_month: int) -> list[str]:
    """`YYYY-MM` from the first to the last month, both included."""
    low, high = first_year * 12 + first_month - 1, last_year * 12 + last_month - 1
    return [f"{m // 12}-{m % 12 + 1:02d}" for m in range(low, high + 1)]


def base_dates(spark: SparkSession, start=None, end=None, *, n: int | None = None, part: str = "day",
               as_of=None) -> DataFrame:
    """Date spine between two days, or over the last n parts up to tomorrow (exclusive)."""
    if start is not None and end is not None:
        return date_spine(spark, part, start, end)
    if n is None or as_of is None:
        raise ValueError("give start and end, or n and as_of")
    today = cal.day(as_of)
    back = today.cast("timestamp") - F.expr(_step(part, str(int(n))))
    return date_spine(spark, part, back, F.date_add(today, 1))


def date_dimension(spark: SparkSession, start, end) -> DataFrame:
    """One row per day from `start` to the day before `end`, with its calendar attributes."""
    days = date_spine(spark, "day", start, end).select(F.col("date_day").cast("date").alias("date_day"))
    year_ago, weeks_ago = F.add_months("date_day", -12), F.date_sub("date_day", 364)
    day = F.col("date_day")
    return days.select(
        day,
        cal.yesterday(day).alias("prior_date_day"),
        cal.tomorrow(day).alias("next_date_day"),
        year_ago.alias("prior_year_date_day"),
        weeks_ago.alias("prior_year_over_year_date_day"),
        cal.day_of_week(day, iso=False).alias("day_of_week"),
        cal.day_of_week(day, iso=True).alias("day_of_week_iso"),
        cal.day_name(day, short=False).alias("day_of_week_name"),
        cal.day_name(day, short=True).alias("day_of_week_name_short"),
        cal.day_of_month(day).alias("day_of_month"),
        cal.day_of_year(day).alias("day_of_year"),
        cal.week_start(day).alias("week_start_date"),
        cal.week_end(day).alias("week_end_date"),
        cal.week_start(weeks_ago).alias("prior_year_week_start_date"),
        cal.week_end(weeks_ago).alias("prior_year_week_end_date"),
        cal.week_of_year(day).alias("week_of_year"),
        cal.iso_week_start(day).alias("iso_week_start_date"),
        cal.iso_week_end(day).alias("iso_week_end_date"),
        cal.iso_week_start(weeks_ago).alias("prior_year_iso_week_start_date"),
        cal.iso_week_end(weeks_ago).alias("prior_year_iso_week_end_date"),
        cal.iso_week_of_year(day).alias("iso_week_of_year"),
        cal.week_of_year(weeks_ago).alias("prior_year_week_of_year"),
        cal.iso_week_of_year(weeks_ago).alias("prior_year_iso_week_of_year"),
        F.month(day).alias("month_of_year"),
        cal.month_name(day, short=False).alias("month_name"),
        cal.month_name(day, short=True).alias("month_name_short"),
        cal.month_start(day).alias("month_start_date"),
        cal.month_end(day).alias("month_end_date"),
        cal.month_start(year_ago).alias("prior_year_month_start_date"),
        cal.month_end(year_ago).alias("prior_year_month_end_date"),
        F.quarter(day).alias("quarter_of_year"),
        cal.quarter_start(day).alias("quarter_start_date"),
        cal.quarter_end(day).alias("quarter_end_date"),
        F.year(day).alias("year_number"),
        cal.year_start(day).alias("year_start_date"),
        cal.year_end(day).alias("year_end_date"),
    )


def fiscal_year_dates(dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1,
                      shift_year: int = 1) -> DataFrame:
    """Days with their fiscal year, which ends with the week whose end is closest to a month end.

    `dates` is a date dimension; `week_start_day` counts from Sunday = 1.  The first fiscal year
    that ends in the dimension has no known start and is left out.
    """
    opening = dates.filter((F.col("day_of_week") == week_start_day) & (F.col("month_of_year") == year_end_month))
    closing = F.date_add("date_day", 6)
    year_ends = opening.groupBy((F.col("year_number") - shift_year).alias("fiscal_year_number")).agg(
        F.min_by(closing, F.abs(F.datediff(F.col("month_end_date"), closing))).alias("fiscal_year_end_date"))
    by_end = Window.orderBy("fiscal_year_end_date")  # one row per calendar year
    years = year_ends.select(
        "fiscal_year_number",
        F.date_add(F.lag("fiscal_year_end_date").over(by_end), 1).alias("fiscal_year_start_date"),
        "fiscal_year_end_date",
    ).filter(F.col("fiscal_year_start_date").isNotNull())
    spelled_out = years.select("*", F.explode(
        F.sequence(F.col("fiscal_year_start_date"), F.col("fiscal_year_end_date"))).alias("date_day"))
    back = F.pmod(F.col("day_of_week") - week_start_day, F.lit(7))
    placed = dates.select("date_day", "day_of_week").join(spelled_out, "date_day").select(
        "date_day", "fiscal_year_number", "fiscal_year_start_date", "fiscal_year_end_date",
        F.date_sub("date_day", back.cast("int")).alias("week_start_date"))
    in_year = Window.partitionBy("fiscal_year_number").orderBy("week_start_date")  # at most 371 days
    return placed.select(
        "*",
        F.date_add("week_start_date", 6).alias("week_end_date"),
        F.dense_rank().over(in_year).alias("fiscal_week_of_year"),
    )


def fiscal_periods(dates: DataFrame, year_end_month: int, week_start_day: int, shift_year: int = 1) -> DataFrame:
    """Days with their place in a 4-5-4 calendar: quarters of 13 weeks, week 53 in the last period.

    The week of the period is ranked per period number over all years.
    """
    days = fiscal_year_dates(dates, year_end_month, week_start_day, shift_year)
    week = F.col("fiscal_week_of_year")
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    in_quarter = (week - 1) % 13
    period = F.when(week == 53, 3).when(in_quarter < 4, 1).when(in_quarter < 9, 2).otherwise(3)
    placed = days.select("*", (quarter * 3 + period).alias("fiscal_period_number"),
                         (quarter + 1).alias("fiscal_quarter_number"), period.alias("fiscal_period_of_quarter"))
    weeks = Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")
    return placed.select(
        "date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
        F.dense_rank().over(weeks).alias("fiscal_week_of_period"),
        "fiscal_period_number", "fiscal_quarter_number", "fiscal_period_of_quarter")
