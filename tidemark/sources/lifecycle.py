"""Raw, snapshot and history tables, and the reading of their daily versions.

A table that grows by one copy per day is partitioned by `run_day`.  A run replaces its own day's
partition in one commit, so a run that was cut short can simply be started again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.common import quoted
from tidemark.functions.documents import parsed, scalar_at

RUN_DATE, RUN_DAY = "run_date", "run_day"
FIRST_DAY = "19900101"


def run_stamp(as_of: dt.datetime) -> str:
    """`YYYYMMDDHHMMSS`."""
    return as_of.strftime("%Y%m%d%H%M%S")


def run_day_of(column: str = RUN_DATE) -> Column:
    return F.substring(quoted(column), 1, 8)


def last_run_day(spark: SparkSession, location: str) -> str:
    """Day of the newest copy, or a day long past if there is none.

    The days are the names of the table's folders, so one listing is enough and no file is opened.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(location)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return FIRST_DAY
    prefix = f"{RUN_DAY}="
    days = [name.removeprefix(prefix) for name in (entry.getPath().getName() for entry in files.listStatus(folder)) if name.startswith(prefix)]
    return max(days, default=FIRST_DAY)


def _append_day(df: DataFrame, location: str, as_of: dt.datetime) -> bool:
    spark = df.sparkSession
    stamp = run_stamp(as_of)
    if stamp[:8] <= last_run_day(spark, location):
        return False
    (df.withColumn(RUN_DATE, F.lit(stamp)).withColumn(RUN_DAY, F.lit(stamp[:8]))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_DAY).parquet(location))
    return True


def raw_rows(documents: DataFrame, column: str = "json_data") -> DataFrame:
    """Identifier and kind of each raw document, next to its text."""
    staged = documents.select(quoted(column).alias("json_data"), parsed(column).alias("_document"))
    return staged.select(scalar_at(F.col("_document"), "id").alias("id"),
                         scalar_at(F.col("_document"), "object").alias("object"), "json_data")


def append_bronze(documents: DataFrame, location: str, as_of: dt.datetime, column: str = "json_data") -> bool:
    """Add today's raw documents, once per day.  False if the day is there already."""
    return _append_day(raw_rows(documents, column), location, as_of)


def append_history(df: DataFrame, location: str, columns: Iterable[str], as_of: dt.datetime) -> bool:
    """Add today's copy of the chosen columns, once per day.  False if the day is there already."""
    return _append_day(df.select(*[quoted(c) for c in columns]), location, as_of)


CURRENT = "_current"  # the file of a snapshot table that names the version to read


def files_of(spark: SparkSession, location: str):
    """The file system of a location, and its path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def read_text(spark: SparkSession, location: str) -> str | None:
    """The text of a small file, None if there is none."""
    files, path = files_of(spark, location)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, location: str, text: str) -> None:
    """Replace a small file by another text in one rename: readers see the old text or the new one, whole."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, _, name = location.rpartition("/")
    files, draft = files_of(spark, f"{folder}/_{uuid.uuid4().hex}")
    stream = files.create(draft, True)
    stream.write(text.encode())
    stream.close()
    renaming = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    renaming[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf).rename(
        draft, jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"), renaming)


def current_version(spark: SparkSession, location: str) -> str | None:
    """The folder of a snapshot table's rows, None before its first run has ended."""
    name = read_text(spark, f"{location}/{CURRENT}")
    return None if name is None else f"{location}/{name}"


def write_snapshot(df: DataFrame, location: str, columns: Iterable[str], as_of: dt.datetime) -> None:
    """Replace a snapshot table by the chosen columns and the run date; read it by `read_snapshot`.

    A run writes a folder of its own, and then the name of that folder replaces the old one in a single rename.  A
    run that fails before leaves the table as it was.  The version before is kept for those who still read it;
    older ones, and what failed runs left, are removed.
    """
    spark, before = df.sparkSession, current_version(df.sparkSession, location)
    version = f"version-{run_stamp(as_of)}-{uuid.uuid4().hex[:8]}"
    chosen = df.select(*[quoted(c) for c in columns], F.lit(run_stamp(as_of)).alias(RUN_DATE))
    chosen.write.parquet(f"{location}/{version}")
    replace_text(spark, f"{location}/{CURRENT}", version)
    files, folder = files_of(spark, location)
    kept = {version, before.rsplit("/", 1)[1] if before else None}
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("version-") and name not in kept:
            files.delete(entry.getPath(), True)


def read_snapshot(spark: SparkSession, location: str) -> DataFrame:
    """The rows of the last run of `write_snapshot` that ended."""
    version = current_version(spark, location)
    if version is None:
        raise FileNotFoundError(f"no snapshot has been written to {location}")
    return spark.read.parquet(version)


def _day(df: DataFrame, run_column: str) -> Column:
    """Day of a copy: the partition column where the table has one, so that files of other days stay closed."""
    if RUN_DAY in df.columns and run_column in (RUN_DATE, RUN_DAY):
        return quoted(RUN_DAY).cast("string")
    return run_day_of(run_column)


def latest_snapshot(df: DataFrame, run_column: str = RUN_DATE) -> DataFrame:
    """Rows of the newest day, which is found by a scalar subquery."""
    day = _day(df, run_column)
    return df.filter(day == df.agg(F.max(day)).scalar())


def snapshots_on(df: DataFrame, days: DataFrame, run_column: str = RUN_DATE, day_column: str = "month") -> DataFrame:
    """Rows of the copies taken on the given days; `days` is a calendar, one row per day."""
    wanted = days.select(F.date_format(quoted(day_column), "yyyyMMdd").alias("_wanted")).distinct()
    return df.join(wanted, _day(df, run_column) == F.col("_wanted"), "left_semi")


def month_start_snapshots(df: DataFrame, as_of, months_back: int, run_column: str = RUN_DATE) -> DataFrame:
    """Rows of the first-of-month copies from `months_back` months before `as_of` on.

    A plain predicate on the day of the copy, without a join.
    """
    day = _day(df, run_column)
    first = F.date_format(cal.months_ago(months_back, as_of), "yyyyMMdd")
    last = F.date_format(cal.day(as_of), "yyyyMMdd")
    return df.filter((F.substring(day, 7, 2) == "01") & (day >= first) & (day <= last))


def freshness(df: DataFrame, now, run_column: str = RUN_DATE, error_after_hours: float = 24) -> DataFrame:
    """One row: newest load, its age in hours, and `pass` or `error`."""
    moment = (now if isinstance(now, Column) else F.lit(str(now))).cast("timestamp")
    newest = df.agg(F.max(F.substring(quoted(run_column), 1, 14)).alias("newest"))
    loaded = newest.select(F.to_timestamp("newest", "yyyyMMddHHmmss").alias("max_loaded_at"))
    hours = (F.unix_timestamp(moment) - F.unix_timestamp("max_loaded_at")) / 3600
    return loaded.select("max_loaded_at", hours.alias("age_hours"),
                         F.when(hours <= error_after_hours, "pass").otherwise("error").alias("status"))


def materialize(df: DataFrame, name: str, kind: str = "view", partition_by: Iterable[str] = (),
                bucket_by: tuple[int, str] | None = None) -> DataFrame:
    """Register a result as a view, or write it as a table, under a name such as `schema.table`.

    Tables that are often joined on one key can be bucketed by it, (number of buckets, column):
    joins between tables with the same buckets need no shuffle.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").partitionBy(*partition_by)
        if bucket_by is not None:
            buckets, column = bucket_by
            writer = writer.bucketBy(buckets, column).sortBy(column)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")
    return df.sparkSession.table(name)


def store_failures(failures: DataFrame, name: str) -> DataFrame:
    """Keep the failing rows of a check as a table."""
    return materialize(failures, name, "table")


def changed_rows(wanted: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted rows that differ from the current ones in any of the columns (NULL equals NULL)."""
    same = F.lit(True)
    present = current.select(*[quoted(k).alias(f"_now_{k}") for k in keys]).distinct()
    for key in keys:
        same = same & quoted(key).eqNullSafe(F.col(f"_now_{key}"))
    return wanted.join(present, same, "left_anti")
