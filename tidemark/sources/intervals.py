"""Daily copies of a table kept as intervals: each row once, with the day it came and the day it was gone.

A full copy a day grows by the table's size; intervals grow by what changed.  Rows that stand today lie in buckets by
their content, of which a run writes only those that changed; intervals that ended are added as files of their own.
One rename of a small file takes over both.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.common import quoted
from tidemark.sources.kept_state import BUCKET, BUCKETS, listing_of
from tidemark.sources.lifecycle import CURRENT, RUN_DAY, files_of, replace_text, run_stamp

COPIES, SINCE, UNTIL = "_copies", "_since", "_until"


def _bucket(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[quoted(c) for c in columns]), F.lit(buckets)).cast("int")


def _standing(spark: SparkSession, location: str, listing: dict, buckets: Sequence[int] | None = None) -> DataFrame:
    """Rows that stand on the newest day, or those of some buckets."""
    schema = T.StructType.fromJson(listing["schema"])
    chosen = listing["standing"] if buckets is None else [b for b in map(str, buckets) if b in listing["standing"]]
    paths = [f"{location}/{listing['standing'][b]}/standing/{BUCKET}={b}" for b in chosen]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def append_intervals(df: DataFrame, location: str, columns: Iterable[str], as_of: dt.datetime, buckets: int = BUCKETS) -> bool:
    """Add today's copy of the chosen columns, once per day.  False if that day or a later one is there already.

    Equal rows are one interval with their number; NULL equals NULL.  A number that changes ends the interval and begins
    another.  Columns must be of types that can be grouped.  A run that fails leaves the table as it was.
    """
    spark, columns = df.sparkSession, list(columns)
    listing, day = listing_of(spark, location), run_stamp(as_of)[:8]
    if listing is not None and day <= listing["days"][-1]:
        return False
    if listing is not None and columns != listing["columns"]:
        raise ValueError(f"the table has the columns {listing['columns']}, not {columns}")
    version = f"version-{day}-{uuid.uuid4().hex[:8]}"
    path, kept = f"{location}/{version}", [quoted(c) for c in columns]
    number = buckets if listing is None else listing["n_buckets"]
    today = df.groupBy(*kept).agg(F.count(F.lit(1)).alias(COPIES))
    if listing is None:
        standing = today.withColumn(SINCE, F.lit(day))
        touched: list[int] = []
    else:
        # Both copies in one aggregation: rows of which as many stand as before are not looked at again.
        both = today.select(*kept, F.col(COPIES).alias("_now"), F.lit(None).cast("long").alias("_was"), F.lit(None).cast("string").alias(SINCE)).unionByName(
            _standing(spark, location, listing).select(*kept, F.lit(None).cast("long").alias("_now"), F.col(COPIES).alias("_was"), SINCE))
        sides = both.groupBy(*kept).agg(F.max("_now").alias("_now"), F.max("_was").alias("_was"), F.max(SINCE).alias(SINCE))
        changed = sides.filter(~F.col("_now").eqNullSafe(F.col("_was")))
        changed.write.parquet(f"{path}/changes")
        changed = spark.read.schema(changed.schema).parquet(f"{path}/changes")
        touched = sorted(r[0] for r in changed.select(_bucket(columns, number)).distinct().collect())  # no more than there are buckets
        ended = changed.filter("_was IS NOT NULL").select(*kept, F.col("_was").alias(COPIES), SINCE, F.lit(day).alias(UNTIL))
        ended.write.parquet(f"{path}/ended")
        old = _standing(spark, location, listing, touched)
        gone = changed.select(F.struct(*kept).alias("_row"))
        rest = old.join(gone, F.struct(*[old["`" + c.replace("`", "``") + "`"] for c in columns]).eqNullSafe(gone["_row"]), "left_anti")
        standing = rest.unionByName(changed.filter("_now IS NOT NULL").select(*kept, F.col("_now").alias(COPIES), F.lit(day).alias(SINCE)))
    standing.withColumn(BUCKET, _bucket(columns, number)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/standing")
    files, folder = files_of(spark, f"{path}/standing")
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    held = {n.removeprefix(f"{BUCKET}="): version for n in names if n.startswith(f"{BUCKET}=")}
    if listing is None:
        listing = {"columns": columns, "schema": json.loads(standing.schema.json()), "n_buckets": number, "days": [], "ended": []}
    else:
        held = {b: v for b, v in listing["standing"].items() if int(b) not in touched} | held
        listing["ended"] = listing["ended"] + ([version] if touched else [])
    before = listing.get("standing", {})
    listing = listing | {"standing": held, "days": listing["days"] + [day]}
    replace_text(spark, f"{location}/{CURRENT}", json.dumps(listing))
    _clear(spark, location, set(held.values()) | set(before.values()), set(listing["ended"]))
    return True


def _clear(spark: SparkSession, location: str, standing: set[str], ended: set[str]) -> None:
    """Remove what neither this day nor the one before it reads, and what failed runs left."""
    files, folder = files_of(spark, location)
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if not name.startswith("version-") or name in standing:
            continue
        for part in files.listStatus(entry.getPath()) if name in ended else [entry]:
            if part.getPath().getName() != "ended":
                files.delete(part.getPath(), True)


def read_intervals(spark: SparkSession, location: str) -> DataFrame:
    """All rows with their number `_copies`, their first day `_since`, and `_until`, the first day without them (null: none yet)."""
    listing = listing_of(spark, location)
    if listing is None:
        raise FileNotFoundError(f"no copy has been written to {location}")
    now = _standing(spark, location, listing).withColumn(UNTIL, F.lit(None).cast("string"))
    if not listing["ended"]:
        return now
    return now.unionByName(spark.read.schema(now.schema).parquet(*[f"{location}/{v}/ended" for v in listing["ended"]]))


def copies_on(spark: SparkSession, location: str, days: Iterable[dt.date]) -> DataFrame:
    """The copies of the given days, as full copies would have them, with the column `run_day`; days without a copy give nothing.

    Each interval writes out the days it covers, so nothing is joined; an interval that covers none is dropped by the scan.
    """
    rows = read_intervals(spark, location)
    listing = listing_of(spark, location)
    wanted = sorted({d.strftime("%Y%m%d") for d in days} & set(listing["days"]))
    if not wanted:
        wanted = [""]  # before all days
    near = rows.filter((F.col(SINCE) <= wanted[-1]) & (F.col(UNTIL).isNull() | (F.col(UNTIL) > wanted[0])))
    covered = F.filter(F.array(*[F.lit(d) for d in wanted]), lambda d: (d >= F.col(SINCE)) & (F.col(UNTIL).isNull() | (d < F.col(UNTIL))))
    each = near.select(*[quoted(c) for c in listing["columns"]], COPIES, F.explode(covered).alias(RUN_DAY))
    return each.select(*[quoted(c) for c in listing["columns"]], RUN_DAY, F.explode(F.sequence(F.lit(1), F.col(COPIES))).alias("_n")).drop("_n")
