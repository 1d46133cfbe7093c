"""State kept up to date by a day's changes instead of being computed anew from all history.

A state has two tables: `pieces`, reduced facts with one row per key, and `derived`, what follows from all pieces of
one owner.  Both lie in buckets by owner.  A run brings the changed pieces in, derives the owners they touch anew, and
writes the buckets of those owners alone; one rename of a small file takes over both tables at once.  A run that
fails leaves the state as it was, and one that is started again with the same changes gives the same state.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.common import quoted
from tidemark.sources.lifecycle import CURRENT, files_of, read_text, replace_text, run_stamp

BUCKETS = 256  # of a new state; their names are listed in its small file
PIECES, DERIVED, BUCKET = "pieces", "derived", "_bucket"


def _bucket_of(owner: str, keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a piece; pieces without an owner are spread by their keys."""
    text = F.coalesce(quoted(owner).cast("string"), F.concat_ws("|", *[quoted(k).cast("string") for k in keys]))
    return F.pmod(F.xxhash64(text), F.lit(buckets)).cast("int")


def listing_of(spark: SparkSession, location: str) -> dict | None:
    """What the state consists of; None before its first run has ended."""
    text = read_text(spark, f"{location}/{CURRENT}")
    return None if text is None else json.loads(text)


def _rows(spark: SparkSession, location: str, listing: dict | None, table: str, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """Rows of a table, or those of some buckets only: files of other buckets are not opened."""
    if listing is None:
        return None
    schema = T.StructType.fromJson(listing["tables"][table]["schema"])
    held = listing["tables"][table]["buckets"]
    chosen = held if buckets is None else [b for b in map(str, buckets) if b in held]
    paths = [f"{location}/{held[b]}/{table}/{BUCKET}={b}" for b in chosen]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_state(spark: SparkSession, location: str, table: str = DERIVED) -> DataFrame:
    """The rows after the last run of `update_state` that ended."""
    rows = _rows(spark, location, listing_of(spark, location), table)
    if rows is None:
        raise FileNotFoundError(f"no state has been written to {location}")
    return rows


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return functools.reduce(Column.__and__, [_of(left, c).eqNullSafe(_of(right, c)) for c in columns])


def _of(df: DataFrame, name: str) -> Column:
    return df["`" + name.replace("`", "``") + "`"]


def update_state(changes: DataFrame, location: str, keys: Sequence[str], owner: str, merge: Callable[[Column | None], dict[str, Column]],
                 derive: Callable[[DataFrame], DataFrame], as_of: dt.datetime, settings: dict | None = None,
                 dropped: Column | None = None, buckets: int = BUCKETS) -> int:
    """Bring a day's changes into a state; returns the number of buckets written.

    `changes` has one row per changed key.  `merge` gets the old piece of the key as a struct (all fields null if there was
    none; None on the first run) and returns the columns of the new one; rows that meet `dropped` take their piece
    away.  `derive` turns all pieces of some owners into derived rows with the column `owner`.

    Nulls: a null key is a key like others, and so is a null owner.  Without changes nothing is written but on the
    first run.  `settings` that differ from those the state was begun with are an error.
    """
    spark, before = changes.sparkSession, listing_of(changes.sparkSession, location)
    if before is not None and before["settings"] != (settings or {}):
        raise ValueError(f"the state was begun with {before['settings']}, not {settings or {}}")
    number = buckets if before is None else before["n_buckets"]
    version = f"version-{run_stamp(as_of)}-{uuid.uuid4().hex[:8]}"
    old = _rows(spark, location, before, PIECES)
    held = None
    if old is not None:
        held = F.col("_old")
        known = old.select(*[quoted(k) for k in keys], F.struct(*[quoted(c) for c in old.columns]).alias("_old"))
        changes = changes.join(known, _same(changes, known, keys), "left").select(*[_of(changes, c) for c in changes.columns], "_old")
    new = merge(held)
    merged = changes.select(
        F.struct(*[c.alias(name) for name, c in new.items()]).alias("_new"),
        (F.lit(False) if dropped is None else F.coalesce(dropped, F.lit(False))).alias("_dropped"),
        *([held] if held is not None else []))
    # As large as the day's changes; read several times below.
    merged.write.parquet(f"{location}/{version}/changes")
    merged = spark.read.schema(merged.schema).parquet(f"{location}/{version}/changes")

    sides = merged.select("_new.*")
    if old is not None:
        sides = sides.unionByName(merged.filter("_old IS NOT NULL").select("_old.*"))
    sides = sides.withColumn(BUCKET, _bucket_of(owner, keys, number))
    touched = sorted(r[0] for r in sides.select(BUCKET).distinct().collect())  # no more than there are buckets
    if not touched and before is not None:
        return 0
    owners = sides.select(quoted(owner)).distinct()

    pieces = merged.filter("NOT _dropped").select("_new.*")
    if old is not None:
        rest, gone = _rows(spark, location, before, PIECES, touched), merged.select("_new.*").select(*[quoted(k) for k in keys])
        pieces = pieces.unionByName(rest.join(gone, _same(rest, gone, keys), "left_anti"))
    tables = {PIECES: _write(pieces, f"{location}/{version}/{PIECES}", _bucket_of(owner, keys, number))}

    pieces = _rows(spark, location, {"tables": {PIECES: _listed(spark, location, version, PIECES, tables[PIECES])}}, PIECES)
    derived = derive(pieces.join(owners, _same(pieces, owners, [owner]), "left_semi"))
    if old is not None:
        rest = _rows(spark, location, before, DERIVED, touched)
        derived = derived.unionByName(rest.join(owners, _same(rest, owners, [owner]), "left_anti"))
    tables[DERIVED] = _write(derived, f"{location}/{version}/{DERIVED}", _bucket_of(owner, [owner], number))

    listing = {"settings": settings or {}, "n_buckets": number, "tables": {}}
    for table, schema in tables.items():
        listed = _listed(spark, location, version, table, schema)
        if before is not None:
            untouched = {b: v for b, v in before["tables"][table]["buckets"].items() if int(b) not in touched}
            listed["buckets"] = untouched | listed["buckets"]
        listing["tables"][table] = listed
    replace_text(spark, f"{location}/{CURRENT}", json.dumps(listing))
    _clear(spark, location, [listing] + ([before] if before else []))
    return len(touched)


def _write(rows: DataFrame, path: str, bucket: Column) -> T.StructType:
    """Rows in folders by bucket.  Files are made even, so a bucket with a hot owner is written by several tasks."""
    rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    return rows.schema


def _listed(spark: SparkSession, location: str, version: str, table: str, schema: T.StructType) -> dict:
    files, folder = files_of(spark, f"{location}/{version}/{table}")
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    held = {n.removeprefix(f"{BUCKET}="): version for n in names if n.startswith(f"{BUCKET}=")}
    return {"schema": json.loads(schema.json()), "buckets": held}


def _clear(spark: SparkSession, location: str, kept: Sequence[dict]) -> None:
    """Remove versions that neither the state nor the one before it reads, and what failed runs left."""
    used = {v for listing in kept for table in listing["tables"].values() for v in table["buckets"].values()}
    files, folder = files_of(spark, location)
    for entry in files.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith("version-") and name not in used:
            files.delete(entry.getPath(), True)
