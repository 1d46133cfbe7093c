"""CSV files with quoted line breaks, read by many tasks.

A file is read as lines, block by block, as Spark splits text.  Whether a line begins inside a quoted field depends
on all lines before it, but only through two states, inside or outside; so what a line does is a function of two
states, and functions of consecutive lines compose.  Each block composes those of its lines, a prefix composition
over the blocks of a file (one small row each) gives the state every block begins in, and records are then put
together within their blocks.  Only the last record of a block and the lines that finish it in later ones are shuffled.

Both passes over the lines read them in a stream, as the scan gives them: a task holds a batch of lines and the record
it is in, whatever the size of its blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.common import quoted
from tidemark.session import checkpoint_dir

# Types a column can be found to have, each with a pattern its texts must fit beside the cast.
INFERRED = [("int", r"^[+-]?[0-9]+$"), ("bigint", r"^[+-]?[0-9]+$"), ("double", r"^\S+$"), ("date", r"^\d{4}-\d{2}-\d{2}$"),
            ("timestamp", r"^\d{4}-\d{2}-\d{2}[T ]\S+$"), ("boolean", r"^(?i:true|false)$")]


def _ends_inside(line: Column, inside: bool) -> Column:
    """Whether a line leaves the reader inside a quoted field, given whether it finds it there.

    A quote opens a field only as its first character; inside, two quotes are one character, and a single one
    closes the field.  What follows up to the next comma belongs to it.
    """
    def after(state: Column, piece: Column) -> Column:
        body = F.when(state, piece).otherwise(F.substring(piece, 2, 2**31 - 1))
        open_ = F.instr(F.replace(body, F.lit('""'), F.lit("")), '"') == 0
        return F.when(state | F.startswith(piece, F.lit('"')), open_).otherwise(False)

    fold = F.aggregate(F.split(line, ","), F.lit(inside), after)
    return F.when(F.instr(line, '"') == 0, inside).otherwise(fold)


def _composed(df: DataFrame, keys: list[str], order: str, outside: Column, inside: Column) -> DataFrame:
    """Adds `before` and `after` to rows that each map two states to two: what all rows before a row do, and those
    with it.  `fixed` says that the result does not depend on the first state; `flips` is the result, or, where it
    does, whether it is the other state."""
    window = Window.partitionBy(*keys).orderBy(order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed, swaps = outside == inside, outside & ~inside
    df = df.withColumn("_swaps", F.sum(swaps.cast("long")).over(so_far))
    df = df.withColumn("_last", F.last(F.when(fixed, F.struct(outside.alias("state"), "_swaps")), ignorenulls=True).over(so_far))
    odd = (F.col("_swaps") - F.coalesce("_last._swaps", F.lit(0))) % 2 == 1
    after = F.struct(F.col("_last").isNotNull().alias("fixed"), (F.coalesce("_last.state", F.lit(False)) != odd).alias("flips"))
    df = df.withColumn("after", after).drop("_swaps", "_last")
    return df.withColumn("before", F.coalesce(F.lag("after").over(window), F.struct(F.lit(False).alias("fixed"), F.lit(False).alias("flips"))))


def _result(function: Column, state: Column) -> Column:
    return F.when(function["fixed"], function["flips"]).otherwise(function["flips"] != state)


ROW_GROUP_BYTES = 16 << 20  # of the stored records; a writer holds one row group
BLOCK = "file string, block bigint, outside boolean, inside boolean, begun_outside bigint, begun_inside bigint, crlf boolean"
PIECE = "file string, block bigint, record bigint, at bigint, header boolean, crlf boolean, open boolean, text string"


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header, record): the records of CSV files as texts; `header` marks the first one of each file.

    Lines end with \\n, or with \\r\\n where the first one of a file does, which then counts as \\n in quotes too.
    Records without any character are left out.  The files are read here, twice, and what was put together is kept in
    the folder that all executors share.
    """
    line = F.col("value")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), line.alias("line"),
        _ends_inside(line, False).alias("outside"), _ends_inside(line, True).alias("inside"))
    blocks = lines.select("file", "block", "place", "outside", "inside", F.endswith("line", F.lit("\r")).alias("cr")).mapInArrow(_blocks, BLOCK)
    blocks = _composed(blocks, ["file"], "block", F.col("outside"), F.col("inside"))
    inside = _result(F.col("before"), F.lit(False))
    begun = F.when(inside, F.col("begun_inside")).otherwise(F.col("begun_outside"))
    by_place = Window.partitionBy("file").orderBy("block")
    earlier = by_place.rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(begun > 0, F.struct(F.col("block").alias("block"), begun.alias("record"))), ignorenulls=True).over(earlier)
    blocks = blocks.select(F.col("file").alias("_file"), F.col("block").alias("_block"), inside.alias("begins_inside"), owner.alias("_owner"),
                           F.first("crlf").over(by_place).alias("crlf"))

    # One row a block; the join leaves the lines in the order in which they are read.
    lines = lines.join(F.broadcast(blocks), (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    pieces = lines.select("file", "block", "place", "line", "outside", "inside", "begins_inside", "crlf", F.col("_owner.block").alias("owner_block"),
                          F.col("_owner.record").alias("owner_record")).mapInArrow(_pieces, PIECE)
    folder = f"{checkpoint_dir(spark)}/tidemark-records-{uuid.uuid4().hex}"
    pieces.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(folder)
    pieces = spark.read.schema(pieces.schema).parquet(folder)

    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda piece: piece["text"]), "\n")
    ended = pieces.filter("open").groupBy("file", "block", "record").agg(
        F.max("header").alias("header"), F.max("crlf").alias("crlf"), whole.alias("text"))
    columns = ["file", "header", "crlf", "text"]
    text = F.col("text")
    text = F.when(F.col("crlf"), F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\r$", "")).otherwise(text)
    records = pieces.filter("NOT open").select(*columns).unionAll(ended.select(*columns))
    return records.select("file", "header", text.alias("record")).filter("record != ''")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches cut where a block ends, each with its file and block."""
    key, place = None, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block, places = batch.column("file"), batch.column("block").to_numpy(), batch.column("place").to_numpy()
        if places[0] <= place or (np.diff(places) <= 0).any():
            raise ValueError("lines do not come in the order of their files")
        place = places[-1]
        changes = pc.not_equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False) | (block[1:] != block[:-1])
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts, cuts[1:]):
            yield (file[i].as_py(), int(block[i])), batch.slice(i, j - i)


def _states(outside: np.ndarray, inside: np.ndarray, state: bool) -> tuple[np.ndarray, bool]:
    """Whether each line begins inside a quoted field, and whether the last one ends there, where the first begins in `state`."""
    swaps = np.cumsum(outside & ~inside)
    fixed = outside == inside
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    start = np.where(last >= 0, outside[last], state)
    after = start ^ ((swaps - np.where(last >= 0, swaps[last], 0)) % 2 == 1)
    return np.append([state], after[:-1]), bool(after[-1])


def _flags(run: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(run.column(c).to_numpy(zero_copy_only=False) for c in ("outside", "inside"))


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each block does to either state, and how many records begin in it."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()),
                        ("begun_outside", pa.int64()), ("begun_inside", pa.int64()), ("crlf", pa.bool_())])
    key, row = None, None
    for found, run in _runs(batches):
        if found != key:
            if row:
                yield pa.RecordBatch.from_pylist([row], schema)
            key, row = found, {"file": found[0], "block": found[1], "outside": False, "inside": True, "begun_outside": 0, "begun_inside": 0,
                               "crlf": run.column("cr")[0].as_py()}
        for name in ("outside", "inside"):
            before, row[name] = _states(*_flags(run), row[name])
            row[f"begun_{name}"] += int((~before).sum())
    if row:
        yield pa.RecordBatch.from_pylist([row], schema)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each block; its last one is `open`, as are the lines that finish a record of an earlier block."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("record", pa.int64()), ("at", pa.int64()), ("header", pa.bool_()),
                        ("crlf", pa.bool_()), ("open", pa.bool_()), ("text", pa.string())])

    def rows(records: np.ndarray, texts: pa.Array, open_: bool) -> pa.RecordBatch:
        n, (file, at) = len(texts), key
        of = owner if not records[0] else (at, None)
        return pa.RecordBatch.from_arrays([
            pa.array([file] * n, pa.string()), pa.array(np.full(n, of[0])), pa.array(records if records[0] else [owner[1]], pa.int64()), pa.array(np.full(n, at)),
            pa.array((records == 1) & (owner[0] is None)), pa.array(np.full(n, crlf)), pa.array(np.full(n, open_)), texts.cast(pa.string())], schema=schema)

    def held(open_: bool) -> Iterator[pa.RecordBatch]:
        if parts:
            yield rows(np.array([record]), pa.array(["\n".join(parts)], pa.string()), open_)

    key, owner, crlf, state, record, parts = None, (None, None), False, False, 0, []
    for found, run in _runs(batches):
        if found != key:
            yield from held(True)
            key, record, parts = found, 0, []  # record 0: the end of one that began in an earlier block
            state, crlf, *owner = (run.column(c)[0].as_py() for c in ("begins_inside", "crlf", "owner_block", "owner_record"))
        before, state = _states(*_flags(run), state)
        begins, lines = np.flatnonzero(~before), run.column("line")
        first = int(begins[0]) if len(begins) else run.num_rows
        parts.extend(lines.slice(0, first).to_pylist())
        if len(begins):
            yield from held(record == 0)
            offsets = pa.array(np.append(begins, run.num_rows) - first, pa.int32())
            texts = pc.binary_join(pa.ListArray.from_arrays(offsets, lines.slice(first)), "\n")
            if len(texts) > 1:
                yield rows(record + 1 + np.arange(len(texts) - 1), texts.slice(0, len(texts) - 1), False)
            record, parts = record + len(texts), [texts[-1].as_py()]
    yield from held(True)


def inferred_schema(records: DataFrame) -> T.StructType:
    """Names from the header of the first file, types that all records fit: one pass that returns one row."""
    header = records.filter("header").orderBy("file").select("record").first()
    if header is None:
        return T.StructType([])
    spark = records.sparkSession
    one = spark.createDataFrame([(header[0],)], "record string")
    n = one.select(F.schema_of_csv(F.lit(header[0]), {"escape": '"'}).alias("s")).first()[0]
    width = len(T.StructType.fromDDL(n.removeprefix("STRUCT<").removesuffix(">")).fields)
    names = one.select(parsed_record(F.col("record"), T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(width)])).alias("r")).first()[0]
    names = [name or f"_c{k}" for k, name in enumerate(names)]
    texts = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(width)])
    rows = records.filter("NOT header").select(parsed_record(F.col("record"), texts).alias("r"))

    def all_fit(k: int, kind: str, pattern: str) -> Column:
        value = F.col(f"r.c{k}")
        fit = F.when(value.isNotNull(), value.rlike(pattern) & value.try_cast(kind).isNotNull())  # a NULL fits any type
        return F.coalesce(F.min(fit), F.lit(False)).alias(f"{k}_{kind}")

    fits = rows.agg(*[all_fit(k, kind, pattern) for k in range(width) for kind, pattern in INFERRED]).first()
    kinds = [next((kind for kind, _ in INFERRED if fits[f"{k}_{kind}"]), "string") for k in range(width)]
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in zip(names, kinds)])


def parsed_record(record: Column, schema: T.StructType, **options: str) -> Column:
    """The fields of a record, as a struct."""
    ddl = ", ".join(f"{'`' + f.name.replace('`', '``') + '`'} {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(record, ddl, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"} | options)


def split_csv_blocks(spark: SparkSession, path: str | list[str], schema: T.StructType | None, corrupt: str) -> tuple[DataFrame, DataFrame]:
    """The rows, and (file, record) of all records that do not fit the schema (inferred where none is given).

    Records are put together once, however often the rows and the others are read.
    """
    records = csv_records(spark, path)
    if schema is None:
        schema = inferred_schema(records)
    with_corrupt = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    rows = records.filter("NOT header").select("file", parsed_record(F.col("record"), with_corrupt, columnNameOfCorruptRecord=corrupt).alias("_row"))
    bad = F.col("_row")[corrupt].isNotNull()
    kept = rows.filter(~bad).select(*[F.col("_row")[f.name].alias(f.name) for f in schema.fields])
    return kept, rows.filter(bad).select("file", F.col("_row")[corrupt].alias("record"))
