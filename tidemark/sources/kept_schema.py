"""The schema of documents that arrive day by day, kept next to them.

Each day's new documents alone are read for their types and array lengths; these are merged with what is kept, and
the result is what a reading of all documents together would find.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.common import quoted
from tidemark.sources.files import ANY_ITEM, array_paths, as_read, size_at, variant_schema
from tidemark.sources.lifecycle import read_text, replace_text


@dataclass(frozen=True)
class KeptSchema:
    """Types as found (NULL and mixed ones told apart), and the greatest length of each array."""

    found: T.DataType = field(default_factory=T.NullType)
    widths: dict[tuple, int] = field(default_factory=dict)

    @property
    def schema(self) -> T.DataType:
        return as_read(self.found)

    def merged(self, other: KeptSchema, spark: SparkSession) -> KeptSchema:
        widths = {p: max(self.widths.get(p, 0), other.widths.get(p, 0)) for p in (*self.widths, *other.widths)}
        found = _merged(self.found, other.found, spark)
        return KeptSchema(found, {p: n for p, n in widths.items() if p in array_paths(as_read(found))})


def _merged(a: T.DataType, b: T.DataType, spark: SparkSession) -> T.DataType:
    """The type of values of which some have one type and some the other, as variants are merged."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        ours, theirs = ({f.name: f.dataType for f in kind.fields} for kind in (a, b))
        return T.StructType([T.StructField(n, _merged(ours.get(n, T.NullType()), theirs.get(n, T.NullType()), spark))
                             for n in sorted({*ours, *theirs}, key=lambda n: n.encode())])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_merged(a.elementType, b.elementType, spark))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        both = spark.range(0).select(F.coalesce(*[F.lit(None).cast(k) for k in (a, b)]).alias("k"))
        return both.schema["k"].dataType
    return T.VariantType()


def schema_found(df: DataFrame, column: str) -> KeptSchema:
    """Types and array lengths of a text column's documents; reads them twice, the second time only if there are arrays."""
    found = variant_schema(df, column)
    kind = as_read(found)
    paths = array_paths(kind)
    if not paths:
        return KeptSchema(found)
    nested = df.select(F.from_json(quoted(column), kind).alias("d"))
    sizes = nested.agg(*[F.max(size_at(F.col("d"), p)).alias(f"w{i}") for i, p in enumerate(paths)]).first()
    return KeptSchema(found, {p: n or 0 for p, n in zip(paths, sizes, strict=True)})


def read_schema(spark: SparkSession, location: str) -> KeptSchema:
    """What is kept in a file; nothing before the first day."""
    text = read_text(spark, location)
    if text is None:
        return KeptSchema()
    entry = json.loads(text)
    widths = {tuple(ANY_ITEM if step is None else step for step in path): n for path, n in entry["widths"]}
    return KeptSchema(T.DataType.fromDDL(entry["types"]), widths)


def keep_schema(new: DataFrame, column: str, location: str) -> KeptSchema:
    """Merge the new documents' schema into the kept one, in one rename, and return it.

    Reads the new documents alone.  The same documents twice change nothing, so a day can be run again.
    """
    spark = new.sparkSession
    merged = read_schema(spark, location).merged(schema_found(new, column), spark)
    widths = [[[None if step is ANY_ITEM else step for step in path], n] for path, n in merged.widths.items()]
    replace_text(spark, location, json.dumps({"types": _ddl(merged.found), "widths": widths}))
    return merged


def _ddl(kind: T.DataType) -> str:
    """The type with its names quoted, whatever they are."""
    if isinstance(kind, T.StructType):
        return "STRUCT<" + ", ".join(f"{'`' + f.name.replace('`', '``') + '`'}: {_ddl(f.dataType)}" for f in kind.fields) + ">"
    return f"ARRAY<{_ddl(kind.elementType)}>" if isinstance(kind, T.ArrayType) else kind.simpleString()
