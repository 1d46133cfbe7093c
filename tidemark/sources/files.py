"""Landed extracts: JSON lines, CSV files, nested child rows and wide flattening."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.common import quoted
from tidemark.functions.documents import json_path, parsed
from tidemark.sources.csv_blocks import split_csv_blocks

# Fixed value: how many bad records the daily loads tolerate.
MAX_BAD_RECORDS = 15
CORRUPT = "_corrupt_record"

# Files of the daily application export and the tables they fill.
EXPORTED_TABLES = {
    "billingRevenue.csv": "revenue",
    "projects.csv": "projects",
    "reportTemplates.csv": "report_templates",
    "workflows.csv": "workflows",
    "shares.csv": "shares",
    "dataShares.csv": "data_shares",
    "exports.csv": "exports",
    "imports.csv": "imports",
    "dataExports.csv": "data_exports",
    "views.csv": "views",
    "layers.csv": "layers",
    "userAgents.csv": "user_agents",
    "forms.csv": "forms",
    "billingInvoice.csv": "invoices",
    "billingManualInvoiceItems.csv": "manual_invoice_items",
    "billingManualInvoices.csv": "manual_invoices",
    "organizationMemberships.csv": "memberships",
    "organizationDeviceRegistrations.csv": "organization_mobile_device_registrations",
    "organizations.csv": "organizations",
    "billingPlans.csv": "plans",
    "billingPromoCodes.csv": "promo_codes",
    "roles.csv": "roles",
    "billingSubscriptions.csv": "subscriptions",
    "users.csv": "users",
    "stripe_customers.csv": "stripe_customers",
}
ANY_ITEM = object()


class TooManyBadRecords(ValueError):
    """More records of a load cannot be read than it tolerates."""


def split_json_lines(spark: SparkSession, path: str | list[str], column: str = "json_data") -> tuple[DataFrame, DataFrame]:
    """One JSON document per line: the documents as one text column, and (file, record) of all lines that are not JSON."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    is_bad = parsed("value").isNull()
    rejected = lines.filter(is_bad).select(F.input_file_name().alias("file"), F.col("value").alias("record"))
    return lines.filter(~is_bad).select(F.col("value").alias(column)), rejected


def load_json_lines(spark: SparkSession, path: str | list[str], max_bad: int = 0, column: str = "json_data",
                    rejects: str | None = None) -> DataFrame:
    """One JSON document per line, as one text column; more than `max_bad` other lines are an error.

    Those up to `max_bad`, such as `MAX_BAD_RECORDS`, are written to the folder `rejects`, which must then be given.
    """
    documents, rejected = split_json_lines(spark, path, column)
    _hand_over(rejected, path, max_bad, rejects)
    return documents


def _hand_over(rejected: DataFrame, path: str | list[str], max_bad: int, rejects: str | None) -> None:
    """Write the rejected records to a folder of their own, and fail if they are too many; nothing is dropped unseen."""
    if max_bad and rejects is None:
        raise ValueError("a load that tolerates bad records needs a folder for them, `rejects`")
    if rejects is not None:
        rejected.write.mode("overwrite").parquet(rejects)
        rejected = rejected.sparkSession.read.schema(rejected.schema).parquet(rejects)
    if rejected.limit(max_bad + 1).count() > max_bad:
        raise TooManyBadRecords(f"more than {max_bad} records of {path} cannot be read")


def split_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
              multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """CSV with a header: the rows, and (file, record) of all records that do not fit the schema.

    Without a schema the types are inferred, which reads the files once more; give a schema for
    large loads.  Quoted line breaks need `multi_line`, which reads the files twice and stores the records: they are
    put together from the lines of each block (see `csv_blocks`), so that many tasks read one file.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if multi_line:
        return split_csv_blocks(spark, path, schema, CORRUPT)
    options = {"header": True, "quote": '"', "escape": '"'}
    if schema is None:
        schema = spark.read.options(**options, inferSchema=True).csv(path).schema
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # Without pruning the parser reads all columns whatever is selected, so every use rejects the same records.
    rows = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False).schema(with_corrupt).csv(path)
    is_bad = F.col(CORRUPT).isNotNull()
    # Spark reads no file for the rejected text alone, so a condition that always holds names a field.
    some_field = F.hash(*[quoted(f.name) for f in schema.fields[:1]]) >= -(2**31)
    rejected = rows.filter(is_bad & some_field).select(F.input_file_name().alias("file"), F.col(CORRUPT).alias("record"))
    return rows.filter(~is_bad & some_field).drop(CORRUPT), rejected


def load_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             max_bad: int = 0, multi_line: bool = False, rejects: str | None = None) -> DataFrame:
    """CSV with a header; more than `max_bad` records that do not fit are an error.

    Those up to `max_bad`, such as `MAX_BAD_RECORDS`, are written to the folder `rejects`, which must then be given.
    """
    rows, rejected = split_csv(spark, path, schema, multi_line)
    _hand_over(rejected, path, max_bad, rejects)
    return rows


def load_many(spark: SparkSession, mapping: Mapping[str, str], folder: str, loader=load_csv) -> dict[str, DataFrame]:
    """Tables by name, from a mapping of file name to table name such as `EXPORTED_TABLES`.

    File names with a dash are dated copies and are passed over.
    """
    return {table: loader(spark, f"{folder.rstrip('/')}/{file}")
            for file, table in mapping.items() if "-" not in file}


def load_union(pulls: Iterable[DataFrame]) -> DataFrame:
    """Several pulls of one entity (such as one per status) below each other."""
    result = None
    for pull in pulls:
        result = pull if result is None else result.unionByName(pull, allowMissingColumns=True)
    if result is None:
        raise ValueError("no pulls given")
    return result


def explode_child(df: DataFrame, path: str, column: str = "json_data", keep: Iterable[str] = (),
                  name: str = "json_data") -> DataFrame:
    """Items of a nested array as rows of their own, each as JSON text."""
    items = F.try_variant_get(parsed(column), json_path(path), "array<variant>")
    rows = df.select(*[quoted(k) for k in keep], F.explode(items).alias("_item"))
    return rows.select(*[quoted(k) for k in keep], F.to_json("_item").alias(name))


# -- flattening ---------------------------------------------------------------------------------

def variant_schema(df: DataFrame, column: str) -> T.DataType:
    """Schema that covers all documents of a text column, NULL and mixed types as such.  Reads the column at once."""
    text = df.agg(F.schema_of_variant_agg(parsed(column))).first()[0]
    # Only where a type stands: at the start, after a name and its colon, or inside an array.
    return T.DataType.fromDDL(re.sub(r"(?:^|(?<=: )|(?<=ARRAY<))OBJECT(?=<)", "STRUCT", text))


def as_read(kind: T.DataType) -> T.DataType:
    """The types documents are read with: text for values that are always NULL or of mixed types."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_read(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_read(kind.elementType))
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def merged_schema(df: DataFrame, column: str) -> T.DataType:
    """Schema that covers all documents of a text column.  Reads the column at once."""
    return as_read(variant_schema(df, column))


def array_paths(kind: T.DataType, path: tuple = ()) -> list[tuple]:
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in array_paths(f.dataType, (*path, f.name))]
    if isinstance(kind, T.ArrayType):
        return [path, *array_paths(kind.elementType, (*path, ANY_ITEM))]
    return []


def size_at(value: Column, path: tuple) -> Column:
    if not path:
        return F.array_size(value)
    step, rest = path[0], path[1:]
    if step is ANY_ITEM:
        return F.array_max(F.transform(value, lambda item: size_at(item, rest)))
    return size_at(value.getField(step), rest)


def flatten_json(df: DataFrame, column: str, sep: str = "_", max_items: int | None = None,
                 keep: Iterable[str] | None = None, schema: T.DataType | None = None,
                 widths: Mapping[tuple, int] | None = None) -> DataFrame:
    """Nested documents as wide rows: names joined with `sep`, array items numbered from 0.

    The columns depend on the data, so the documents are read twice at once: for the common schema
    and for the greatest length of each array.  A known `schema` spares the first reading.
    `max_items` spares the second: items after these come as JSON text in one more column `<name>_rest`.
    Known `widths` spare it too; they must be the greatest lengths, as `kept_schema` keeps them with the schema.
    """
    kind = merged_schema(df, column) if schema is None else schema
    kept = [c for c in df.columns if c != column] if keep is None else list(keep)
    nested = df.select(*[quoted(k) for k in kept], F.from_json(quoted(column), kind).alias("_document"))
    paths = array_paths(kind)
    known = widths
    widths = {p: max_items for p in paths if max_items is not None} if known is None else {p: known.get(p, 0) for p in paths}
    if paths and max_items is None and known is None:
        sizes = nested.agg(*[F.max(size_at(F.col("_document"), p)).alias(f"w{i}") for i, p in enumerate(paths)])
        widths = {p: n or 0 for p, n in zip(paths, sizes.first(), strict=True)}

    def outputs(value: Column, part: T.DataType, path: tuple, label: list[str]) -> list[Column]:
        if isinstance(part, T.StructType):
            return [c for f in part.fields
                    for c in outputs(value.getField(f.name), f.dataType, (*path, f.name), [*label, f.name])]
        if isinstance(part, T.ArrayType):
            items = [c for i in range(widths[path])
                     for c in outputs(F.get(value, F.lit(i)), part.elementType, (*path, ANY_ITEM), [*label, str(i)])]
            if max_items is None:
                return items
            rest = F.slice(value, max_items + 1, F.greatest(F.size(value) - max_items, F.lit(0)))
            return [*items, F.when(F.size(value) > max_items, F.to_json(rest)).alias(sep.join([*label, "rest"]))]
        return [value.alias(sep.join(label))]

    return nested.select(*[quoted(k) for k in kept], *outputs(F.col("_document"), kind, (), []))
