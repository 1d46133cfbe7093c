"""Scalars out of JSON text.  Each document is parsed once, into a variant."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.common import ColumnLike, as_column


def json_path(path: str) -> str:
    """`a.b` and `$.a.b` both name the same field."""
    return path if path.startswith("$") else "$." + path


def parsed(value: ColumnLike) -> Column:
    """Variant of a JSON text; NULL where the text is not JSON."""
    return F.try_parse_json(as_column(value))


def scalar_at(variant: Column, path: str) -> Column:
    """Text of a scalar field; NULL for objects, arrays, JSON null and missing fields."""
    place = json_path(path)
    kind = F.schema_of_variant(F.try_variant_get(variant, place, "variant"))
    is_container = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return F.when(~is_container, F.try_variant_get(variant, place, "string"))


def json_value(value: ColumnLike, path: str) -> Column:
    """One scalar out of a JSON text column."""
    return scalar_at(parsed(value), path)


def project_json(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str] | str],
                 keep: list[str] | None = None) -> DataFrame:
    """Typed columns out of one JSON text column.

    `fields` maps the output name to a path, or to (path, type).  Text that cannot be cast gives
    NULL.  `keep` lists columns to carry along (default: all but the JSON column).
    """
    kept = [c for c in df.columns if c != column] if keep is None else keep
    staged = df.select(*kept, parsed(column).alias("_document"))
    outputs = []
    for name, spec in fields.items():
        path, kind = (spec, "string") if isinstance(spec, str) else spec
        text = scalar_at(F.col("_document"), path)
        outputs.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    return staged.select(*kept, *outputs)
