"""Parts of URLs, cut by text position so that addresses without a scheme work too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.common import ColumnLike, as_column

# The prefixes that do not belong to the host or the path.
HOST_PREFIXES = ("android-app://", "http://", "https://")
PATH_PREFIXES = ("http://", "https://")


def _without(value: ColumnLike, prefixes: tuple[str, ...]) -> Column:
    text = as_column(value)
    for prefix in prefixes:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return text


def _piece(text: Column, delimiter: str, number: int) -> Column:
    return F.split_part(text, F.lit(delimiter), F.lit(number))


def url_host(value: ColumnLike) -> Column:
    """Host: everything up to the first slash or question mark after the scheme."""
    return _piece(_piece(_without(value, HOST_PREFIXES), "/", 1), "?", 1)


def url_path(value: ColumnLike) -> Column:
    """Path without its leading slash and without the query.

    An address with neither slash nor query comes back whole, as no position marks its path.
    """
    text = _without(value, PATH_PREFIXES)
    slash = F.nullif(F.instr(text, "/"), F.lit(0))
    start = F.coalesce(slash, F.instr(text, "?") - 1)
    kept = F.length(text) - start
    return _piece(F.right(text, kept), "?", 1)


def url_param(value: ColumnLike, name: str) -> Column:
    """Value after `name=` up to the next ampersand, NULL if absent or empty.

    The name is looked for as plain text, so a longer name that ends with it matches as well.
    """
    after = _piece(as_column(value), f"{name}=", 2)
    return F.nullif(_piece(after, "&", 1), F.lit(""))
