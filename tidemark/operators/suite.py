"""Several checks of one table in one scan, and equality of large tables by digests.

A suite puts the checks of a table together: each asks for a set of key columns and some aggregates, all sets are
grouped in one aggregation (grouping sets, combined in the tasks before they are shuffled), and every group is then
judged by the checks that asked for its set.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.common import ColumnLike, as_column, names, quoted
from tidemark.operators.checks import equality
from tidemark.operators.skew import hashable

_REAL = "_real"  # false for the one row that is added, so that a table without rows has its one whole-table group


@dataclass(frozen=True)
class Check:
    """One check of a suite.

    keys      columns whose groups are judged; none for the whole table
    measures  aggregates by name
    fails     condition on a group, in terms of its keys and measures
    records   the number of rows a failure stands for, likewise
    """

    name: str
    keys: tuple[str, ...]
    measures: dict[str, Column]
    fails: Column
    records: Column


def _n() -> Column:
    return F.count_if(F.col(_REAL))


def failing_rows(name: str, condition: Column) -> Check:
    """Rows for which a condition holds, as one failure with their number."""
    n = F.count_if(F.col(_REAL) & condition)
    return Check(name, (), {f"{name} n": n}, quoted(f"{name} n") > 0, quoted(f"{name} n"))


def not_null(column: str, name: str | None = None) -> Check:
    return failing_rows(name or f"not_null {column}", quoted(column).isNull())


def not_empty_string(column: str, trim: bool = True, name: str | None = None) -> Check:
    return failing_rows(name or f"not_empty_string {column}", (F.trim(quoted(column)) if trim else quoted(column)) == "")


def accepted_range(column: ColumnLike, low=None, high=None, inclusive: bool = True, name: str | None = None) -> Check:
    value, outside = as_column(column), F.lit(False)
    if low is not None:
        outside = outside | ~(value >= low if inclusive else value > low)
    if high is not None:
        outside = outside | ~(value <= high if inclusive else value < high)
    return failing_rows(name or f"accepted_range {column}", outside)


def expression_is_true(expression: str | Column, name: str | None = None) -> Check:
    condition = expression if isinstance(expression, Column) else F.expr(expression)
    return failing_rows(name or f"expression_is_true {expression}", ~condition)


def assert_equal(actual: ColumnLike, expected: ColumnLike, name: str | None = None) -> Check:
    return failing_rows(name or f"assert_equal {actual} {expected}", as_column(actual) != as_column(expected))


def _grouped(name: str, keys: Iterable[str], fails: Column, **measures: Column) -> Check:
    return Check(name, tuple(keys), {f"{name} {k}": m for k, m in ({"rows": _n()} | measures).items()}, fails, quoted(f"{name} rows"))


def unique(column: str, name: str | None = None) -> Check:
    name = name or f"unique {column}"
    return _grouped(name, (column,), quoted(column).isNotNull() & (quoted(f"{name} rows") > 1))


def unique_combination_of_columns(columns: list[str], name: str | None = None) -> Check:
    name = name or f"unique_combination {' '.join(columns)}"
    return _grouped(name, columns, quoted(f"{name} rows") > 1)


def accepted_values(column: str, values: Iterable, name: str | None = None) -> Check:
    return _grouped(name or f"accepted_values {column}", (column,), ~quoted(column).isin(*values))


def not_accepted_values(column: str, values: Iterable, name: str | None = None) -> Check:
    return _grouped(name or f"not_accepted_values {column}", (column,), quoted(column).isin(*values))


def at_least_one(column: str, group_by: str | list[str] | None = None, name: str | None = None) -> Check:
    name = name or f"at_least_one {column}"
    return _grouped(name, names(group_by), quoted(f"{name} known") == 0, known=F.count(quoted(column)))


def not_constant(column: str, group_by: str | list[str] | None = None, name: str | None = None) -> Check:
    name = name or f"not_constant {column}"
    return _grouped(name, names(group_by), quoted(f"{name} low") == quoted(f"{name} high"),
                    low=F.min(quoted(column)), high=F.max(quoted(column)))


def not_null_proportion(column: str, at_least: float, at_most: float = 1.0, group_by: str | list[str] | None = None,
                        name: str | None = None) -> Check:
    name = name or f"not_null_proportion {column}"
    share = quoted(f"{name} known") / F.nullif(quoted(f"{name} rows"), F.lit(0))
    return _grouped(name, names(group_by), (share < at_least) | (share > at_most), known=F.count(quoted(column)))


def recency(column: str, part: str, interval: int, now, group_by: str | list[str] | None = None, name: str | None = None) -> Check:
    name = name or f"recency {column}"
    unit = {"quarter": ("MONTH", 3)}.get(part, (part.upper(), 1))
    limit = (now if isinstance(now, Column) else F.lit(str(now))).cast("timestamp") - F.expr(f"INTERVAL {int(interval) * unit[1]} {unit[0]}")
    return _grouped(name, names(group_by), quoted(f"{name} last").cast("timestamp") < limit, last=F.max(quoted(column)))


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(check, key, n_records): the failures of all checks, out of one scan of the table.

    A check of rows fails at most once, with the number of its rows and no key; a check of groups or values fails
    once for each of them, with its key columns as text (NULL written so) and the number of its rows.
    """
    if len({c.name for c in checks}) < len(checks):
        raise ValueError("two checks of a suite have the same name")
    sets = list(dict.fromkeys(c.keys for c in checks))
    columns = list(dict.fromkeys(k for s in sets for k in s))
    none = df.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields], F.lit(False).alias(_REAL))
    rows = df.withColumn(_REAL, F.lit(True)).unionAll(none)
    measures = [m.alias(n) for c in checks for n, m in c.measures.items()]
    marks = {s: sum(1 << (len(columns) - 1 - i) for i, k in enumerate(columns) if k not in s) for s in sets}
    if columns:
        groups = rows.groupingSets([[quoted(k) for k in s] for s in sets], *[quoted(k) for k in columns]).agg(
            F.grouping_id().alias("_set"), _n().alias("_n"), *measures)
    else:
        groups = rows.agg(F.lit(0).alias("_set"), _n().alias("_n"), *measures)

    def failure(c: Check) -> Column:
        applies = (F.col("_set") == marks[c.keys]) & ((F.col("_n") > 0) if c.keys else F.lit(True))
        key = F.concat_ws(", ", *[F.coalesce(quoted(k).cast("string"), F.lit("NULL")) for k in c.keys]) if c.keys else F.lit(None).cast("string")
        return F.struct((applies & F.coalesce(c.fails, F.lit(False))).alias("fails"), F.lit(c.name).alias("check"), key.alias("key"),
                        c.records.cast("bigint").alias("n_records"))

    failures = F.filter(F.array(*[failure(c) for c in checks]), lambda f: f["fails"])
    return groups.select(F.explode(failures).alias("f")).select("f.check", "f.key", "f.n_records")


# -- equality of large tables -------------------------------------------------------------------

RANGES = 4096  # hash ranges a round splits each unequal range into


def differing_rows(df: DataFrame, other: DataFrame, columns: list[str], rounds: int = 2, ranges: int = RANGES) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables that lie in hash ranges whose digests differ.

    A digest is the number of a range's rows and the sums of two hashes of them, which do not depend on the order.
    Each round reads both tables, shuffles one row per task and range, and splits the ranges that differ into
    `ranges` finer ones; ranges with equal digests are never shuffled.
    """
    if not all(hashable(df.schema[c].dataType) for c in columns):
        raise ValueError("columns with maps have no hash")
    picked = [quoted(c) for c in columns]
    # Hashes pass over NULLs, so where they stand is hashed too.
    parts = [x for c in picked for x in (c, c.isNull())]
    sides = [side.select(*picked).withColumn("_a", F.xxhash64(*parts)).withColumn("_b", F.xxhash64(F.lit(1), *parts)) for side in (df, other)]
    unequal = None
    for k in range(1, rounds + 1):
        range_ = F.pmod("_a", F.lit(ranges**k)).alias("_range")
        digest = F.struct(F.count(F.lit(1)), *[F.sum(F.col(h).cast("decimal(20,0)")) for h in ("_a", "_b")])
        mine, theirs = (rows.groupBy(range_).agg(digest.alias(name)) for rows, name in zip(sides, ("mine", "theirs")))
        unequal = mine.join(theirs, "_range", "full").filter(~F.col("mine").eqNullSafe(F.col("theirs"))).select("_range")
        if k < rounds:
            coarse = F.pmod("_a", F.lit(ranges**k)).alias("_range")
            sides = [rows.select(*picked, "_a", "_b", coarse).join(unequal, "_range", "left_semi") for rows in sides]
    last = F.pmod("_a", F.lit(ranges**rounds))
    kept = [rows.withColumn("_range", last).join(unequal, "_range", "left_semi").select(*picked) for rows in sides]
    return kept[0], kept[1]


def equality_by_digest(df: DataFrame, other: DataFrame, columns: list[str] | None = None, rounds: int = 2,
                       ranges: int = RANGES) -> DataFrame:
    """As `equality`: distinct rows that only one table has; only rows of ranges that differ are compared.

    For large tables that are expected to agree but for few rows.  Rows that occur a different number of times
    make their range differ, and are then found equal.
    """
    columns = columns or df.columns
    return equality(*differing_rows(df, other, columns, rounds, ranges), columns)
