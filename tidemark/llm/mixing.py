"""Mixing sources to target weights by capped water-filling.

Targets start as shares of the whole by weight.  A source whose target is above its cap (the size of so many
epochs) is clamped to it, and the excess goes to the others in proportion to their weights, until no target
is above.  A document is repeated as often as its source's target fits whole times into its size, and the
rest is a seeded sample: within groups of some thousand documents of a source, in the order of a hash,
documents are taken once more until the fraction is reached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import _q
from tidemark.llm.storage import stored

SHARE = 1.5  # of all sizes that the mix takes
EPOCHS = 2.0  # times a source may be taken
GROUP = 4096  # documents of a source that are sampled together, on average


def source_sizes(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, source_size, n_docs, rank), stored: words `[^\\x20\\x09-\\x0D]+` and documents of each source,
    and its place by code point, null last, counted from 0.

    Sources are numbered in ranges: each task numbers its own, and the tasks' counts are added up.
    """
    size = F.coalesce(F.regexp_count(F.col(_q(text_col)).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sums = docs.groupBy(F.col(_q(source_col)).cast("string").alias("source")).agg(
        F.sum(size).alias("source_size"), F.count("*").alias("n_docs"))
    order = [F.col("source").isNull(), F.col("source")]
    ranged = stored(sums.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()),
                    "mix-sources")
    task, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before, total = F.lit(0).cast("long"), 0
    for row in ranged.groupBy(task.alias("task")).count().orderBy("task").collect():  # one row per task
        before = F.when(task >= row["task"], F.lit(total).cast("long")).otherwise(before)
        total += row["count"]
    return ranged.select("source", "source_size", "n_docs", (before + place).alias("rank"))


def water_fill(sources: DataFrame, share: float = SHARE, epochs: float = EPOCHS) -> DataFrame:
    """Adds `target` to (source, source_size, weight, ...): the share of all sizes, split by weight under the caps.

    Each round is one aggregation; it ends when no further source is clamped, after at most as many rounds as
    there are sources, in practice a few.  If all are clamped, the mix is smaller than the share.
    """
    cap = epochs * F.col("source_size")
    total = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = None, -1
    while True:
        over = F.lit(False) if level is None else level * F.col("weight") >= cap
        row = sources.agg(F.sum(F.when(over, cap).otherwise(0.0)).alias("taken"), F.sum(F.when(~over, F.col("weight")).otherwise(0)).alias("weight"),
                          F.count_if(over).alias("n")).first()
        if row["n"] == clamped or not row["weight"]:
            break
        clamped, level = row["n"], F.lit((total - row["taken"]) / float(row["weight"]))
    target = cap if level is None else F.least(cap, level * F.col("weight"))
    return sources.withColumn("target", target.cast("double"))


def mix_sources(docs: DataFrame, weights=None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                share: float = SHARE, epochs: float = EPOCHS, seed: int = 0, group: int = GROUP, carry: bool = False) -> DataFrame:
    """doc_id, size (words), source_size, target (of its source) and copies (times the mix takes it), one row per
    row of `docs`; with `carry` also the whole input row as the struct `row`.

    `weights` turns the rank of a source (by code point, null last) into its weight; by default 3, 1, 2, and
    so on again.  copies is at most `epochs`, and copies * size sums up to about the target of each source.
    Reruns agree: the order of the sample is a hash of the seed, the id and the text.

    Nulls: a null text has no words, null sources are one source, null ids are documents like others.
    Repeated rows are sampled each; among equal ones any may be the one that is taken.  Sources without
    words have target 0.  Empty tables give no rows.
    """
    weights = weights or (lambda rank: F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)), (rank % 3 + 1).cast("int")))
    sources = source_sizes(docs, source_col, text_col)
    sources = water_fill(sources.withColumn("weight", weights(F.col("rank"))), share, epochs)
    sources = sources.select(F.col("source").alias("of"), "source_size", "n_docs", "target")
    text = F.col(_q(text_col)).cast("string")
    rows = docs.select(
        F.col(_q(id_col)).cast("long").alias("doc_id"), F.col(_q(source_col)).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(_q(id_col)).cast("long"), text).alias("dice"), *([F.struct("*").alias("row")] if carry else []))
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(times)
    # Groups keep a large source from being sorted in one task.
    rows = rows.withColumn("group", F.pmod(F.xxhash64("dice"), F.ceil(F.col("n_docs") / group)))
    each = Window.partitionBy("source", "group")
    along = each.orderBy("dice", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.sum("size").over(along) - F.col("size") / 2
    more = (reached < (times - whole) * F.sum("size").over(each)).cast("int")
    return rows.select("doc_id", "size", "source_size", "target", (whole.cast("int") + more).alias("copies"), *(["row"] if carry else []))
