"""Hard negatives by a vertical scan of columnar blocks of vectors (branch and bound over dimensions).

Rows are packed into blocks that hold one array per dimension with its smallest and largest entry; anchors are
packed into groups.  Every pair of a block and a group is a unit of work.  For an anchor the unit reads the
dimensions in descending order of the anchor's magnitude and adds up what each contributes to the inner product.
What the dimensions not yet read can still add lies between sums of the block's minima and maxima, so each row has
a lower and an upper bound of its score; rows that can no longer be among the answers leave the candidate bitmap.
When all dimensions are read the scores of those that are left are exact.

Two rounds: the first finds the positives of all anchors, the second the negatives in the windows that the
positives' scores open.  A unit returns no more rows an anchor than are asked for, and Spark merges the units.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

BLOCK_ROWS, BLOCK_BYTES, GROUP_ANCHORS = 4096, 8_000_000, 256
FIRST, STEP = 16, 8  # dimensions read before the bounds are looked at, for the first time and then

BLOCK = "ids binary, known binary, labels binary, anchors binary, entries binary, n int, n_anchors int"
HIT = "anchor_block long, anchor_row int, anchor_id long, positive_score long, id long, score long, block long, row int"


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 10,
                   least: int = 30, most: int = 90, block_rows: int = BLOCK_ROWS,
                   group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """For each anchor row and each of its positives the best negatives.

    Each component x counts as floor(scale * x), x as double; a score is the inner product with the anchor, an
    exact whole number.  Higher scores come first, ties by smaller id.  Positives are an anchor's first `positives`
    other rows of its label; negatives of a positive are the first `negatives` rows of other labels with
    least * positive_score <= 100 * score <= most * positive_score.
    Returns anchor_id, positive_id, rank (int, from 1), negative_id, positive_score, negative_score.

    Nulls: rows with a null label, a null vector or a null or non-finite component take no part; a row without an
    id can be a positive or a negative (after all others of its score), and is an anchor where `anchors` says so.
    Repeated rows are rows of their own: each is an anchor, and a positive of its twin.  Rows that agree in score
    and id stand in for one another.  A vector shorter than others has zeros at its end, an empty one scores 0.
    Scores that could pass 64 bits are an error.  Empty tables give no rows; other columns are not read.
    """
    vector, label = F.col(_q(vector_col)), F.col(_q(label_col)).cast("long")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(_q(id_col)).cast("long").alias("id"), label.alias("label"),
                          vector.cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
                          finite.alias("finite"))
    rows = rows.filter("label IS NOT NULL AND vector IS NOT NULL AND finite").drop("finite")
    n, dims = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    dims = dims or 0
    block_rows = max(1, min(block_rows, BLOCK_BYTES // (8 * max(1, dims))))

    def pack(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, block_rows):
                yield _packed(batch.slice(i, block_rows), dims, scale)

    # A little fewer than fit, for rows are dealt out evenly but not exactly so.
    blocks = rows.repartition(max(1, math.ceil(n / (0.95 * block_rows)))).mapInArrow(pack, BLOCK)
    blocks = stored(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    n_groups = max(1, math.ceil((blocks.agg(F.sum("n_anchors")).first()[0] or 0) / group_anchors))

    def pick(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                block = _Block(batch.slice(k, 1).to_pylist()[0], dims)
                at = np.flatnonzero(block.anchors)
                entries = np.ascontiguousarray(block.entries[:, at].T)
                yield pa.RecordBatch.from_pydict({
                    "anchor_block": pa.array(np.full(len(at), block.number)), "anchor_row": pa.array(at, pa.int32()),
                    "anchor_id": pa.array(block.ids[at], mask=~block.known[at]), "label": pa.array(block.labels[at]),
                    "entries": pa.array([x.tobytes() for x in entries], pa.binary())})

    chosen = blocks.filter("n_anchors > 0").mapInArrow(
        pick, "anchor_block long, anchor_row int, anchor_id long, label long, entries binary")
    chosen = stored(chosen.withColumn("group", F.pmod(F.xxhash64("anchor_block", "anchor_row"), F.lit(n_groups)).cast("int")),
                    "anchors")
    grid = blocks.select((F.col("block") + 0).alias("at"), F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("group"))
    by_unit = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).groupBy("block", "group")

    def units(asked: DataFrame, search) -> DataFrame:
        """The answers of all units; `asked` has the anchors, with what is asked of them in `scores`."""
        def unit(left: pa.Table, right: pa.Table) -> pa.Table:
            out = {name: [] for name in _HITS.names}
            if left.num_rows and right.num_rows:
                block = _Block(left.to_pylist()[0], dims)
                for anchor in right.to_pylist():
                    search(block, anchor, out)
            return pa.table({name: pa.array(values, _HITS.field(name).type) for name, values in out.items()})

        return by_unit.cogroup(asked.join(grid, "group").groupBy("at", "group")).applyInArrow(unit, HIT)

    def add(out, block, anchor, positive_score, at, scores):
        for i, score in zip(at.tolist(), scores.tolist()):
            for name, value in zip(_HITS.names, (
                    anchor["anchor_block"], anchor["anchor_row"], anchor["anchor_id"], positive_score,
                    int(block.ids[i]) if block.known[i] else None, int(score), block.number, i)):
                out[name].append(value)

    def search_positives(block, anchor, out):
        mask = block.labels == anchor["label"]
        if anchor["anchor_block"] == block.number:
            mask[anchor["anchor_row"]] = False
        at, scores = _scan(block, anchor, mask, [(-math.inf, math.inf)], positives)
        at, scores = block.best(at, scores, positives)
        add(out, block, anchor, 0, at, scores)

    def search_negatives(block, anchor, out):
        windows = {p: (-((-least * p) // 100), (most * p) // 100) for p in sorted(set(anchor["scores"]))}
        windows = {p: w for p, w in windows.items() if w[0] <= w[1]}
        if windows:
            at, scores = _scan(block, anchor, block.labels != anchor["label"], list(windows.values()), negatives)
            for p, (low, high) in windows.items():
                fits = (scores >= low) & (scores <= high)
                add(out, block, anchor, p, *block.best(at[fits], scores[fits], negatives))

    anchor = ["anchor_block", "anchor_row"]
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), "block", "row"]
    near = units(chosen, search_positives)
    near = near.withColumn("place", F.row_number().over(Window.partitionBy(*anchor).orderBy(*order)))
    near = stored(near.filter(F.col("place") <= positives).select(
        *anchor, "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = near.groupBy(*anchor).agg(F.collect_set("positive_score").alias("scores"))
    far = units(chosen.join(scores, anchor), search_negatives)
    of = Window.partitionBy(*anchor, "positive_score").orderBy(*order)
    far = far.withColumn("rank", F.row_number().over(of)).filter(F.col("rank") <= negatives)
    return near.join(far, [*anchor, "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_HITS = pa.schema([("anchor_block", pa.int64()), ("anchor_row", pa.int32()), ("anchor_id", pa.int64()),
                   ("positive_score", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("block", pa.int64()),
                   ("row", pa.int32())])


def _packed(batch: pa.RecordBatch, dims: int, scale: int) -> pa.RecordBatch:
    """Rows as one record: ids, labels, and the whole-number entries dimension by dimension."""
    vectors = batch.column("vector")
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(pc.list_flatten(vectors).to_numpy(zero_copy_only=False) * float(scale))
    if flat.size and np.abs(flat).max() >= 2.0**62:
        raise ValueError("a component times the scale passes 62 bits")
    entries = np.zeros((dims, batch.num_rows), dtype=np.int64)
    row = np.repeat(np.arange(batch.num_rows), sizes)
    entries[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), row] = flat.astype(np.int64)
    ids, anchors = batch.column("id"), batch.column("anchor").to_numpy(zero_copy_only=False).astype(np.uint8)
    return pa.RecordBatch.from_pydict({
        "ids": [ids.fill_null(0).to_numpy().tobytes()], "known": [ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()],
        "labels": [batch.column("label").to_numpy().tobytes()], "anchors": [anchors.tobytes()],
        "entries": [entries.tobytes()], "n": pa.array([batch.num_rows], pa.int32()),
        "n_anchors": pa.array([int(anchors.sum())], pa.int32())})


class _Block:
    """A packed block: arrays of ids and labels, and `entries` with one row per dimension."""

    def __init__(self, record: dict, dims: int):
        self.number, n = record["block"], record["n"]
        self.ids, self.labels = (np.frombuffer(record[c], np.int64) for c in ("ids", "labels"))
        self.known, self.anchors = (np.frombuffer(record[c], np.uint8).astype(bool) for c in ("known", "anchors"))
        self.entries = np.frombuffer(record["entries"], np.int64).reshape(dims, n)
        self.lows, self.highs = (self.entries.min(axis=1), self.entries.max(axis=1)) if n and dims else (np.zeros(dims, np.int64),) * 2
        self.largest = max((abs(int(x)) for x in (*self.lows, *self.highs)), default=0)
        self._floats = None

    def columns(self, exact: bool) -> np.ndarray:
        """The entries; as doubles (faster) where all sums are whole numbers that doubles hold."""
        if not exact:
            return self.entries
        if self._floats is None:
            self._floats = self.entries.astype(np.float64)
        return self._floats

    def best(self, at: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first n of some rows, by score, then id (null last)."""
        order = np.lexsort((at, self.ids[at], ~self.known[at], -scores))[:n]
        return at[order], scores[order]


def _scan(block: _Block, anchor: dict, mask: np.ndarray, windows: list[tuple], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of all rows of the bitmap that can be among the first n of a window of scores."""
    query = np.frombuffer(anchor["entries"], np.int64)
    bound = sum(abs(int(q)) * block.largest for q in query)
    if bound >= 2**63:
        raise ValueError("an inner product may pass 64 bits")
    exact = bound < 2**53
    query = query.astype(np.float64) if exact else query
    columns = block.columns(exact)
    order = np.argsort(-np.abs(query), kind="stable")
    sides = np.stack([query * block.lows, query * block.highs])[:, order]
    rest = np.concatenate([np.cumsum(side[::-1])[::-1] for side in (sides.min(axis=0), sides.max(axis=0))]).reshape(2, -1)
    rest = np.concatenate([rest, np.zeros((2, 1), rest.dtype)], axis=1)
    at = np.flatnonzero(mask)
    partial = np.zeros(len(at), dtype=query.dtype)
    whole = len(at) == len(mask)
    read = 0
    while read < len(order) and len(at):
        step = order[read:read + (STEP if read else FIRST)]
        chosen = columns[step] if whole else columns[step[:, None], at]
        partial += query[step] @ chosen
        read += len(step)
        keep = _possible(partial + rest[0, read], partial + rest[1, read], windows, n)
        if not keep.all():
            at, partial, whole = at[keep], partial[keep], False
    if not len(order):
        keep = _possible(partial, partial, windows, n)
        at, partial = at[keep], partial[keep]
    return at, partial.astype(np.int64)


def _possible(lower: np.ndarray, upper: np.ndarray, windows: list[tuple], n: int) -> np.ndarray:
    """Which rows can be among the first n of any window, given bounds of their scores.

    A row leaves a window if it lies outside for certain, or if n rows that are inside for certain surpass it.
    """
    keep = np.zeros(len(lower), dtype=bool)
    for low, high in windows:
        inside = (upper >= low) & (lower <= high)
        certain = lower[(lower >= low) & (upper <= high)]
        if len(certain) >= n:
            inside &= upper >= np.partition(certain, len(certain) - n)[len(certain) - n]
        keep |= inside
    return keep
