"""Documents dealt out in chunks of bounded size, and questions that chunks ask about their hashes.

The operators on repeats work in rounds.  A chunk computes what it needs over all of its texts with
numpy, merges what occurs in it more than once, and sends its hashes, each once, packed into one binary
value per part of the hash space.  A part looks at the hashes of all chunks and sends answers back.  A
hash that fills a third of the corpus thus costs one entry per chunk, never one per row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrays import part_of

CHUNK_BYTES = 4_000_000


def deal_out(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """(chunk, doc_id, key, text) and the number of chunks.  Rows of one id share a chunk.

    Rows without an id are dealt out by `key`, a hash of their text (null for others), however many they are.
    The number of chunks follows the bytes of all texts, so that a chunk has about `chunk_bytes` at any size of
    the corpus (one text is never cut).
    """
    rows = docs.select(F.col(_q(id_col)).cast("long").alias("doc_id"), F.col(_q(text_col)).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / chunk_bytes))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    chunk = F.pmod(F.coalesce(key, F.xxhash64("doc_id")), F.lit(n)).cast("int")
    return rows.select(chunk.alias("chunk"), "doc_id", key.alias("key"), "text"), n


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def in_order(table: pa.Table) -> pa.Table:
    """Rows by id, then those without an id by key; rows that agree in it by their text (null last)."""
    missing, ids = order_of(table)
    order = np.lexsort((ids, missing))
    if ((np.diff(ids[order]) == 0) & (np.diff(missing[order]) == 0)).any():
        rank = np.empty(table.num_rows, dtype=np.int64)
        rank[pa.compute.sort_indices(table.column("text")).to_numpy()] = np.arange(table.num_rows)
        order = np.lexsort((rank, ids, missing))
    return table.take(pa.array(order))


def order_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """What rows are ordered by: 1 for rows without an id, and the id or the key."""
    ids = pa.compute.coalesce(table.column("doc_id"), table.column("key")).to_numpy()
    return table.column("doc_id").is_null().to_numpy().astype(np.uint8), ids


def sent(chunk: int, parts: int, hashes: np.ndarray, *more: np.ndarray) -> dict[str, list]:
    """One row per part: the hashes (sorted ascending) and further arrays, as bytes."""
    cuts = np.flatnonzero(np.diff(part := part_of(hashes, parts))) + 1
    begins = np.concatenate([[0], cuts]) if len(hashes) else np.zeros(0, np.int64)
    ends = np.append(cuts, len(hashes))
    pieces = list(zip(begins, ends))
    return {"part": [int(part[i]) for i in begins], "chunk": [chunk] * len(pieces),
            "hashes": [hashes[i:j].tobytes() for i, j in pieces]} | {
            f"more{k}": [x[i:j].tobytes() for i, j in pieces] for k, x in enumerate(more)}


def unpacked(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype=dtype)


def senders(table: pa.Table) -> np.ndarray:
    """The chunk of each hash of a part's rows."""
    return np.repeat(table.column("chunk").to_numpy(), [len(x) // 8 for x in table.column("hashes").to_pylist()])


def answers(chunk: np.ndarray, *arrays: np.ndarray) -> dict[str, list]:
    """One row per chunk, from entries for several chunks."""
    order = np.argsort(chunk, kind="stable")
    chunk = chunk[order]
    cuts = np.flatnonzero(np.diff(chunk)) + 1
    begins = np.concatenate([[0], cuts]) if len(chunk) else np.zeros(0, np.int64)
    pieces = list(zip(begins, np.append(cuts, len(chunk))))
    return {"chunk": [int(chunk[i]) for i in begins]} | {
        f"more{k}": [x[order][i:j].tobytes() for i, j in pieces] for k, x in enumerate(arrays)}


SLICE_BYTES = 4_000_000


def slices(batches, column: str, slice_bytes: int = SLICE_BYTES):
    """Cuts Arrow batches into slices with about so many bytes of text (one row at least)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes) // slice_bytes
        begins = np.flatnonzero(np.append([True], piece[1:] != piece[:-1])[:len(piece)])
        for i, j in zip(begins, np.append(begins[1:], len(piece))):
            yield batch.slice(i, j - i)


def carried(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """(doc_id, text), and with `carry` the whole row as the struct `row`, so that no names can clash."""
    columns = [F.col(_q(id_col)).cast("long").alias("doc_id"), F.col(_q(text_col)).cast("string").alias("text")]
    return docs.select(*columns, *([F.struct("*").alias("row")] if carry else []))


def schema_of(ddl: str, rows: DataFrame) -> T.StructType:
    """The columns of `ddl`, and `row` as in `rows` if it is carried."""
    return T.StructType([*T.StructType.fromDDL(ddl).fields, *(f for f in rows.schema.fields if f.name == "row")])
