"""Line dedup: lines that many documents share stay in one document only.

Chunks of documents send each line's hash once, with the number of documents that hold it and the largest id;
shards of the hash space add these up and build a minimal perfect hash over their distinct hashes, which
indexes a fingerprint, a count and, for lines that go, the id of the document that keeps them.  The shards are
a table in the shared folder.  Documents then probe: a chunk sends its hashes, packed, to the shards that own
them, and gets back which lines go.  Lines themselves are never shuffled beside their texts nor joined, and a
line that a third of all documents hold is one entry per chunk.

A line is known by 96 bits of its hash (64 for the slot, 32 as fingerprint); equal bits are taken for equal lines.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chunks
from tidemark.llm.arrays import LOWER, NOT_SPACE, U64, gather_bytes, text_bytes, texts_of
from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.storage import stored

LEAST_CHARS, LEAST_DOCS = 20, 3
CHUNKS_PER_SHARD = 8  # a chunk's hashes are a small part of its bytes
MANY = 255  # counts are kept in one byte
NO_ID = np.int64(np.iinfo(np.int64).min)  # the largest id of a line that only rows without an id hold


class _Lines:
    """The lines of some texts: bytes [start, end), text number, and number of the key (-1: not to be judged)."""

    def __init__(self, table: pa.Table, least_chars: int):
        self.buf, self.offsets = text_bytes(table.column("text"))
        breaks = np.flatnonzero(self.buf == 0x0A)
        texts = np.arange(table.num_rows)
        self.start = np.concatenate([self.offsets[:-1], breaks + 1])
        self.text = np.concatenate([texts, np.searchsorted(self.offsets, breaks, "right") - 1])
        order = np.lexsort((self.start, self.text))
        self.start, self.text = self.start[order], self.text[order]
        last = np.append(self.text[1:] != self.text[:-1], [True])[:len(self.text)]
        self.end = np.where(last, self.offsets[self.text + 1], np.append(self.start[1:], 0) - 1)
        solid = np.flatnonzero(NOT_SPACE[self.buf])
        low, high = np.searchsorted(solid, self.start), np.searchsorted(solid, self.end)
        some = high > low
        begin = np.where(some, solid[np.minimum(low, len(solid) - 1)], self.start) if len(solid) else self.start
        end = np.where(some, solid[high - 1] + 1, begin) if len(solid) else begin
        chars = np.concatenate([[0], np.cumsum((self.buf & 0xC0) != 0x80)])
        judged = np.flatnonzero(chars[end] - chars[begin] >= least_chars)
        data, digest = LOWER[self.buf].tobytes(), xxhash.xxh3_128_digest
        digests = b"".join(digest(data[i:j]) for i, j in zip(begin[judged].tolist(), end[judged].tolist()))
        pairs = np.frombuffer(digests, dtype=">u8").reshape(-1, 2).astype(U64)
        keys = np.empty(len(judged), dtype=[("hash", U64), ("mark", np.uint32)])
        keys["hash"], keys["mark"] = pairs[:, 0], (pairs[:, 1] >> U64(32)).astype(np.uint32)
        self.keys, of = np.unique(keys, return_inverse=True)
        self.key = np.full(len(self.start), -1, dtype=np.int64)
        self.key[judged] = of


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
               least_docs: int = LEAST_DOCS, chunk_bytes: int = chunks.CHUNK_BYTES) -> DataFrame:
    """Removes lines that at least `least_docs` documents hold, except from the largest id that holds them.

    Texts are split at \\n.  A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends, A-Z lower-cased; keys
    of fewer than `least_chars` code points are left alone.  In the document that keeps a line all its copies stay.
    Returns doc_id, n_lines, n_dropped, kept_text (the other lines, joined by \\n, unchanged), one row per row of
    `docs`; no other columns are read.

    Nulls: a null text is one empty line, as an empty one is.  Rows without an id are one document together, smaller
    than all others: they keep a line only where no row with an id has it.  Repeated rows: rows of one id are one
    document, counted once; each loses or keeps its lines.  There are no ties.  Empty tables give no rows.  Texts
    are never cut.
    """
    if not 1 <= least_docs <= MANY:
        raise ValueError(f"least_docs must be from 1 to {MANY}")
    dealt, n = chunks.deal_out(docs, id_col, text_col, chunk_bytes)
    parts = max(1, math.ceil(n / CHUNKS_PER_SHARD))

    def read(table: pa.Table) -> tuple[_Lines, np.ndarray, np.ndarray]:
        """The lines, and each text's id and whether it has one."""
        known = table.column("doc_id").is_valid().to_numpy()
        return _Lines(table, least_chars), table.column("doc_id").fill_null(NO_ID).to_numpy(), known

    def tell(table: pa.Table) -> pa.Table:
        lines, ids, known = read(table)
        key, text = lines.key[lines.key >= 0], lines.text[lines.key >= 0]
        held = np.unique(np.stack([key, known[text], ids[text]], axis=1), axis=0) if len(key) else np.zeros((0, 3), np.int64)
        count = np.bincount(held[:, 0], weights=held[:, 1], minlength=len(lines.keys)).astype(np.int64)
        nameless = np.bincount(held[:, 0], weights=1 - held[:, 1], minlength=len(lines.keys)) > 0
        largest = np.full(len(lines.keys), NO_ID)
        np.maximum.at(largest, held[:, 0], held[:, 2])
        return pa.table(chunks.sent(table.column("chunk")[0].as_py(), parts, lines.keys["hash"], lines.keys["mark"],
                                    np.minimum(count, MANY).astype(np.uint8), nameless.astype(np.uint8), largest), schema=TOLD)

    def index(table: pa.Table) -> pa.Table:
        """One shard: counts of all chunks added up, then the perfect hash and its arrays."""
        hashes, marks = (chunks.unpacked(table.column(c), t) for c, t in (("hashes", U64), ("more0", np.uint32)))
        count, nameless = (chunks.unpacked(table.column(c), np.uint8).astype(np.int64) for c in ("more1", "more2"))
        largest = chunks.unpacked(table.column("more3"), np.int64)
        order = np.lexsort((marks, hashes))
        hashes, marks = hashes[order], marks[order]
        first = np.flatnonzero(np.append([True], (hashes[1:] != hashes[:-1]) | (marks[1:] != marks[:-1]))[:len(hashes)])
        count = np.add.reduceat(count[order], first) + (np.add.reduceat(nameless[order], first) > 0)
        largest = np.maximum.reduceat(largest[order], first)
        hashes, marks = hashes[first], marks[first]
        perfect = PerfectHash.build(hashes, marks)
        at = np.empty(len(hashes), dtype=np.int64)
        at[perfect.index(hashes, marks)] = np.arange(len(hashes))
        count = np.minimum(count[at], MANY).astype(np.uint8)
        return pa.table({"part": table.column("part").slice(0, 1), "sizes": [perfect.sizes.tobytes()], "bits": [perfect.bits.tobytes()],
                         "fingerprints": [marks[at].tobytes()], "counts": [count.tobytes()],
                         "keepers": [largest[at][count >= least_docs].tobytes()]}, schema=SHARD)

    def ask(table: pa.Table) -> pa.Table:
        keys = read(table)[0].keys
        return pa.table(chunks.sent(table.column("chunk")[0].as_py(), parts, keys["hash"], keys["mark"]), schema=ASKED)

    def probe(asked: pa.Table, shards: pa.Table) -> pa.Table:
        """Which hashes of each chunk go, and from which document they do not."""
        if not asked.num_rows:
            return ANSWERED.empty_table()
        shard = shards.to_pylist()[0]
        perfect = PerfectHash(np.frombuffer(shard["sizes"], np.int64), np.frombuffer(shard["bits"], np.uint8))
        counts, keepers = np.frombuffer(shard["counts"], np.uint8), np.frombuffer(shard["keepers"], np.int64)
        rank = np.cumsum(counts >= least_docs) - 1
        hashes, marks = chunks.unpacked(asked.column("hashes"), U64), chunks.unpacked(asked.column("more0"), np.uint32)
        at = perfect.index(hashes, marks)
        if (at < 0).any() or (np.frombuffer(shard["fingerprints"], np.uint32)[at] != marks).any():
            raise ValueError("the line index was built from other documents")
        goes = counts[at] >= least_docs
        return pa.table(chunks.answers(chunks.senders(asked)[goes], hashes[goes], marks[goes], keepers[rank[at[goes]]]),
                        schema=ANSWERED)

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return KEPT.empty_table()
        lines, ids, _ = read(table)
        keeper = np.full(len(lines.keys) + 1, NO_ID)
        goes = np.zeros(len(lines.keys) + 1, dtype=bool)  # the last entry is for lines that are not judged
        told = np.empty(sum(len(x) for x in found.column("more1").to_pylist()) // 4, dtype=lines.keys.dtype)
        told["hash"], told["mark"] = chunks.unpacked(found.column("more0"), U64), chunks.unpacked(found.column("more1"), np.uint32)
        at = np.searchsorted(lines.keys, told)
        goes[at], keeper[at] = True, chunks.unpacked(found.column("more2"), np.int64)
        dropped = goes[lines.key] & (keeper[lines.key] != ids[lines.text])
        kept = np.flatnonzero(~dropped)
        text = lines.text[kept]
        again = np.append([False], text[1:] == text[:-1])[:len(text)].astype(np.int64)
        size = np.bincount(text, weights=lines.end[kept] - lines.start[kept] + again, minlength=table.num_rows).astype(np.int64)
        data = gather_bytes(lines.buf, lines.start[kept], lines.end[kept], again, 0x0A)
        return pa.table({"doc_id": table.column("doc_id"), "n_lines": np.bincount(lines.text, minlength=table.num_rows),
                         "n_dropped": np.bincount(lines.text[dropped], minlength=table.num_rows),
                         "kept_text": texts_of(data, size)}).cast(KEPT)

    by_chunk = dealt.groupBy("chunk")
    shards = stored(by_chunk.applyInArrow(tell, _ddl(TOLD)).groupBy("part").applyInArrow(index, _ddl(SHARD)), "lines")
    asked = by_chunk.applyInArrow(ask, _ddl(ASKED))
    found = asked.groupBy("part").cogroup(shards.groupBy("part")).applyInArrow(probe, _ddl(ANSWERED))
    return by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(finish, _ddl(KEPT))


def _schema(**columns: pa.DataType) -> pa.Schema:
    return pa.schema(list(columns.items()))


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


_PACKED = {"part": pa.int32(), "chunk": pa.int32(), "hashes": pa.binary()}
TOLD = _schema(**_PACKED, **{f"more{k}": pa.binary() for k in range(4)})
SHARD = _schema(part=pa.int32(), sizes=pa.binary(), bits=pa.binary(), fingerprints=pa.binary(), counts=pa.binary(), keepers=pa.binary())
ASKED = _schema(**_PACKED, more0=pa.binary())
ANSWERED = _schema(chunk=pa.int32(), more0=pa.binary(), more1=pa.binary(), more2=pa.binary())
KEPT = _schema(doc_id=pa.int64(), n_lines=pa.int64(), n_dropped=pa.int64(), kept_text=pa.string())
