"""Suffix-array dedup: byte strings of a given length that occur more than once, in all their places.

1. Every window of 400 bytes picks an anchor, the smallest hash among the 32 byte runs in it, so that
   equal windows pick the same anchor at the same place (about one byte in 185 is an anchor).  The bytes
   of all windows that pick an anchor are its surroundings.  Anchors that occur once in the corpus cannot
   lie in a repeat.  Anchors whose surroundings are equal as a whole are settled at once, and one of them
   stands for all from here on.
2. What is left are the edges of shared passages.  Each shard (a chunk of documents) builds the suffix
   array of these stretches by Larsson-Sadakane refinement and their common prefixes by Kasai's walk;
   entries that share at least 400 bytes are one class.
3. Shards are merged by binary search: each sends the sorted hashes of its classes, and a part of the
   hash space merges the sorted runs of all shards and tells them which classes others have, too.

A shard sends each anchor, surrounding and class once, however often it holds it, so no passage is hot.
Hashes have 64 bits; classes are compared inside one part of the hash space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import chunks
from tidemark.llm.arrays import RangeHashes, byte_values, list_array, mix, ranges, runs, text_bytes, winnow
from tidemark.llm.suffixes import common_prefixes, merge, suffix_array

WINDOW = 400  # bytes of a repeat
CHUNK_BYTES = 2_000_000
GRAM = 32
COVERED, STANDS = 1, 2


class _Anchors:
    """The windows of a chunk in groups that pick the same anchor: window starts low..high, hash, surroundings."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, window: int):
        gram = min(GRAM, window)
        grams = runs(byte_values(buf), gram)
        place = winnow(grams, window - gram + 1)
        valid = np.zeros(len(place) + 1, dtype=np.int8)
        sizes = np.diff(offsets)
        full = sizes >= window
        np.add.at(valid, offsets[:-1][full], 1)
        np.add.at(valid, offsets[1:][full] - window + 1, -1)
        starts = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
        place = place[starts]
        head = np.flatnonzero(np.append([True], place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        self.low = starts[head]
        self.high = starts[np.append(head[1:], len(starts)) - 1] if len(head) else self.low
        place = place[head]
        self.seed = grams[place]
        self.hashes = RangeHashes(buf)
        shape = ((place - self.low) << 32 | (self.high - self.low)).astype(np.uint64)
        self.around = mix(self.hashes(self.low, self.high + window) + mix(shape + np.uint64(1)))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Removes each byte covered by a string of `window` bytes that also starts anywhere else.

    Texts are UTF-8 bytes; matches never cross documents; all places of a repeated string go.  Returns
    doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes, binary, for a cut may split a
    character) and removed (maximal runs [begin, end) of bytes), one row per row of `docs`; no other
    columns are read.

    Nulls: a null text has no bytes; rows with null ids are documents like others.  Repeated rows are
    separate documents, so their texts repeat each other.  Empty tables give no rows.  Texts are never cut.
    """
    dealt, n = chunks.deal_out(docs, id_col, text_col, chunk_bytes)
    parts = max(1, n // 4)

    def read(table: pa.Table):
        table = chunks.in_order(table)
        buf, offsets = text_bytes(table.column("text"))
        return buf, _Anchors(buf, offsets, window)

    def seeds(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        _, anchors = read(table)
        order = np.lexsort((anchors.around, anchors.seed))
        seed, around = anchors.seed[order], anchors.around[order]
        first = np.append([True], (seed[1:] != seed[:-1]) | (around[1:] != around[:-1]))[:len(seed)]
        again = np.append(~first[1:], False)[:len(seed)]
        rows = chunks.sent(chunk, parts, seed[first], around[first], again[first].astype(np.uint8))
        return pa.table(rows, schema=_schema("part", "chunk", "hashes", "more0", "more1"))

    def compare(table: pa.Table) -> pa.Table:
        seed, chunk = chunks.unpacked(table.column("hashes"), np.uint64), chunks.senders(table)
        around = chunks.unpacked(table.column("more0"), np.uint64)
        order = np.lexsort((chunk, around, seed))
        seed, around, chunk = seed[order], around[order], chunk[order]
        again = chunks.unpacked(table.column("more1"), np.uint8)[order]
        if not len(seed):
            return _schema("chunk", "more0", "more1").empty_table()
        new_seed = np.append([True], seed[1:] != seed[:-1])
        new = new_seed | np.append([True], around[1:] != around[:-1])
        kind = np.cumsum(new) - 1
        entries = np.bincount(kind) + np.bincount(kind, weights=again)
        kinds = np.bincount((np.cumsum(new_seed) - 1), weights=new)[np.cumsum(new_seed) - 1]
        code = COVERED * (entries[kind] > 1) + STANDS * ((kinds > 1) & new)
        some = code > 0
        return pa.table(chunks.answers(chunk[some], around[some], code[some].astype(np.uint8)),
                        schema=_schema("chunk", "more0", "more1"))

    def shard(table: pa.Table, found: pa.Table) -> pa.Table:
        schema = _schema("part", "chunk", "hashes", "more0", "done")
        if not table.num_rows:
            return schema.empty_table()
        chunk = table.column("chunk")[0].as_py()
        buf, anchors = read(table)
        around, code = (chunks.unpacked(found.column(c), t) for c, t in (("more0", np.uint64), ("more1", np.uint8)))
        if not len(around):
            return schema.empty_table()
        order = np.argsort(around)
        around, code = around[order], code[order]
        at = np.minimum(np.searchsorted(around, anchors.around), len(around) - 1)
        code = np.where(around[at] == anchors.around, code[at], 0)
        settled = (code & COVERED) > 0
        done = [anchors.low[settled], anchors.high[settled] + window]
        stands = np.flatnonzero(code & STANDS)
        _, once = np.unique(anchors.around[stands], return_index=True)
        stands = np.sort(stands[once])
        starts = _expand(anchors.low[stands], anchors.high[stands] + 1)
        hashes, place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        if len(starts):
            begin, end = ranges(starts, window)
            # Stretches follow one another without a mark: a wanted window never reaches past its own.
            text = buf[_expand(begin, end)]
            shift = begin - np.concatenate([[0], np.cumsum(end - begin)[:-1]])
            owner = np.searchsorted(begin, starts, "right") - 1
            wanted = np.zeros(len(text), dtype=bool)
            wanted[starts - shift[owner]] = True
            suffixes = suffix_array(text)
            shares = common_prefixes(text, suffixes, window)
            group = np.cumsum(shares < window)
            mine = wanted[suffixes]
            entry = np.flatnonzero(mine)
            group, local = group[entry], suffixes[entry]
            global_start = local + shift[np.searchsorted(np.cumsum(end - begin), local, "right")]
            size = np.bincount(group)[group]
            repeated = np.sort(global_start[size > 1])
            done = [np.concatenate([a, b]) for a, b in zip(done, ranges(repeated, window))]
            first = np.append([True], group[1:] != group[:-1])[:len(group)]
            value = anchors.hashes(global_start[first], global_start[first] + window)
            by = np.argsort(value, kind="stable")
            hashes = value[by]
            place = np.where(size[first] > 1, -1, global_start[first])[by].astype(np.int32)
        packed = np.stack(done, axis=1).astype(np.int32).tobytes()
        rows = chunks.sent(chunk, parts, hashes, place) | {"done": []}
        rows["done"] = [None] * len(rows["part"])
        for column, value in zip(("part", "chunk", "hashes", "more0", "done"), (chunk % parts, chunk, b"", b"", packed)):
            rows[column].append(value)
        return pa.table(rows, schema=schema)

    def join_shards(table: pa.Table) -> pa.Table:
        runs_of = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        values, several = merge([run for run in runs_of if len(run)])
        rows: dict[str, list] = {"chunk": [], "more0": []}
        for chunk, run, place, done in zip(table.column("chunk").to_pylist(), runs_of, table.column("more0").to_pylist(),
                                           table.column("done").to_pylist()):
            if len(run):
                place = np.frombuffer(place, np.int32)
                place = np.sort(place[several[np.searchsorted(values, run)] & (place >= 0)]).astype(np.int64)
                if len(place):
                    rows["chunk"].append(chunk)
                    rows["more0"].append(np.stack(ranges(place, window), axis=1).astype(np.int32).tobytes())
            if done:
                rows["chunk"].append(chunk)
                rows["more0"].append(done)
        return pa.table(rows, schema=_schema("chunk", "more0"))

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return RESULT.empty_table()
        table = chunks.in_order(table)
        buf, offsets = text_bytes(table.column("text"))
        spans = chunks.unpacked(found.column("more0"), np.int32).reshape(-1, 2).astype(np.int64)
        change = np.zeros(len(buf) + 1, dtype=np.int32)
        np.add.at(change, spans[:, 0], 1)
        np.add.at(change, spans[:, 1], -1)
        gone = np.cumsum(change[:-1]) > 0
        edge = np.zeros(len(buf) + 1, dtype=bool)
        edge[1:-1] = gone[1:] != gone[:-1]
        edge[offsets] = True
        at = np.flatnonzero(edge)
        begin, end = at[:-1], at[1:]
        begin, end = begin[gone[begin]], end[gone[begin]]
        text = np.searchsorted(offsets, begin, "right") - 1
        size = np.diff(offsets)
        removed = np.bincount(text, weights=end - begin, minlength=len(size)).astype(np.int64)
        n_spans = np.bincount(text, minlength=len(size))
        local = [pa.array(x - offsets[text]) for x in (begin, end)]
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(
            np.concatenate([[0], np.cumsum(size - removed)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf[~gone]))])
        return pa.table({"doc_id": table.column("doc_id"), "n_bytes": size, "n_removed": removed, "n_spans": n_spans,
                         "kept": kept.cast(pa.binary()),
                         "removed": list_array(n_spans, pa.StructArray.from_arrays(local, ["begin", "end"]))}).cast(RESULT)

    asked = dealt.groupBy("chunk").applyInArrow(seeds, _sql("part", "chunk", "hashes", "more0", "more1"))
    found = asked.groupBy("part").applyInArrow(compare, _sql("chunk", "more0", "more1"))
    asked = dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        shard, _sql("part", "chunk", "hashes", "more0", "done"))
    found = asked.groupBy("part").applyInArrow(join_shards, _sql("chunk", "more0"))
    return dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, removed array<struct<begin:long,end:long>>")


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                    ("kept", pa.binary()), ("removed", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])


def _schema(*names: str) -> pa.Schema:
    return pa.schema([(x, pa.int32() if x in ("part", "chunk") else pa.binary()) for x in names])


def _sql(*names: str) -> str:
    return ", ".join(f"{x} {'int' if x in ('part', 'chunk') else 'binary'}" for x in names)


def _expand(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after another."""
    size = end - begin
    stop = np.cumsum(size)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(begin - (stop - size), size)

