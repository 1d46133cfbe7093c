"""Substring dedup by seed and extend over word runs.

Seeds are winnowed anchors: among the hashes of the 10 word runs inside each window of 20 words the
smallest is chosen, so that equal windows choose the same anchor at the same place, and about one word in
six is an anchor.  Documents are joined on the anchors; an anchor that occurs once in the corpus cannot
lie in a repeat and goes no further.  Every other anchor is extended to the left and to the right: each
window that chose it is compared, as a hash over all its words, with the equal windows of the whole
corpus, and the first one by (doc_id, start) stays.  Runs of windows that have an earlier equal are
merged, which gives the maximal repeats of at least `window` words.

Chunks and parts exchange packed hashes (see `chunks`); a passage that a third of all documents share is
one entry per chunk.  Window hashes have 64 bits and are compared inside the anchors' part of the hash
space only; equal hashes are taken for equal windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import chunks
from tidemark.llm.arrays import (NOT_SPACE, Words, contains, covered, flag_runs, gather_bytes, list_array, runs,
                                 text_bytes, texts_of, winnow)

WINDOW = 20  # words of a repeat
SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def _windows(words: Words, window: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows that lie in one text, the place of the anchor of each, and the hashes of the anchors' runs."""
    size = (window + 1) // 2
    grams = runs(hashes, size)
    place = winnow(grams, window - size + 1)
    starts = np.flatnonzero(words.left_in_text()[:len(place)] >= window)
    return starts, place[starts], grams


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    chunk_bytes: int = chunks.CHUNK_BYTES) -> DataFrame:
    """Removes each word covered by `window` words whose sequence also starts earlier in the corpus.

    Words are `[^\\x20\\x09-\\x0D]+`.  Earlier means a smaller id, or the same id and an earlier start.
    Returns doc_id, n_words, n_removed, kept_text (kept words joined by one space) and removed (maximal
    runs [begin, end) of word numbers), one row per row of `docs`; no other columns are read.

    Nulls: a null text has no words and gives an empty kept_text; rows without an id come after all others,
    in the order of a hash of their texts.
    Repeated rows: rows of one id are ordered by their text, and count as starts one after another.
    Ties cannot occur otherwise.  Empty tables give no rows.  Texts are never cut.
    """
    dealt, n = chunks.deal_out(docs, id_col, text_col, chunk_bytes)
    parts = max(1, n // 2)

    def read(table: pa.Table) -> tuple[pa.Table, Words]:
        table = chunks.in_order(table)
        return table, Words(*text_bytes(table.column("text")), NOT_SPACE)

    def seeds(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        _, words = read(table)
        _, place, grams = _windows(words, window, words.hashes())
        return pa.table(chunks.sent(chunk, parts, np.unique(grams[place])),
                        schema=pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary())]))

    def shared(table: pa.Table) -> pa.Table:
        hashes, chunk = chunks.unpacked(table.column("hashes"), np.uint64), chunks.senders(table)
        order = np.argsort(hashes, kind="stable")
        hashes, chunk = hashes[order], chunk[order]
        same = hashes[1:] == hashes[:-1]
        many = np.append(same, False) | np.append([False], same)
        return pa.table(chunks.answers(chunk[many], hashes[many]),
                        schema=pa.schema([("chunk", pa.int32()), ("more0", pa.binary())]))

    def extend(table: pa.Table, found: pa.Table) -> pa.Table:
        schema = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary()), ("more0", pa.binary()),
                            ("more1", pa.binary()), ("more2", pa.binary()), ("again", pa.binary())])
        if not table.num_rows:
            return schema.empty_table()
        chunk = table.column("chunk")[0].as_py()
        table, words = read(table)
        hashes = words.hashes()
        starts, place, grams = _windows(words, window, hashes)
        anchor = np.flatnonzero(np.append([True], place[1:] != place[:-1])) if len(place) else place
        seed, times = np.unique(grams[place[anchor]], return_counts=True)
        keep = contains(seed[(times > 1) | contains(np.sort(chunks.unpacked(found.column("more0"), np.uint64)), seed)],
                        grams[place])
        starts = starts[keep]
        value = runs(hashes, window)[starts]
        order = np.argsort(value, kind="stable")  # texts are in order, and so are equal windows
        value, starts = value[order], starts[order]
        first = np.append([True], value[1:] != value[:-1])[:len(value)]
        text = np.searchsorted(words.first, starts[first], "right") - 1
        missing, ids = chunks.order_of(table)
        rows = chunks.sent(chunk, parts, value[first], ids[text], starts[first].astype(np.int32), missing[text])
        again = np.sort(starts[~first]).astype(np.int32)
        if not rows["part"]:
            return schema.empty_table()
        return pa.table(rows | {"again": [again.tobytes(), *[None] * (len(rows["part"]) - 1)]}, schema=schema)

    def earlier(table: pa.Table) -> pa.Table:
        hashes, chunk = chunks.unpacked(table.column("hashes"), np.uint64), chunks.senders(table)
        ids, start = chunks.unpacked(table.column("more0"), np.int64), chunks.unpacked(table.column("more1"), np.int32)
        order = np.lexsort((chunk, ids, chunks.unpacked(table.column("more2"), np.uint8), hashes))
        later = order[1:][hashes[order[1:]] == hashes[order[:-1]]]
        rows = chunks.answers(chunk[later], start[later])
        for c, again in zip(table.column("chunk").to_pylist(), table.column("again").to_pylist()):
            if again:
                rows["chunk"].append(c)
                rows["more0"].append(again)
        return pa.table(rows, schema=pa.schema([("chunk", pa.int32()), ("more0", pa.binary())]))

    def finish(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return RESULT.empty_table()
        table, words = read(table)
        gone = covered(chunks.unpacked(found.column("more0"), np.int32).astype(np.int64), window, len(words))
        text = np.repeat(np.arange(table.num_rows), np.diff(words.first))
        kept, owner = np.flatnonzero(~gone), text[~gone]
        space = np.append([False], owner[1:] == owner[:-1])[:len(owner)].astype(np.int64)
        size = np.bincount(owner, weights=words.end[kept] - words.start[kept] + space, minlength=table.num_rows)
        begin, end, at = flag_runs(gone, words.first)
        base = words.first[at]
        spans = pa.StructArray.from_arrays([pa.array(begin - base), pa.array(end - base)], ["begin", "end"])
        return pa.table({
            "doc_id": table.column("doc_id"),
            "n_words": np.diff(words.first),
            "n_removed": np.bincount(text[gone], minlength=table.num_rows),
            "kept_text": texts_of(gather_bytes(words.buf, words.start[kept], words.end[kept], space), size.astype(np.int64)),
            "removed": list_array(np.bincount(at, minlength=table.num_rows), spans),
        }).cast(RESULT)

    answer = "chunk int, more0 binary"
    asked = dealt.groupBy("chunk").applyInArrow(seeds, "part int, chunk int, hashes binary")
    found = asked.groupBy("part").applyInArrow(shared, answer)
    asked = dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        extend, "part int, chunk int, hashes binary, more0 binary, more1 binary, more2 binary, again binary")
    found = asked.groupBy("part").applyInArrow(earlier, answer)
    return dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<begin:long,end:long>>")


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()),
                    ("removed", SPANS)])
