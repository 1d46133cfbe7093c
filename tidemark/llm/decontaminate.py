"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of documents of bounded size.  Its words are numbered by the vocabulary of the
benchmark; words the benchmark lacks, and ends of documents, become one symbol that no phrase contains,
and stretches between them that are shorter than the shortest phrase are left out, for nothing can occur
in them.  Over the rest the task builds an FM-index, searches all test phrases backwards at once through
wavelet-tree ranks, locates their occurrences by sampled suffix positions and merges the spans to remove.

The benchmark is the query set.  It is read in blocks of bounded size, and each block is one broadcast
and one narrow pass over the documents; nothing of the documents is shuffled or brought to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import ALNUM, LOWER, Words, contains, flag_runs, list_array, text_bytes, texts_of
from tidemark.llm.chunks import _q, carried, schema_of, slices
from tidemark.llm.fm_index import FMIndex

WINDOW = 10  # words of a phrase
BLOCK_WORDS = 400_000  # of the benchmark at once: at most some ten megabytes in each task
OTHER = 1  # symbol of words the benchmark lacks and of ends of texts; 0 is the index's own end mark


def phrase_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, ship,
                  block_words: int = BLOCK_WORDS) -> Iterator:
    """The items in blocks, each shipped as soon as it is made; one block at least."""
    rows = benchmark.select(F.col(_q(id_col)).cast("long").alias("item_id"), F.col(_q(text_col)).cast("string").alias("text"))
    ids, texts, size, made = [], [], 0, False
    for row in rows.toLocalIterator():  # one partition at a time, one block in memory
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text or "") // 2 + 1  # no fewer than its words
        if size >= block_words:
            yield ship(_block(ids, texts, window))
            ids, texts, size = [], [], 0
            made = True
    if ids or not made:
        yield ship(_block(ids, texts, window))


def _block(ids: list, texts: list, window: int) -> dict[str, np.ndarray]:
    """Vocabulary (sorted word hashes), phrases (rows of symbols), their lengths, and the items that have each."""
    words = Words(*text_bytes(pa.array(texts, pa.large_string())), ALNUM)
    hashes = words.hashes(LOWER)
    vocabulary = np.unique(hashes)
    symbols = np.searchsorted(vocabulary, hashes) + OTHER + 1
    size = np.repeat(np.diff(words.first), np.diff(words.first))
    left = words.left_in_text()
    start = np.flatnonzero((left >= window) | (left == size))  # of an item of fewer words: the whole item
    length = np.minimum(left[start], window)
    at = np.minimum(start[:, None] + np.arange(window), max(len(words) - 1, 0))
    phrases = np.where(np.arange(window) < length[:, None], symbols[at] if len(words) else 0, 0)
    item = np.repeat(np.arange(len(ids)), np.diff(words.first))[start]
    phrases, which = np.unique(np.column_stack([length, phrases]), axis=0, return_inverse=True)
    order = np.argsort(which.ravel(), kind="stable")
    known = np.array([x is not None for x in ids], dtype=bool)
    return {"vocabulary": vocabulary, "phrases": phrases[:, 1:], "lengths": phrases[:, 0], "item": item[order],
            "first": np.concatenate([[0], np.cumsum(np.bincount(which.ravel(), minlength=len(phrases)))]),
            "ids": np.array([x or 0 for x in ids], dtype=np.int64), "known": known}


def _occurrences(words: Words, block: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, first word, text) of each occurrence of a phrase in the texts."""
    none = (np.zeros(0, np.int64),) * 3
    if not len(block["lengths"]) or not len(words):
        return none
    hashes = words.hashes(LOWER)
    known = contains(block["vocabulary"], hashes)
    # Stretches of known words within one text, of those as long as the shortest phrase.
    edge = np.append([True], known[1:] != known[:-1])
    edge[words.first[:-1][words.first[:-1] < len(words)]] = True
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(words))
    good = known[begin] & (end - begin >= block["lengths"].min())
    begin, end = begin[good], end[good]
    if not len(begin):
        return none
    size = end - begin + 1  # with the mark after it
    stop = np.cumsum(size)
    word = np.arange(stop[-1]) + np.repeat(begin - (stop - size), size)
    symbols = np.searchsorted(block["vocabulary"], hashes[np.minimum(word, len(words) - 1)]) + OTHER + 1
    symbols[stop - 1] = OTHER
    index = FMIndex(symbols, int(len(block["vocabulary"]) + OTHER).bit_length())
    low, high = index.search(block["phrases"], block["lengths"])
    times = high - low
    phrase = np.repeat(np.arange(len(times)), times)
    place = np.arange(len(phrase)) + np.repeat(low - (np.cumsum(times) - times), times)
    start = word[index.locate(place)]
    return phrase, start, np.searchsorted(words.first, start, "right") - 1


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  carry: bool = False, texts: bool = True, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Words of documents that lie in a phrase of the benchmark.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z.  A phrase is `window`
    consecutive words of an item, or all words of an item that has fewer.  Returns doc_id, n_words, hits
    (merged runs [begin, end) of word numbers), items (sorted distinct ids of items with occurring phrases)
    and, with `texts`, kept_text (the text without the bytes from the first to the last word of each run),
    one row per row of `docs`; with `carry` also the whole input row as the struct `row`.

    Nulls: a null text has no words and stays null as kept_text; an item without words has no phrases; an
    item with a null id marks words, but is not listed.  Repeated documents are judged alike, repeated
    items change nothing, and an id is listed once.  Empty tables: no rows, or no hits.  Texts are never cut.
    """
    rows = carried(docs, id_col, text_col, carry)
    context = docs.sparkSession.sparkContext
    blocks = list(phrase_blocks(benchmark, item_col, item_text_col, window, context.broadcast, block_words))
    spans = "array<struct<begin:long,end:long>>"
    rows = rows.select("*", F.lit(0).cast("long").alias("n_words"), F.array().cast(spans).alias("hits"),
                       F.array().cast("array<long>").alias("items"))
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        out = "kept_text string" if texts and last else "text string" if not last else ""
        schema = schema_of(f"doc_id long, n_words long, hits {spans}, items array<long>" + (out and f", {out}"), rows)
        rows = rows.mapInArrow(_pass(block, out.split(" ")[0], carry), schema)
    return rows


def _pass(block, text_out: str, carry: bool):
    def search(batches):
        for batch in slices(batches, "text"):
            yield _mark(batch, block.value, text_out, carry)

    return search


def _mark(batch: pa.RecordBatch, block: dict[str, np.ndarray], text_out: str, carry: bool) -> pa.RecordBatch:
    n = batch.num_rows
    words = Words(*text_bytes(batch.column("text")), ALNUM)
    phrase, start, text = _occurrences(words, block)
    change = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, start + block["lengths"][phrase], -1)
    for side, sign in (("begin", 1), ("end", -1)):  # what earlier blocks have found
        hits = batch.column("hits")
        sizes = pa.compute.list_value_length(hits).to_numpy()
        np.add.at(change, hits.flatten().field(side).to_numpy() + np.repeat(words.first[:-1], sizes), sign)
    hit = np.cumsum(change[:-1]) > 0
    begin, end, owner = flag_runs(hit, words.first)
    base = words.first[owner]
    spans = pa.StructArray.from_arrays([pa.array(begin - base, pa.int64()), pa.array(end - base, pa.int64())], ["begin", "end"])

    pair = np.unique(np.column_stack([text, phrase]), axis=0).reshape(-1, 2)
    size = np.diff(block["first"])[pair[:, 1]]
    item = block["item"][np.arange(size.sum()) + np.repeat(block["first"][pair[:, 1]] - (np.cumsum(size) - size), size)]
    known = block["known"][item]
    earlier = batch.column("items")
    listed = np.concatenate([
        np.column_stack([np.repeat(pair[:, 0], size)[known], block["ids"][item[known]]]),
        np.column_stack([np.repeat(np.arange(n), pa.compute.list_value_length(earlier).to_numpy()), earlier.flatten().to_numpy()])])
    listed = np.unique(listed.astype(np.int64), axis=0).reshape(-1, 2)
    columns = {
        "doc_id": batch.column("doc_id"), "n_words": pa.array(np.diff(words.first), pa.int64()),
        "hits": list_array(np.bincount(owner, minlength=n), spans),
        "items": list_array(np.bincount(listed[:, 0], minlength=n), pa.array(listed[:, 1], pa.int64()))}
    if text_out == "text":
        columns["text"] = batch.column("text")
    elif text_out:
        columns["kept_text"] = _without(batch.column("text"), words, begin, end, owner)
    if carry:
        columns["row"] = batch.column("row")
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _without(texts: pa.Array, words: Words, begin: np.ndarray, end: np.ndarray, owner: np.ndarray) -> pa.Array:
    """The texts without the runs of words."""
    if not len(begin):
        return texts
    change = np.zeros(len(words.buf) + 1, dtype=np.int32)
    first, stop = words.start[begin], words.end[end - 1]
    change[first] += 1
    change[stop] -= 1
    keep = np.cumsum(change[:-1]) == 0
    size = np.diff(words.offsets) - np.bincount(owner, weights=stop - first, minlength=len(texts)).astype(np.int64)
    return pa.compute.if_else(texts.is_null(), None, texts_of(words.buf[keep], size))
