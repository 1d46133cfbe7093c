"""Phrase collocations per language, counted by weighted acyclic automata.

Slices of documents are written as word codes.  Parts of the hash space add up the slices' word counts and number the
words that occur often enough (a phrase cannot occur more often than its words, so others end a piece).  Then slices
send how often each bucket of hashed pairs and triples occurs, and learn which buckets come to enough in all slices:
what lies in another is too rare, as is all that holds it, and is not counted further.  Each slice sorts its phrases of
one to four words that are left and builds count automata of them, one per range of the phrases' hashed
prefixes; ranges unite the automata of all slices and add up their weights.  With many ranges a slice sends coarse
ones, which units of some slices unite and cut finer.  The parts of a candidate are looked up by composing them with
the automata of the ranges that hold them.  What remains, cuts, scores, containment and ranks, is plain DataFrames.

A prefix is a phrase's first three words, so phrases that begin with a frequent pair lie in many ranges, and a word
that a third of all rows hold is one entry per slice.  Words are compared as text, never by a hash alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrays import LOWER, U64, Words, byte_class, gather_bytes, mix, part_of, text_bytes, texts_of
from tidemark.llm.chunks import slices
from tidemark.llm.count_automaton import NONE, CountAutomaton, from_planes, to_planes
from tidemark.llm.storage import stored

LONGEST, PREFIX = 4, 3
SLICE_BYTES = 4_000_000
FAN, MERGED = 512, 64  # ranges a slice sends to at most, and slices united before they are cut finer
SHARE = 8  # slices' worth of words, buckets or phrases that one task puts together
BUCKET_BYTES = 16  # bytes of text a bucket; some three pairs and triples then share one
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
IN_WORD = byte_class(b"\x20\x09" + BREAKS)
IS_BREAK = ~byte_class(BREAKS)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, top: int = 2000,
                 slice_bytes: int = SLICE_BYTES, fan: int = FAN, merged: int = MERGED) -> DataFrame:
    """Each language's `top` phrases of two to four words that belong together.

    Texts, A-Z lower-cased, are split at `[.,;:!?\\x0A-\\x0D]` into pieces and those into words `[^\\x20\\x09]+`; a phrase
    lies within a piece, and all its occurrences count.  A phrase with a >= `least` occurrences is a candidate.  Cut
    after k words its score is floor(2000000 * a / (l + r)), l and r the occurrences of the two parts; the cut with the
    smallest score counts (ties: the smallest k).  Candidates that lie in a longer candidate which occurs 0.8 times as
    often or more are dropped.  All arithmetic is in whole numbers or decimals.
    Returns lang, rank (from 1, by score, then a, both descending, then the phrase in byte order), phrase (joined by
    one space), a, l, r, n (all words of the language) and score.

    Nulls: a null text is empty, a null language is `und`, together with rows that say `und`.  Repeated rows count as
    often as they come.  A rank is unique, for phrases are.  Empty tables and texts give no rows.  Texts are never cut;
    other columns are not read.  More than 2^31 words that occur often enough are an error.
    """
    rows = docs.select(F.coalesce(F.col(_q(lang_col)).cast("string"), F.lit("und")).alias("lang"),
                       F.col(_q(text_col)).cast("string").alias("text")).filter("text != ''")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / slice_bytes))
    parts = shards = ranges = math.ceil(n / SHARE)
    buckets = max(1, min(2**32 - 1, total // BUCKET_BYTES))
    of_shard = math.ceil(buckets / shards)

    def encode(batches):
        for batch in slices(batches, "text", slice_bytes):
            yield _encoded(batch, parts)

    encoded = stored(rows.mapInArrow(encode, "codes binary, sent " + SENT).withColumn(
        "slice", F.monotonically_increasing_id()), "codes")
    sent = encoded.select("slice", F.inline("sent"))

    def number(table: pa.Table) -> pa.Table:
        """A part's words with their counts, numbered where they are frequent; words without a number are one row a language.
        Further rows have the numbers of the words of each message, in its order; -1 for rare ones."""
        part, rows = table.column("part")[0].as_py(), _word_rows(table)
        langs, spelled = (rows.column(c).combine_chunks().dictionary_encode() for c in ("lang", "word"))
        pair = _places(langs.dictionary)[langs.indices.to_numpy()] * len(spelled.dictionary) + _places(spelled.dictionary)[spelled.indices.to_numpy()]
        pairs, which = np.unique(pair, return_inverse=True)
        times = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(times, which, rows.column("count").to_numpy())
        lang, word = np.divmod(pairs, max(1, len(spelled.dictionary)))
        often = times >= least
        ids = np.arange(often.sum(), dtype=np.int64) * parts + part
        if len(ids) and ids[-1] > np.iinfo(np.int32).max:
            raise ValueError("more than 2^31 frequent words")
        rare = np.zeros(len(langs.dictionary), dtype=np.int64)
        np.add.at(rare, lang[~often], times[~often])
        some = np.flatnonzero(rare)
        names, entries = (x.take(pc.sort_indices(x)) for x in (langs.dictionary, spelled.dictionary))
        answer = np.full(len(pairs), -1, dtype=np.int32)
        answer[often] = ids
        answer = answer[which]
        sizes = [len(x) // 8 for x in table.column("counts").to_pylist()]
        ends = np.cumsum(sizes, dtype=np.int64)
        n_words, n_rest = len(ids) + len(some), len(some) + table.num_rows
        return pa.table({
            "part": pa.array(np.full(n_words + table.num_rows, part), pa.int32()),
            "id": pa.chunked_array([pa.array(ids, pa.int32()), pa.nulls(n_rest, pa.int32())]),
            "lang": pa.chunked_array([names.take(pa.array(np.concatenate([lang[often], some]))), *table.column("lang").chunks], pa.string()),
            "word": pa.chunked_array([entries.take(pa.array(word[often])), pa.nulls(n_rest, pa.binary())]).cast(pa.string()),
            "count": pa.chunked_array([pa.array(np.concatenate([times[often], rare[some]])), pa.nulls(table.num_rows, pa.int64())]),
            "slice": pa.chunked_array([pa.nulls(n_words, pa.int64()), *table.column("slice").chunks]),
            "ids": pa.array([None] * n_words + [answer[j - k:j].tobytes() for j, k in zip(ends.tolist(), sizes)], pa.binary())})

    numbers = stored(sent.groupBy("part").applyInArrow(number, "part int, id int, lang string, word string, count long, slice long, ids binary"), "words")
    words = numbers.filter("slice IS NULL").select("id", "lang", "word", "count")
    numbered = numbers.filter("slice IS NOT NULL").select("slice", "part", "lang", "ids")
    whole = encoded.select("slice", "codes").unionByName(numbered, allowMissingColumns=True)

    def known(table: pa.Table) -> np.ndarray:
        """The numbers of a slice's words, -1 for rare ones and after each piece."""
        ids = table.filter(pc.is_valid(table.column("ids"))).sort_by([("part", "ascending"), ("lang", "ascending")])
        numbers = np.concatenate([*(np.frombuffer(x, np.int32) for x in ids.column("ids").to_pylist()), np.array([-1], np.int32)])
        return numbers[from_planes(pc.drop_null(table.column("codes"))[0].as_py())]

    def ask(table: pa.Table) -> pa.Table:
        """How often a slice has each bucket, by shard."""
        found, times = np.unique(_buckets(known(table), buckets, None), return_counts=True)
        cuts = np.searchsorted(found, np.arange(shards + 1) * of_shard)
        some = np.flatnonzero(np.diff(cuts))
        gaps = [np.diff(found[cuts[k]:cuts[k + 1]], prepend=k * of_shard) for k in some]
        return pa.table({"shard": pa.array(some, pa.int32()), "slice": pa.array([table.column("slice")[0].as_py()] * len(some), pa.int64()),
                         "gaps": pa.array([to_planes(x) for x in gaps], pa.binary()),
                         "times": pa.array([to_planes(times[cuts[k]:cuts[k + 1]]) for k in some], pa.binary())})

    def judge(table: pa.Table) -> pa.Table:
        """One bit for each bucket of each message: whether it comes to `least` in all slices."""
        total = np.zeros(of_shard, dtype=np.int64)
        at = [np.cumsum(from_planes(x), dtype=np.int32 if of_shard < 2**31 else np.int64) for x in table.column("gaps").to_pylist()]
        for places, times in zip(at, table.column("times").to_pylist()):
            total[places] += from_planes(times)
        return pa.table({"slice": table.column("slice"), "shard": table.column("shard"),
                         "often": pa.array([np.packbits(total[places] >= least).tobytes() for places in at], pa.binary())})

    asked = whole.groupBy("slice").applyInArrow(ask, "shard int, slice long, gaps binary, times binary")
    judged = asked.groupBy("shard").applyInArrow(judge, "slice long, shard int, often binary")
    sizes = [ranges]  # numbers of ranges, from coarse to fine
    while sizes[0] > fan:
        sizes.insert(0, math.ceil(sizes[0] / fan))

    def count(table: pa.Table, answers: pa.Table) -> pa.Table:
        ids = known(table)
        where = np.empty(2 * len(ids), dtype=bool)
        found, which = np.unique(_buckets(ids, buckets, where), return_inverse=True)
        sizes_ = np.diff(np.searchsorted(found, np.arange(shards + 1) * of_shard))
        bits = answers.sort_by("shard").column("often").to_pylist()
        often = [np.unpackbits(np.frombuffer(x, np.uint8), count=k) for x, k in zip(bits, sizes_[sizes_ > 0].tolist())]
        where[where] = np.concatenate([*often, np.zeros(0, np.uint8)]).astype(bool)[which]
        return _messages(table.column("slice")[0].as_py(), *_phrases(ids, where[:len(ids)], where[len(ids):]), sizes[0])

    automata = whole.groupBy("slice").cogroup(judged.groupBy("slice")).applyInArrow(count, MESSAGE)
    group = merged

    def finer(ranges: int):
        def unite_some(table: pa.Table) -> pa.Table:
            united = CountAutomaton.union(_automata(table), LONGEST)
            return _messages(table.column("slice")[0].as_py(), *united.phrases(), ranges)

        return unite_some

    for size in sizes[1:]:
        unit = [F.col("range"), F.pmod(F.xxhash64("slice"), F.lit(max(1, math.ceil(n / group)))).alias("unit")]
        automata = automata.groupBy(*unit).applyInArrow(finer(size), MESSAGE)
        group *= merged

    def unite(table: pa.Table) -> pa.Table:
        """A range's phrases, without those that are too rare: no part of a candidate is rarer than the candidate."""
        united = CountAutomaton.union(_automata(table), LONGEST, least)
        return pa.table({"range": table.column("range").slice(0, 1), "automaton": [united.packed()]},
                        schema=pa.schema([("range", pa.int32()), ("automaton", pa.binary())]))

    index = stored(automata.groupBy("range").applyInArrow(unite, "range int, automaton binary"), "phrases")

    def frequent(batches):
        for batch in batches:
            for data in batch.column("automaton").to_pylist():
                phrases, counts = CountAutomaton.unpacked(data).phrases()
                some = (counts >= least) & (phrases[:, 1] != NONE)
                yield pa.RecordBatch.from_pydict({"phrase": _lists(phrases[some]), "a": counts[some]})

    candidates = stored(index.mapInArrow(frequent, "phrase array<int>, a long"), "candidates")

    def route(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"range": pa.array(_range_of(_matrix(batch.column("part")), ranges), pa.int32()),
                                              "part": batch.column("part")})

    def look_up(asked: pa.Table, automaton: pa.Table) -> pa.Table:
        schema = pa.schema([("part", pa.list_(pa.int32())), ("count", pa.int64())])
        if not asked.num_rows:
            return schema.empty_table()
        index = CountAutomaton.unpacked(automaton.column("automaton")[0].as_py())
        return pa.table({"part": asked.column("part"), "count": index.compose(_matrix(asked.column("part")))}, schema=schema)

    size = F.size("phrase")
    cuts = candidates.select("phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("phrase", "a", "k", F.slice("phrase", 1, F.col("k")).alias("left"),
                       F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("right"))
    asked = cuts.select(F.explode(F.array("left", "right")).alias("part")).distinct().mapInArrow(route, "range int, part array<int>")
    counts = stored(asked.groupBy("range").cogroup(index.groupBy("range")).applyInArrow(look_up, "part array<int>, count long"), "parts")
    scored = cuts.join(counts.select(F.col("part").alias("left"), F.col("count").alias("l")), "left").join(
        counts.select(F.col("part").alias("right"), F.col("count").alias("r")), "right")
    score = F.expr("(CAST(a AS DECIMAL(20, 0)) * 2000000) div (CAST(l AS DECIMAL(20, 0)) + r)")
    scored = scored.withColumn("score", score).groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    starts = F.transform(F.sequence(F.lit(2), size - 1), lambda length: F.transform(
        F.sequence(F.lit(1), size - length + 1), lambda start: F.slice("phrase", start, length)))
    longer = candidates.filter(size > 2).select(F.col("a").alias("longest"), F.explode(F.flatten(starts)).alias("phrase"))
    longer = longer.groupBy("phrase").agg(F.max("longest").alias("longest"))
    held = F.expr("CAST(longest AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * 80")
    scored = scored.join(longer, "phrase", "left").filter(~F.coalesce(held, F.lit(False)))

    spelled = scored.select("phrase", F.posexplode("phrase").alias("place", "id")).join(words.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("phrase").agg(F.min("lang").alias("lang"), F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("spelled"))
    totals = words.groupBy("lang").agg(F.sum("count").alias("n"))
    found = scored.join(spelled, "phrase").select("lang", F.col("spelled").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return found.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SENT = "array<struct<part: int, lang: string, words: binary, counts: binary>>"
_SENT = pa.list_(pa.struct([("part", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("counts", pa.binary())]))
MESSAGE = "range int, slice long, automaton binary"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _encoded(batch: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """A slice as codes (-1 after each piece) of its distinct words per language, and the words by part with their counts."""
    buf, offsets = text_bytes(batch.column("text"))
    buf = LOWER[buf]
    words = Words(buf, offsets, IN_WORD)
    none = np.zeros(len(words), dtype=np.int64)
    spelled = texts_of(gather_bytes(buf, words.start, words.end, none), words.end - words.start).cast(pa.binary()).dictionary_encode()
    langs = batch.column("lang").dictionary_encode()
    text = np.repeat(np.arange(batch.num_rows), np.diff(words.first))
    pair = langs.indices.to_numpy()[text].astype(np.int64) * max(1, len(spelled.dictionary)) + spelled.indices.to_numpy()
    pairs, sample, codes, counts = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
    lang, word = np.divmod(pairs, max(1, len(spelled.dictionary)))
    part = part_of(words.hashes()[sample], parts)
    names, entries = langs.dictionary, spelled.dictionary
    order = np.lexsort((_places(entries)[word], _places(names)[lang], part))
    rank = np.empty(len(order), dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    breaks = np.concatenate([[0], np.cumsum(IS_BREAK[buf])])[words.start] if len(words) else none
    last = np.append((text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1]), [True])[:len(words)]
    out = np.full(len(words) + int(last.sum()), -1, dtype=np.int32)
    out[np.arange(len(words)) + np.cumsum(last) - last] = rank[codes]
    part, lang, word, counts = part[order], lang[order], word[order], counts[order].astype(np.int64)
    begins = np.flatnonzero(np.append([True], (part[1:] != part[:-1]) | (lang[1:] != lang[:-1]))[:len(part)])
    sent = [{"part": int(part[i]), "lang": names[int(lang[i])].as_py(), "counts": counts[i:j].tobytes(),
             "words": b"\n".join(entries.take(pa.array(word[i:j])).to_pylist())}
            for i, j in zip(begins, np.append(begins[1:], len(part)))]
    return pa.RecordBatch.from_pydict({"codes": [to_planes(out)], "sent": pa.array([sent], _SENT)})


def _places(values: pa.Array) -> np.ndarray:
    """The place of each of some distinct values in their ascending order."""
    out = np.empty(len(values), dtype=np.int64)
    out[pc.sort_indices(values).to_numpy()] = np.arange(len(values))
    return out


def _word_rows(table: pa.Table) -> pa.Table:
    """(lang, word, count) of all messages of a part, one after another."""
    lists = [x.split(b"\n") for x in table.column("words").to_pylist()]
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    lang = table.column("lang").take(pa.array(np.repeat(np.arange(len(lists)), sizes)))
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int64)
    return pa.table({"lang": lang, "word": pa.array([w for x in lists for w in x], pa.binary()), "count": counts})


def _buckets(ids: np.ndarray, buckets: int, where: np.ndarray | None) -> np.ndarray:
    """The buckets of the pairs, then of the triples in ids (-1 ends a piece).

    `where`, of twice the length of ids, is filled with where pairs and, in its second half, triples begin.
    """
    where = np.empty(2 * len(ids), dtype=bool) if where is None else where
    where[:] = False
    out, value, whole = [], np.zeros(len(ids), dtype=U64), np.ones(len(ids), dtype=bool)
    with np.errstate(over="ignore"):
        for d in range(3):
            value = mix(value[:len(ids) - d] + ids[d:].astype(np.int64).astype(U64) + U64(0x9E3779B97F4A7C15))
            whole = whole[:len(ids) - d] & (ids[d:] >= 0)
            if d:
                where[(d - 1) * len(ids):(d - 1) * len(ids) + len(whole)] = whole
                out.append(part_of(value[whole], buckets))
    return np.concatenate(out)


def _phrases(ids: np.ndarray, pairs: np.ndarray | None = None, triples: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All distinct phrases of one to four ids (-1 ends a piece) in ascending order, with their counts.

    `pairs` and `triples` say which places begin one that may be frequent; phrases that hold another one are left out.
    """
    alphabet, rank = np.unique(ids[ids >= 0], return_inverse=True)
    m = len(alphabet)
    if not m:
        return np.zeros((0, LONGEST), np.int32), np.zeros(0, np.int64)
    letters = np.full(len(ids), -1, dtype=np.int64)
    letters[ids >= 0] = rank
    at, code = np.flatnonzero(letters >= 0), rank  # where phrases of the length so far begin, and which they are
    rows, counts = [np.arange(m)[:, None]], [np.bincount(code, minlength=m)]
    for length in range(1, LONGEST):
        inside = at + length < len(letters)
        at, code = at[inside], code[inside]
        letter = letters[at + length]
        some = letter >= 0
        if length == 1 and pairs is not None:
            some &= pairs[at]
        elif length > 1 and triples is not None:
            some &= triples[at + length - 2]
        at, key = at[some], (code * m + letter)[some]
        keys, code, times = np.unique(key, return_inverse=True, return_counts=True)
        rows.append(np.concatenate([rows[-1][keys // m], (keys % m)[:, None]], axis=1))
        counts.append(times)
    out = np.full((sum(map(len, rows)), LONGEST), NONE, dtype=np.int64)
    begin = 0
    for r in rows:
        out[begin:begin + len(r), :r.shape[1]] = r
        begin += len(r)
    # The order of whole rows: pairs by their rank, then the second pair; shorter phrases first.
    pairs = out[:, 0] * (m + 1) + out[:, 1] + 1
    pair = np.unique(pairs, return_inverse=True)[1].astype(U64)
    if (int(pair.max()) + 1) * (m + 1) ** 2 < 2**64:
        order = np.argsort(pair * U64((m + 1) ** 2) + ((out[:, 2] + 1) * (m + 1) + out[:, 3] + 1).astype(U64))
    else:
        order = np.lexsort(out.T[::-1])
    out = out[order]
    return np.where(out == NONE, NONE, alphabet[out]).astype(np.int32), np.concatenate(counts)[order].astype(np.int64)


def _range_of(phrases: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each phrase, by a hash of its first words."""
    value = np.zeros(len(phrases), dtype=U64)
    with np.errstate(over="ignore"):
        for d in range(min(PREFIX, phrases.shape[1])):
            value = mix(value + phrases[:, d].astype(np.int64).astype(U64) + U64(0x9E3779B97F4A7C15))
    return part_of(value, ranges)


def _messages(slice_: int, phrases: np.ndarray, counts: np.ndarray, ranges: int) -> pa.Table:
    """One automaton for each range of the sorted phrases."""
    range_ = _range_of(phrases, ranges)
    order = np.argsort(range_, kind="stable")
    range_, phrases, counts = range_[order], phrases[order], counts[order]
    begins = np.flatnonzero(np.append([True], range_[1:] != range_[:-1])[:len(range_)])
    pieces = list(zip(begins, np.append(begins[1:], len(range_))))
    return pa.table({"range": pa.array([int(range_[i]) for i in begins], pa.int32()), "slice": pa.array([slice_] * len(pieces), pa.int64()),
                     "automaton": pa.array([CountAutomaton.build(phrases[i:j], counts[i:j]).packed() for i, j in pieces], pa.binary())})


def _automata(table: pa.Table) -> Iterator[CountAutomaton]:
    return (CountAutomaton.unpacked(x) for x in table.column("automaton").to_pylist())


def _lists(phrases: np.ndarray) -> pa.Array:
    sizes = (phrases != NONE).sum(axis=1)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(phrases[phrases != NONE], pa.int32()))


def _matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of ids as rows filled up with -1."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(lists), LONGEST), NONE, dtype=np.int32)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
    return out
