"""Hard negatives, collocations and line dedup against plain versions: nulls, ties, repeats, empty tables, clashing columns."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.collocations import collocations
from tidemark.llm.count_automaton import CountAutomaton, summed
from tidemark.llm.hard_negatives import _Block, _packed, _scan, hard_negatives
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.perfect_hash import PerfectHash

CLASHING = "block int, `group` int, label2 int, chunk int, part int, id string, rank int, score double, slice int, n int, word string, `a.b` int"


def clashing(df):
    for field in CLASHING.split(", "):
        name, kind = field.rsplit(" ", 1)
        df = df.withColumn(name.strip("`"), F.lit(None).cast(kind))
    return df.repartition(3)


# hard negatives

def plain_negatives(rows, every=100, positives=5, negatives=10):
    good = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []

    def order(item):
        score, i = item
        return -score, i is None, i or 0

    for k, (a, q, lab) in enumerate(good):
        if a is None or a % every:
            continue
        scored = [(sum(x * y for x, y in zip(q, v)), i, other) for j, (i, v, other) in enumerate(good) if j != k]
        for p, pid in sorted([(s, i) for s, i, other in scored if other == lab], key=order)[:positives]:
            fits = sorted([(s, i) for s, i, other in scored if other != lab and 30 * p <= 100 * s <= 90 * p], key=order)
            out += [(a, pid, r + 1, i, p, s) for r, (s, i) in enumerate(fits[:negatives])]
    return out


def vectors(seed, n=300, dims=7):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in rng.sample(range(1000), n):
        lab = rng.randrange(4)
        v = [float(np.float32(c + rng.gauss(0, 0.7))) for c in centres[lab]]
        if rng.random() < 0.2:
            v = [round(x) / 1.0 for x in v]  # many ties
        if rng.random() < 0.1:
            v = v[:rng.randrange(dims)]  # shorter, or empty
        rows.append((i, v, lab))
    rows += [(1100, None, 1), (1200, [1.0] * dims, None), (1300, [1.0, None], 1), (1400, [float("nan")] * dims, 1),
             (1500, [float("inf")], 1), (None, [1.0] * dims, 0), (None, [1.0] * dims, 1), (1600, [1.0] * dims, 2),
             (1600, [1.0] * dims, 2), (1700, [0.0] * dims, 2), (1800, [1.0] * dims, 9)]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("block_rows,group_anchors", [(40, 2), (4096, 256)])
def test_hard_negatives(spark, block_rows, group_anchors):
    rows = vectors(block_rows)
    df = clashing(spark.createDataFrame(rows, VECTORS))
    found = hard_negatives(df, F.col("vec_id") % 100 == 0, block_rows=block_rows, group_anchors=group_anchors)
    expected = Counter(plain_negatives(rows))
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert len(expected) > 50 and Counter(tuple(r) for r in found.collect()) == expected


def test_hard_negatives_with_whole_numbers_beyond_doubles(spark):
    rows = [(100, [6e6, 1.0], 1), (1, [6e6, 2.0], 1), (2, [4e6, 5.0], 2), (3, [4e6, 6.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = hard_negatives(df, F.col("vec_id") % 100 == 0)
    assert Counter(tuple(r) for r in found.collect()) == Counter(plain_negatives(rows))
    huge = spark.createDataFrame([(100, [1e15], 1), (1, [1e15], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives(huge, F.col("vec_id") % 100 == 0).collect()


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(100, [1.0], 1)], VECTORS)
    assert hard_negatives(one, F.col("vec_id") % 100 == 0).count() == 0


def test_bounds_leave_out_rows_before_all_dimensions_are_read():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    entries = rng.normal(size=(500, 40)) * np.linspace(3, 0.01, 40)  # later dimensions say little
    batch = pa.RecordBatch.from_pydict({"id": np.arange(500), "label": np.zeros(500, np.int64),
                                        "vector": pa.array(entries.tolist()), "anchor": np.zeros(500, bool)})
    record = _packed(batch, 40, 256).to_pylist()[0] | {"block": 0}
    block, read = _Block(record, 40), []
    query = block.entries[:, 7].copy()
    columns = block.columns

    class Counting(np.ndarray):
        def __getitem__(self, at):
            read.append(np.broadcast(*at).size if isinstance(at, tuple) else len(at) * 500)
            return np.asarray(self)[at]

    block.columns = lambda exact: columns(exact).view(Counting)
    at, scores = _scan(block, {"entries": query.tobytes()}, np.ones(500, dtype=bool), [(-math.inf, math.inf)], 5)
    best = block.best(at, scores, 5)
    whole = query @ block.entries
    assert best[1].tolist() == sorted(whole.tolist(), reverse=True)[:5] and (whole[best[0]] == best[1]).all()
    assert sum(read) < 0.7 * 500 * 40


# collocations

def plain_collocations(rows, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang or "und", tuple(words[i:i + size])] += 1
    some = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    held = {(lang, longer[i:i + size]) for (lang, longer), b in some.items() for size in range(2, len(longer))
            for i in range(len(longer) - size + 1) if 100 * b >= 80 * f[lang, longer[i:i + size]]}
    by_lang = defaultdict(list)
    for (lang, words), a in some.items():
        if (lang, words) not in held:
            score, k = min((2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words)))
            by_lang[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, found in by_lang.items()
            for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]


def sentences(seed, n=200):
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gämma", "日本", "de", "la", "new", "york", "x" * 50] + [f"w{i}" for i in range(200)]
    fixed = ["New York de la", "alpha beta gämma 日本", "de la de la de la", "alpha beta"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        text = "".join(p + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  ", ": ", "\x0b", "  "]) for p in parts)
        rows.append((text, rng.choice(["en", "de", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" .\n", "fr"), ("one", "fr"), rows[0], rows[0], ("again " * 500, "de")]


@pytest.mark.parametrize("slice_bytes,fan,least,top", [(3_000, 4, 5, 10**9), (500, 3, 3, 7), (10**9, 512, 4, 10**9)])
def test_collocations(spark, slice_bytes, fan, least, top):
    rows = sentences(len(str(slice_bytes)))
    df = clashing(spark.createDataFrame(rows, "text string, lang string").withColumn("doc_id", F.lit(1)))
    found = collocations(df, least=least, top=top, slice_bytes=slice_bytes, fan=fan, merged=2)
    expected = Counter(plain_collocations(rows, least, top))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert len(expected) > 10 and Counter(tuple(r) for r in found.collect()) == expected


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations(empty).count() == 0
    rare = spark.createDataFrame([("a b c", None), (None, None)], "text string, lang string")
    assert collocations(rare).count() == 0


def test_phrases_that_are_rare_in_all_slices_are_not_sent():
    from tidemark.llm.collocations import _buckets, _messages, _phrases

    rng, least, buckets = np.random.default_rng(5), 6, 1 << 16
    slices = [np.where(rng.random(4000) < 0.1, -1, rng.zipf(1.5, 4000) % 300).astype(np.int32) for _ in range(5)]
    slices += [np.zeros(0, np.int32), np.array([-1], np.int32), np.array([7], np.int32), np.array([7, 8, -1], np.int32)]
    total, exact, kept = np.zeros(buckets, np.int64), Counter(), Counter()
    for ids in slices:
        np.add.at(total, _buckets(ids, buckets, None), 1)
    whole = cut = 0
    for ids in slices:
        where = np.empty(2 * len(ids), dtype=bool)
        found = _buckets(ids, buckets, where)
        assert len(found) == where.sum()
        where[where] = total[found] >= least
        for counts, got in ((exact, _phrases(ids)), (kept, _phrases(ids, where[:len(ids)], where[len(ids):]))):
            for phrase, times in zip(*map(np.ndarray.tolist, got)):
                counts[tuple(phrase)] += times
            size = sum(map(len, _messages(0, *got, 3).column("automaton").to_pylist()))
            whole, cut = (whole + size, cut) if counts is exact else (whole, cut + size)
    often = {phrase: times for phrase, times in exact.items() if times >= least}
    assert len(often) > 300 and {phrase: kept[phrase] for phrase in often} == often
    assert all(times <= exact[phrase] for phrase, times in kept.items())
    assert cut < whole / 3 and len(kept) < len(exact) / 3


def test_automata_are_united_a_few_at_a_time(monkeypatch):
    import tidemark.llm.count_automaton as module

    rng = np.random.default_rng(8)
    parts = [summed([(rng.integers(0, 4, (60, 3)).astype(np.int32), np.ones(60, np.int64))], 3) for _ in range(12)]
    expected = summed(parts, 3, 5)
    held, add_up = [], module.summed
    monkeypatch.setattr(module, "AT_ONCE", 100)
    monkeypatch.setattr(module, "summed", lambda found, *args: held.append(sum(len(c) for _, c in found)) or add_up(found, *args))
    united = CountAutomaton.union((CountAutomaton.build(*part) for part in parts), 3, 5).phrases()
    assert len(expected[1]) > 20 and (united[0] == expected[0]).all() and (united[1] == expected[1]).all()
    assert max(held) < 250 < sum(len(c) for _, c in parts)


def test_automaton_shares_states_and_keeps_counts(monkeypatch):
    import tidemark.llm.count_automaton as module

    rng = random.Random(3)
    for run in (1, 10, 1000):
        monkeypatch.setattr(module, "RUN", run)
        counts = Counter(tuple(rng.randrange(6) for _ in range(rng.randint(1, 4))) for _ in range(800))
        keys = sorted(counts, key=lambda k: k + (-1,) * (4 - len(k)))
        rows = np.array([k + (-1,) * (4 - len(k)) for k in keys], dtype=np.int32)
        weights = np.array([counts[k] for k in keys])
        built = CountAutomaton.build(rows, weights)
        for a in (built, CountAutomaton.unpacked(built.packed())):
            assert all((x == y).all() for x, y in zip(a.phrases(), (rows, weights)))
            asked = [tuple(rng.randrange(7) for _ in range(rng.randint(1, 4))) for _ in range(300)]
            wanted = np.array([k + (-1,) * (4 - len(k)) for k in asked], dtype=np.int32)
            assert a.compose(wanted).tolist() == [counts.get(k, 0) for k in asked]
        united = CountAutomaton.union([built, built, CountAutomaton.build(rows[:0], weights[:0])], 4).phrases()
        assert (united[0] == rows).all() and (united[1] == 2 * weights).all()
    # Equal ends are one state: a 2 2 and b 2 2 differ in their first word only.
    twins = CountAutomaton.build(np.array([[0, 2, 2, -1], [1, 2, 2, -1]], dtype=np.int32), np.array([1, 1]))
    assert twins.n_states() == 3
    other = CountAutomaton.build(np.array([[0, 2, 2, -1], [1, 2, 2, -1]], dtype=np.int32), np.array([1, 2]))
    assert other.n_states() == 5


# line dedup

def plain_lines(rows, least_chars=20, least_docs=3):
    space = "\x20\x09\x0a\x0b\x0c\x0d"
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[brute.lower(line.strip(space))].add(doc_id)
    goes = {key: max((d for d in docs if d is not None), default=None) for key, docs in holders.items()
            if len(key) >= least_chars and len(docs) >= least_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keys = [brute.lower(line.strip(space)) for line in lines]
        kept = [line for line, key in zip(lines, keys) if key not in goes or goes[key] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def pages(seed, n=80):
    rng = random.Random(seed)
    common = ["All rights reserved, 2024.", "short line", "Ünïcode line of twenty", "é" * 20, "e" * 19, "\x0b\x0c tabs and feeds around me \t",
              "subscribe to our newsletter today", "SUBSCRIBE to our newsletter TODAY\r"]
    rows = []
    for i in rng.sample(range(500), n):
        lines = [rng.choice(common) if rng.random() < 0.5 else f"line number {rng.randrange(60)} of the text" for _ in range(rng.randint(0, 9))]
        rows.append((i, rng.choice(["", "\n", "\n\n"]).join([""] + lines) if rng.random() < 0.1 else "\n".join(lines)))
    rows += [(1000, None), (1001, ""), (1002, "\n"), (1003, "\n\n\n"), (None, "\n".join(common)), (None, "\n".join(common)), (None, None),
             (1004, "a line that one id alone holds\n" * 3), (1004, "a line that one id alone holds"), (1004, "a line that one id alone holds")]
    rows += [(None, "only rows without an id hold this")] * 4
    rows += [(1005, "held by two ids and a nameless row"), (1006, "Held by two ids and a nameless row "), (None, "held by two ids and a nameless row")]
    return rows + [rows[0], rows[0], (1007, "\n".join(t or "" for _, t in rows))]


@pytest.mark.parametrize("chunk_bytes", [300, 10**9])
def test_line_dedup(spark, chunk_bytes):
    rows = pages(chunk_bytes % 7)
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    found = line_dedup(df, chunk_bytes=chunk_bytes)
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept_text"]
    assert Counter(tuple(r) for r in found.collect()) == Counter(plain_lines(rows))
    found = line_dedup(df, least_chars=0, least_docs=2, chunk_bytes=chunk_bytes)
    assert Counter(tuple(r) for r in found.collect()) == Counter(plain_lines(rows, 0, 2))


def test_line_dedup_of_nothing(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        line_dedup(spark.createDataFrame([], "doc_id long, text string"), least_docs=1000)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    hashes, marks = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**32, n).astype(np.uint32)
    hashes[: n // 3] = hashes[:1]  # keys that differ in the mark alone
    built = PerfectHash.build(hashes, marks)
    for perfect in (built, PerfectHash(built.sizes, built.bits)):
        assert sorted(perfect.index(hashes, marks).tolist()) == list(range(n))
        assert perfect.index(hashes + np.uint64(1), marks).max(initial=-1) < max(n, 1)
    assert len(built.bits) <= n + 16
    if n > 1:
        with pytest.raises(ValueError):
            PerfectHash.build(np.append(hashes, hashes[:1]), np.append(marks, marks[:1]))
