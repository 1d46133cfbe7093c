"""The registered corpus queries on the smallest tables, against SQL or brute force, and the pipeline's stages."""

from __future__ import annotations

import glob
import hashlib
import os
from collections import Counter

import brute
import pytest

import corpus_pipeline
from tidemark.llm.catalogue import QUERIES, SQL
from tidemark.llm.secrets import RULES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def documents(database):
    return database.execute("SELECT doc_id, text FROM documents").fetchall()


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def test_all_queries():
    assert sorted({int(name[2:].split("_")[0]) for name in QUERIES}) == list(range(1, 14)) and len(QUERIES) == 13


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    result = database.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == Counter(result.fetchall())


def test_op2(spark, documents):
    found = {r.doc_id: r for r in QUERIES["op2_scan_secrets"](spark, FOLDER).collect()}
    assert len(found) == len(documents)
    for doc_id, text in documents:
        spans = brute.secrets(text, RULES)
        base = [s for s in spans if s[0] in ("assign", "access", "hex")]
        joined = [",".join(f"{k}:{a}:{b}" for k, a, b in part) for part in (base, spans)]
        kinds = Counter(k for k, _, _ in base)
        r = found[doc_id]
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) == (
            kinds["assign"], kinds["access"], kinds["hex"], sha(joined[0]), joined[1])


def test_op4(spark, documents):
    found = QUERIES["op4_ngram_jaccard_join"](spark, FOLDER).collect()
    assert sorted(map(tuple, found)) == brute.jaccard(documents, 3, 90)


def test_op6(spark, documents):
    found = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, FOLDER).collect()}
    for doc_id, text in documents:
        r = found[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.measures(text)
        assert not (r.kept and r.base_failed)


def test_op7(spark, database):
    found = QUERIES["op7_extract_text"](spark, FOLDER).collect()
    assert len(found) == database.execute("SELECT count(*) FROM pages").fetchone()[0]
    assert all(r.n_chars == len(r.text) > 0 for r in found)


def test_op8(spark, documents):
    found = QUERIES["op8_suffix_dedup"](spark, FOLDER).collect()
    assert sorted(map(tuple, found)) == sorted((i, n, gone, spans, sha(kept)) for i, n, gone, spans, kept in brute.suffix_dedup(documents))


def test_op10(spark, database):
    found = {r.doc_id: r for r in QUERIES["op10_mix_sources"](spark, FOLDER).collect()}
    rows = database.execute("SELECT doc_id, source, text FROM documents").fetchall()
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len(brute.words(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = brute.water_fill(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)})
    for doc_id, source, text in rows:
        r = found[doc_id]
        assert (r.size, r.source_size) == (len(brute.words(text)), sizes[source])
        assert r.target == pytest.approx(target[source]) and r.taken in (0, r.size, 2 * r.size)
    assert sum(r.taken for r in found.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.05)


def test_pipeline(spark, database):
    from tidemark.llm.storage import stored

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = database.execute("SELECT item_id, text FROM benchmark").fetchall()
    good = dict(database.execute("SELECT doc_id, quality FROM labels").fetchall())
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, FOLDER), "test")
        after = docs.collect()
        ids = {r.doc_id for r in after}
        assert ids <= set(before)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns and len(after) == len(ids)
            assert all((r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source) for r in after)
        if name == "quality rules":
            measured = {i: brute.measures(r.text) for i, r in before.items()}
            assert not any(measured[i][-1] for i in ids)
            assert all(i in ids for i, q in good.items() if q == 1 and i in before and not measured[i][-1])
        elif name == "n-gram Jaccard join":
            assert ids == {c for _, _, c in brute.jaccard([(i, r.text) for i, r in before.items()], 5, 80)}
        elif name == "benchmark decontamination":
            assert ids == set(before)
            hits = {i for i, _, hit, _ in brute.decontaminate([(i, r.text) for i, r in before.items()], items) if hit}
            assert {r.doc_id for r in after if r.text != before[r.doc_id].text} == hits
            assert not any(hit for _, _, hit, _ in brute.decontaminate([(r.doc_id, r.text) for r in after], items))
        elif name == "secret scans":
            assert {r.doc_id for r in after if r.text != before[r.doc_id].text} == {i for i, r in before.items() if brute.secrets(r.text, RULES)}
            assert not any(brute.secrets(r.text, RULES) for r in after)
        else:
            sizes, taken = Counter(), Counter()
            for r in before.values():
                sizes[r.source] += len(brute.words(r.text))
            for r in after:
                taken[r.doc_id] += 1
            order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
            target = brute.water_fill(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)})
            assert max(taken.values()) <= 2
            assert sum(len(brute.words(r.text)) for r in after) == pytest.approx(sum(target.values()), rel=0.1)
        assert all(r.n_chars == len(r.text) for r in after)
