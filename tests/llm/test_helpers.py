"""The array, automaton and index helpers against plain versions."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from brute import secrets
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.arrays import ALNUM, LOWER, NOT_SPACE, Words, runs, text_bytes, winnow
from tidemark.llm.automaton import compile_rules
from tidemark.llm.components import components
from tidemark.llm.count_tree import count_vectors, linked, needed
from tidemark.llm.fm_index import FMIndex
from tidemark.llm.jaccard_join import SizeClasses, meeting_keys, shingle_sets
from tidemark.llm.secrets import RULES, _scan
from tidemark.llm.suffixes import common_prefixes, merge, suffix_array


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab Zé9\n\t-", max_size=30)), max_size=6))
def test_words(texts):
    array = pa.array(texts, pa.string())
    for table, pattern, fold in ((NOT_SPACE, r"[^\x20\x09-\x0D]+", None), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", LOWER)):
        found = Words(*text_bytes(array), table)
        plain = [re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or "") if fold is not None else t or "") for t in texts]
        assert list(np.diff(found.first)) == [len(w) for w in plain]
        flat = [w for p in plain for w in p]
        hashes = found.hashes(fold)
        assert [[hashes[i] == hashes[j] for j in range(len(flat))] for i in range(len(flat))] == [[a == b for b in flat] for a in flat]


def test_runs_and_winnow():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, 200).astype(np.uint64)
    for n in (1, 2, 3, 7, 20):
        h = runs(x, n)
        parts = [tuple(x[i:i + n]) for i in range(len(x) - n + 1)]
        assert len(h) == len(parts) and len(set(h.tolist())) == len(set(parts))
    assert len(runs(x[:3], 4)) == 0
    big = rng.integers(0, 2**63, 100).astype(np.uint64)
    x = np.concatenate([big, big])
    place = winnow(x, 11)
    assert all(i <= p < i + 11 for i, p in enumerate(place))
    assert (place[100:190] - 100 == place[:90]).all()


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=120), st.sampled_from([1, 2, 4]))
def test_suffix_array_and_common_prefixes(raw, letters):
    text = np.frombuffer(raw, np.uint8) % letters
    order = suffix_array(text)
    b = text.tobytes()
    assert order.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
    shares = common_prefixes(text, order, 30)
    for k in range(1, len(b)):
        x, y = b[order[k - 1]:], b[order[k]:]
        same = next((i for i in range(min(len(x), len(y), 30)) if x[i] != y[i]), min(len(x), len(y), 30))
        assert shares[k] == same


def test_merge():
    rng = random.Random(1)
    for _ in range(50):
        parts = [np.unique(np.array([rng.randrange(40) for _ in range(rng.randrange(15))], np.uint64)) for _ in range(rng.randrange(8))]
        values, several = merge(parts)
        every = sorted({int(v) for p in parts for v in p})
        assert values.tolist() == every
        assert several.tolist() == [sum(v in p for p in parts) > 1 for v in every]


def test_fm_index():
    rng = random.Random(2)
    for _ in range(60):
        bits = rng.choice([1, 2, 4])
        text = np.array([rng.randint(1, (1 << bits) - 1) for _ in range(rng.randrange(120))], np.int64)
        index = FMIndex(text, bits)
        patterns = [[rng.randint(1, (1 << bits) - 1) for _ in range(rng.randint(1, 4))] for _ in range(10)]
        table = np.zeros((10, 4), np.int64)
        for row, p in zip(table, patterns):
            row[:len(p)] = p
        low, high = index.search(table, np.array([len(p) for p in patterns]))
        for p, a, b in zip(patterns, low, high):
            assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(len(text) - len(p) + 1) if text[i:i + len(p)].tolist() == p]


def test_automaton_finds_ends_of_all_matches():
    patterns = ["ab+c", "(?i:key)=[0-9]{2}", "a[^b]?d|xyz"]
    automaton = compile_rules(patterns)
    rng = random.Random(3)
    for _ in range(100):
        texts = ["".join(rng.choice("abcdxyzKEYkey=019\n") for _ in range(rng.randrange(80))) for _ in range(rng.randrange(4))]
        buf, offsets = text_bytes(pa.array(texts, pa.string()))
        place, rules = automaton.ends(buf, offsets)
        expected = {}
        for text, base in zip(texts, offsets.tolist()):
            for end in range(1, len(text) + 1):
                bits = sum(1 << k for k, p in enumerate(patterns) if any(re.fullmatch(p, text[s:end]) for s in range(end)))
                if bits:
                    expected[base + end - 1] = bits
        assert dict(zip(place.tolist(), rules.tolist())) == expected


def test_secrets_against_regexes():
    pieces = ["password", "PASSWD", "secret", "ToKen", "api_key", "apikey", '"', "'", " ", ":", "=", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef",
              "é", "\n", ",", "x", "ghp_", "0" * 36, "-----BEGIN ", "RSA PRIVATE KEY-----", "xoxb-", ".", "+/", "9"]
    rng = random.Random(4)
    for _ in range(300):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice(pieces) for _ in range(rng.randrange(40))) for _ in range(4)]
        spans, clean = _scan(pa.array(texts, pa.string()), RULES)
        assert [[tuple(s.values()) for s in row] for row in spans.to_pylist()] == [secrets(t, RULES) for t in texts]
        for text, row, out in zip(texts, spans.to_pylist(), clean.to_pylist()):
            assert (out == text) == (not row)


def test_linked_sets_and_their_keys():
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        base = [rng.integers(0, 2**63, rng.integers(1, 90)) for _ in range(6)]
        sets = []
        for _ in range(150):
            members = set(base[rng.integers(6)].tolist())
            for _ in range(rng.integers(0, 4)):
                members.add(int(rng.integers(0, 2**63)))
                members.discard(next(iter(members)))
            sets.append(members)
        values = [np.sort(np.array(list(s), np.uint64)) for s in sets]
        first = np.concatenate([[0], np.cumsum([len(v) for v in values])])
        flat = np.concatenate(values)
        keys, owner = meeting_keys(flat, first, percent)
        keys_of = [set(keys[owner == i].tolist()) for i in range(len(sets))]
        vectors = count_vectors(flat, first)
        parent = list(range(len(sets)))

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for i in range(len(sets)):
            for j in range(i):
                common = len(sets[i] & sets[j])
                assert common <= np.minimum(vectors[i], vectors[j]).sum()
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    assert common >= needed(percent, len(sets[i]), len(sets[j]))
                    assert sets[i] == sets[j] or keys_of[i] & keys_of[j]
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
        roots = linked(flat, first, percent)
        assert len({(find(i), int(r)) for i, r in enumerate(roots)}) == len(set(roots.tolist())) == len({find(i) for i in range(len(sets))})


def test_size_classes_hold_all_links():
    for percent in (80, 90, 95):
        classes = SizeClasses(3000, percent)
        for a in range(1, 3000, 7):
            b = 100 * a // percent
            low, high = classes.of(np.array([a, b]))
            assert high - low <= 1
            assert (a + b) * (100 - percent) // (100 + percent) <= classes.differ[low]


def test_set_names_do_not_depend_on_neighbours():
    texts = pa.array(["a b c d", None, "A b c", "x", "", "x", "a b c d e"], pa.string())
    _, first, names = shingle_sets(texts, 3)
    assert np.diff(first).tolist() == [2, 0, 1, 1, 0, 1, 3]
    assert names[3] == names[5]
    assert [shingle_sets(texts.slice(i, 1), 3)[2][0] for i in range(7)] == names.tolist()


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(200 + i, 201 + i) for i in range(25)] + [(300, 300 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
