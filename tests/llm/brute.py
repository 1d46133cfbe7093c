"""Plain Python versions of what the corpus operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SPACE_WORDS = r"[^\x20\x09-\x0D]+"
ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(SPACE_WORDS, text or "")


def substring_dedup(docs, window=20):
    """[(doc_id, n_words, n_removed, kept_text)] of rows ordered by id (null last) and text."""
    seen, out = set(), []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1] is None, d[1] or "")):
        w = words(text)
        gone = [False] * len(w)
        for start in range(len(w) - window + 1):
            key = tuple(w[start:start + window])
            if key in seen:
                gone[start:start + window] = [True] * window
            seen.add(key)
        out.append((doc_id, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def suffix_dedup(docs, window=400):
    """[(doc_id, n_bytes, n_removed, n_spans, kept)]."""
    raw = [(doc_id, (text or "").encode()) for doc_id, text in docs]
    times = Counter(b[s:s + window] for _, b in raw for s in range(len(b) - window + 1))
    out = []
    for doc_id, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if times[b[s:s + window]] > 1:
                gone[s:s + window] = b"\x01" * window
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def secrets(text, rules):
    """[(kind, start, end)] by start, then in the order of the rules."""
    found = []
    for k, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), k, rule.kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def decontaminate(docs, items, window=10):
    """[(doc_id, n_words, hit word numbers, sorted ids)]."""
    phrases = defaultdict(set)
    for item_id, text in items:
        w = re.findall(ALNUM_WORDS, lower(text))
        for s in range(max(1, len(w) - window + 1)) if w else ():
            phrases[tuple(w[s:s + window])].add(item_id)
    out = []
    for doc_id, text in docs:
        w = re.findall(ALNUM_WORDS, lower(text))
        hit, ids = set(), set()
        for size in {len(p) for p in phrases}:
            for s in range(len(w) - size + 1):
                if (p := tuple(w[s:s + size])) in phrases:
                    hit |= set(range(s, s + size))
                    ids |= phrases[p]
        out.append((doc_id, len(w), sorted(hit), sorted(i for i in ids if i is not None)))
    return out


def jaccard(docs, shingle, percent):
    """[(doc_id, n_shingles, component_id)] for distinct ids."""
    docs = sorted(docs)
    sets, holders = [], defaultdict(list)
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, text) in enumerate(docs):
        w = words(lower(text))
        s = {tuple(w[k:k + shingle]) for k in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set()
        common = Counter(j for member in s for j in holders[member])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        sets.append(s)
        for member in s:
            holders[member].append(i)
    return [(docs[i][0], len(sets[i]), docs[find(i)][0]) for i in range(len(docs))]


def measures(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = words(text)
    triples = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(triples)
    repeated = {i + k for i, t in enumerate(triples) if times[t] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if words(line)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
            len(w) < 50 or 100 * len(repeated) > 50 * len(w))


def water_fill(sizes, weights, share=1.5, epochs=2.0):
    clamped = set()
    while True:
        free = [s for s in sizes if s not in clamped]
        if not free:
            return {s: epochs * sizes[s] for s in sizes}
        level = (share * sum(sizes.values()) - sum(epochs * sizes[s] for s in clamped)) / sum(weights[s] for s in free)
        more = {s for s in free if level * weights[s] > epochs * sizes[s]}
        if not more:
            return {s: epochs * sizes[s] if s in clamped else level * weights[s] for s in sizes}
        clamped |= more
