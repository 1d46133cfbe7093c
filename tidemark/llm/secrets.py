"""Secret scans: all rules in one deterministic automaton, one pass over the bytes of the texts.

The automaton finds the places where a match of some rule ends.  Only the stretch around such a place, up
to the nearest bytes that no match contains, is read once more by the rule's own regex, which gives the
start of the match, its groups, and the leftmost non-overlapping choice.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.arrays import list_array, text_bytes
from tidemark.llm.automaton import Automaton, compile_rules
from tidemark.llm.chunks import carried, schema_of, slices


@dataclass(frozen=True)
class Rule:
    """`seek` matches within every hit and goes into the automaton; `pattern` gives the hits, of which `group` has
    `least` bytes or more.  Long counted repeats in `seek` multiply the automaton's states with those of other
    rules, so only a rule that would match ordinary words has one.  Matches of a rule that is `far` may go on over
    bytes that no `seek` contains; a text in which it is found is read by `pattern` to the end."""

    kind: str
    seek: str
    pattern: str
    group: int = 0
    least: int = 1
    far: bool = False


_KEY = r"(?i:password|passwd|secret|token|api_?key)"
_VALUE = "[A-Za-z0-9+/_.=-]"
BASE = (
    Rule("assign", rf"""{_KEY}["']?\x20*[:=]\x20*["']?{_VALUE}""",
         rf"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?({_VALUE}+)""", 2, 12),
    Rule("access", "AKIA[A-Z0-9]", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]{16}", "[0-9a-f]+", 0, 16),
)
#: A private key: the lines that say how it is encrypted, then its base64 up to the END line, also where line ends are
#: written as `\n` or lines are quoted; without an END line the long runs of base64, and a shorter last line.
_BEGIN, _END = "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----END [A-Z ]*PRIVATE KEY-----"
_GAP = r"(?:[\x20\x09-\x0D\"'>#*,;]|\\[nr])"
_ENCRYPTED = rf"(?:{_GAP}*(?:Proc-Type:[\x20,0-9A-Z]+|DEK-Info:\x20*[0-9A-Z-]+,[0-9A-Fa-f]+))*"
_CUT_OFF = rf"(?:{_GAP}*[A-Za-z0-9+/]{{16,}}={{0,2}})*(?:{_GAP}+[A-Za-z0-9+/]+(?:=+|(?=[\x20\x09]*(?:[\n\r]|\\[nr]|\Z))))?"
#: Formats that nothing but a credential has.
MORE = (
    Rule("private", _BEGIN, rf"{_BEGIN}{_ENCRYPTED}(?:[A-Za-z0-9+/=\x20\x09-\x0D\\\"'>#*,;]*{_END}|{_CUT_OFF})", far=True),
    Rule("hosting", "gh[pousr]_[A-Za-z0-9]", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[0-9A-Za-z-]", "xox[abprs]-[0-9A-Za-z-]{10,}"),
)
RULES = BASE + MORE


@lru_cache(maxsize=4)
def _compiled(rules: tuple[Rule, ...]) -> tuple[Automaton, list[re.Pattern]]:
    return compile_rules([r.seek for r in rules]), [re.compile(r.pattern.encode()) for r in rules]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES,
                 carry: bool = False, texts: bool = True) -> DataFrame:
    """Secrets in every text: doc_id, spans (kind, start, end in code points, end exclusive; by start, then
    in the order of the rules) and, with `texts`, clean_text, in which merged spans are replaced by
    `[secret]`; one row per row of `docs`.  With `carry` also the whole input row as the struct `row`.

    Hits of one rule are leftmost and do not overlap; hits of different rules may.  A match whose group is
    too short is passed over, and what it covers is not searched again.  Case is folded for ASCII only.

    Nulls: a null text has no spans and stays null.  Repeated rows are scanned each.  Ties (spans with one
    start) follow the order of the rules.  Empty tables give no rows.  Texts are never cut.
    """
    rules = tuple(rules)
    rows = carried(docs, id_col, text_col, carry)
    schema = schema_of("doc_id long, spans array<struct<kind:string,start:long,end:long>>" + ", clean_text string" * texts, rows)

    def search(batches):
        for batch in slices(batches, "text"):
            spans, clean = _scan(batch.column("text"), rules)
            columns = {"doc_id": batch.column("doc_id"), "spans": spans}
            if texts:
                columns["clean_text"] = clean
            if carry:
                columns["row"] = batch.column("row")
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows.mapInArrow(search, schema)


def _scan(texts: pa.Array, rules: tuple[Rule, ...]) -> tuple[pa.Array, pa.Array]:
    automaton, patterns = _compiled(rules)
    buf, offsets = text_bytes(texts)
    place, hits = automaton.ends(buf, offsets)
    text = np.searchsorted(offsets, place, "right") - 1
    rows: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]  # by text: (start, rule, end) in bytes
    for t in np.unique(text):
        mine = text == t if len(place) < 64 else slice(*np.searchsorted(text, [t, t + 1]))
        begin, end = int(offsets[t]), int(offsets[t + 1])
        breaks = np.concatenate([[begin - 1], begin + np.flatnonzero(automaton.breaks[buf[begin:end]]), [end]])
        after = np.searchsorted(breaks, place[mine], "right")
        for k, rule in enumerate(rules):
            stretches = np.unique(after[(hits[mine] >> k & 1).astype(bool)])
            for stretch in stretches[:1] if rule.far else stretches:
                low, high = int(breaks[stretch - 1]) + 1, end if rule.far else int(breaks[stretch])
                for match in patterns[k].finditer(buf[low:high].tobytes()):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        rows[t].append((low + match.start() - begin, k, low + match.end() - begin))
    kinds, starts, ends, sizes = [], [], [], []
    clean = None if not len(place) else texts.to_pylist()
    for t, found in enumerate(rows):
        sizes.append(len(found))
        if not found:
            continue
        found.sort()
        raw = buf[offsets[t]:offsets[t + 1]]
        points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        kinds += [rules[k].kind for _, k, _ in found]
        starts += [int(points[a]) for a, _, _ in found]
        ends += [int(points[b]) for _, _, b in found]
        out, at = [], 0
        raw = raw.tobytes()
        merged: list[list[int]] = []
        for a, _, b in found:
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in merged:
            out += [raw[at:a], b"[secret]"]
            at = b
        clean[t] = (b"".join(out) + raw[at:]).decode()
    spans = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                                       ["kind", "start", "end"])
    return list_array(np.array(sizes, dtype=np.int64), spans), texts if clean is None else pa.array(clean, pa.string())
