"""Chat formatting from event logs.

A log has events of messages.  It is partitioned by conversation and sorted by message and sequence number;
one streaming pass folds the events into final messages, one message in memory at a time.  Messages are then
rendered with a template whose control strings cannot be forged by a text.

Events (conv_id, message, seq, kind, role, text), in the order of seq:

* `message`: the message has this role and text.
* `delta`: the text goes to the end of the message's text.
* `edit`: the text takes the place of the message's text.
* `regenerate`: the message's text is emptied, and earlier events of all later messages are void.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"
KINDS = ("message", "delta", "edit", "regenerate")
_FORGED, _ESCAPED = r"<(\\*)\|", r"<(\\*)\\\|"
EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"


def _rows(batches) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, text: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text] or "") + 64
        if size > most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_MESSAGES = pa.schema([("conv_id", pa.int64()), ("message", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def fold_events(events: DataFrame, ordered: bool = False) -> DataFrame:
    """Final messages (conv_id, message, role, text), partitioned by conversation and in order in each partition.

    A message that has no event left is gone.  Nulls: a null conv_id is one conversation, a null message or
    seq sorts first, null texts are empty, null or unknown kinds do nothing, and a null role leaves the role
    as it is (empty at first).  Repeated events apply again; ties of seq go by kind, role and text.  Empty
    tables give no rows.  A conversation is streamed, so it may be longer than a task's memory; one message
    may not.  With `ordered` the caller has partitioned and sorted the events, and they are streamed as they come.
    """
    columns = ["conv_id", "message", "seq", "kind", "role", "text"]
    rows = events.select(*columns)
    if not ordered:
        rows = rows.repartition("conv_id").sortWithinPartitions(*columns)

    def fold(batches):
        def messages():
            key, held, chat, cut = None, [], None, None
            for row in _rows(batches):
                now = (row["conv_id"], row["message"])
                if held and now != key:
                    if key[0] != chat:
                        chat, cut = key[0], None
                    cut = _cut(held, cut)
                    yield from _folded(held, cut)
                    held = []
                key = now
                held.append(row)
            if held:
                yield from _folded(held, _cut(held, cut if key[0] == chat else None))

        return _batches(messages(), _MESSAGES, "text")

    return rows.mapInArrow(fold, "conv_id long, message long, role string, text string")


def _cut(held: list[dict], cut):
    """The last seq at which this message or one before it was regenerated."""
    again = [row["seq"] for row in held if row["kind"] == "regenerate" and row["seq"] is not None]
    return max(again + ([] if cut is None else [cut]), default=None)


def _folded(held: list[dict], cut) -> Iterator[dict]:
    role, parts, alive = "", [], False
    for row in held:
        role = row["role"] if row["role"] is not None and row["kind"] in KINDS else role
        if row["kind"] not in KINDS or cut is not None and (row["seq"] is None or row["seq"] < cut):
            continue
        alive = True
        if row["kind"] != "delta":
            parts = []
        if row["kind"] != "regenerate":
            parts.append(row["text"] or "")
    if alive:
        yield {"conv_id": held[0]["conv_id"], "message": held[0]["message"], "role": role, "text": "".join(parts)}


def render(messages: DataFrame) -> DataFrame:
    """Adds `formatted` (the message as a turn of the template), and `loss_begin`, `loss_end`: the code points of
    `formatted` that are under the loss mask (the text of assistants; else null).

    The turns of a conversation, in order and with nothing between, are its formatted text.  Between `<` and
    `|` in a text goes one backslash more than it has there, so no control string is left in it and `unescape`
    gives the text back; backslashes and line ends in a role are written `\\\\` and `\\n`.
    """
    role = F.regexp_replace(F.replace(F.replace(F.coalesce("role", F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), _FORGED, r"<$1\\|")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), _FORGED, r"<$1\\|")
    head = F.concat(F.lit(BEGIN), role, F.lit("\n"))
    assistant = F.col("role") == "assistant"
    return messages.withColumns({
        "formatted": F.concat(head, text, F.lit(END + "\n")),
        "loss_begin": F.when(assistant, F.length(head)),
        "loss_end": F.when(assistant, F.length(head) + F.length(text))})


def unescape(text: str) -> str:
    return re.sub(_ESCAPED, r"<\1|", text)


def _role(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


_TURN = re.compile(re.escape(BEGIN) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(rendered: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of each conversation, read from
    the formatted text and the loss mask alone, as a stream over `render(fold_events(...))`.

    turns_sha256 is over role, line end, text, line end of each turn; loss_chars and loss_sha256 over the
    unescaped text under the mask; all in UTF-8.
    """
    def read(batches):
        def chats():
            now, state = None, None
            for row in _rows(batches):
                if state is None or row["conv_id"] != now:
                    if state is not None:
                        yield _closed(now, state)
                    now, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                state[4] += len(text)
                at = 0
                while at < len(text):
                    turn = _TURN.match(text, at)
                    if not turn:
                        raise ValueError(f"no turn at {at} of a formatted message of conversation {now}")
                    state[0] += 1
                    state[1].update(f"{_role(turn[1])}\n{unescape(turn[2])}\n".encode())
                    at = turn.end()
                if row["loss_begin"] is not None:
                    under = unescape(text[row["loss_begin"]:row["loss_end"]])
                    state[2] += len(under)
                    state[3].update(under.encode())
            if state is not None:
                yield _closed(now, state)

        return _batches(chats(), _DIGEST, "turns_sha256")

    return rendered.select("conv_id", "formatted", "loss_begin", "loss_end").mapInArrow(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _closed(conv_id, state) -> dict:
    return {"conv_id": conv_id, "n_turns": state[0], "turns_sha256": state[1].hexdigest(), "loss_chars": state[2],
            "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4]}
