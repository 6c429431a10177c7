"""Chat formatting by event-sourced reconstruction.

Conversations come as logs of events: conv_id, turn, seq, kind, role, text.  Kinds: `message`
starts a message of a turn, `delta` appends to it, `edit` replaces its text, `regenerate`
empties it so that the deltas that follow build it anew; a kind of another name, or one that comes
before any message of its turn, starts a message.  Logs are partitioned by conversation and sorted by turn
and sequence, and one pass folds and renders them: a task holds one message at a time,
however long the conversation.

Format.  An assistant message is `<s>` text `</s>`, any other `[INST]` role `[/ROLE]` text `[/INST]`.
Control strings inside roles and texts get a backslash after their first character, and
backslashes are doubled, so that `read` returns roles and texts exactly.  The loss mask of a
message is the stretch of its (escaped) text, for assistants only.

Defined results.  Null roles and texts are empty; a null turn or seq sorts first; ties sort by
kind, role and text.  A null conv_id is a conversation of its own.  Repeated rows are messages
each.  An empty table gives no rows.  A text of any length is one message, held whole.  Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings of the format.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[/ROLE]")
_ESCAPE = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_UNESCAPE = re.compile(r"\\(\\?)")
_MESSAGE = re.compile(r"<s>(.*?)</s>|\[INST\](.*?)\[/ROLE\](.*?)\[/INST\]", re.S)
FORMATTED = "conv_id long, part long, formatted string, loss_start int, loss_end int"
EVENTS = ("conv_id", "turn", "seq", "kind", "role", "text")
ASSISTANT = "assistant"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted message, and its loss mask as code point offsets (equal if there is none)."""
    body = escape(text)
    if role == ASSISTANT:
        return f"<s>{body}</s>", 3, 3 + len(body)
    head = f"[INST]{escape(role)}[/ROLE]"
    return f"{head}{body}[/INST]", len(head), len(head)


def read(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) messages of formatted text."""
    return [(ASSISTANT, unescape(m[1])) if m[1] is not None else (unescape(m[2]), unescape(m[3])) for m in _MESSAGE.finditer(formatted)]


def _fold(batches):
    conv, turn, role, pieces, part, begun = None, None, "", [], 0, False
    out: list[tuple] = []
    size = 0

    def flush():
        nonlocal part, size
        text, start, end = render(role, "".join(pieces))
        out.append((conv, part, text, start, end))
        part += 1
        size += len(text)

    def batch():
        columns = list(zip(*out, strict=True)) or [[]] * 5
        types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["conv_id", "part", "formatted", "loss_start", "loss_end"])

    for events in batches:
        for c, t, kind, r, text in zip(*(events.column(name).to_pylist() for name in ("conv_id", "turn", "kind", "role", "text")), strict=True):
            fresh = not begun or c != conv or t != turn or kind not in ("delta", "edit", "regenerate")
            if fresh:
                if begun:
                    flush()
                if not begun or c != conv:
                    part = 0
                conv, turn, role, pieces, begun = c, t, r or "", [text or ""], True
            elif kind == "delta":
                pieces.append(text or "")
            else:
                pieces = [text or ""] if kind == "edit" else []
            if size > 1 << 20:
                yield batch()
                out.clear()
                size = 0
    if begun:
        flush()
    yield batch()


def format_events(events: DataFrame) -> DataFrame:
    """The formatted conversations, one row for each message: conv_id, part, formatted, loss_start, loss_end.

    A conversation's rows are in one partition, in order; joined, they are its formatted text.
    """
    rows = events.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "seq", "kind", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions(*EVENTS)
    return rows.mapInArrow(_fold, FORMATTED)


def as_events(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as events: each is a message."""
    return conversations.select("conv_id", "turn", F.lit(0).alias("seq"), F.lit("message").alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _digest(batches):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    conv, begun = None, False
    state: list = []

    def fresh():
        return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

    def row():
        n, turns, chars, loss, total = state
        return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), total)

    for batch in batches:
        out = []
        for c, text, start, end in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "formatted", "loss_start", "loss_end")), strict=True):
            if not begun or c != conv:
                if begun:
                    out.append(row())
                conv, begun, state = c, True, fresh()
            for role, body in read(text):
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
            masked = unescape(text[start:end])
            state[2] += len(masked)
            state[3].update(masked.encode())
            state[4] += len(text)
        yield _rows(out, names)
    if begun:
        yield _rows([row()], names)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def digests(formatted: DataFrame) -> DataFrame:
    """Digests of what is read back from the formatted rows of each conversation."""
    return formatted.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
