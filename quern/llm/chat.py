"""Chat formatting from an event log.

A conversation log holds events (conv_id, message, turn, role, seq, kind, text), where ``kind`` is
``delta`` (text is appended to the message), ``edit`` (text replaces the message) or ``regenerate``
(the message starts anew). The operator partitions the log by message, sorts it by sequence and
folds it into final messages; then partitions messages by conversation, sorts them by turn and renders.

Both folds run over sorted partitions as streams that carry one open message or conversation across
Arrow batches, so memory doesn't grow with a conversation; a hot conversation's events are spread over
tasks by message, only its rendered text is brought into one order by one task, which a digest of the
whole conversation needs. Rendering yields parts (one row a turn), never one giant string.

Template: ``### Role: text</turn>`` and a line break for each turn. In roles and texts, backslash, ``<``
and ``#`` are written ``\\b``, ``\\l`` and ``\\h`` (a colon in a role ``\\c``), so neither ``### `` nor
``</turn>`` can occur inside one, and unescaping gives back exactly what went in. The loss mask covers
the text (not the marks) of assistant turns.

Defined results: events of a message with equal seq count once, and its last event gives its turn and role (see ``fold_messages``); null text and null role are empty; a null conv_id is a conversation of its own; null
turns come first; equal turns are ordered by role, then text; repeated rows are turns of their own;
an empty log gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_CODES = {"\\": "\\b", "<": "\\l", "#": "\\h"}
_ROLE_CODES = _CODES | {":": "\\c"}
_BACK = {v[1]: k for k, v in _ROLE_CODES.items()}
_TURN = re.compile(r"### ([^#<:]*): ([^#<]*)</turn>\n")


def escape(text: str, codes: dict[str, str] = _CODES) -> str:
    return re.sub(r"[\\<#:]", lambda m: codes.get(m[0], m[0]), text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text)


def render_turn(role: str, text: str) -> str:
    return f"{OPEN}{escape(role, _ROLE_CODES)}{MIDDLE}{escape(text)}{CLOSE}"


def loss_span(role: str, text: str, start: int) -> tuple[int, int]:
    """The stretch of a rendered turn beginning at ``start`` that is learned from; empty unless the assistant speaks."""
    begin = start + len(OPEN) + len(escape(role, _ROLE_CODES)) + len(MIDDLE)
    return (begin, begin + len(escape(text))) if role == "assistant" else (begin, begin)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """role, text, and begin and end of the escaped text of each turn; inverse of rendering."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        out.append((unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation from position {at}")
    return out


def fold(events: Iterable[tuple[str, str]]) -> str:
    """Final text of a message from its (kind, text) events in sequence."""
    parts: list[str] = []
    for kind, text in events:
        if kind != "delta":
            parts.clear()
        if kind != "regenerate":
            parts.append(text)
    return "".join(parts)


def _runs(batches: Iterable[pd.DataFrame], key: list[str]) -> Iterator[tuple[tuple, Iterator]]:
    """Rows of sorted batches, by key; the rows of one key may span batches."""
    import itertools

    rows = (r for b in batches for r in b.itertuples(index=False))
    n = len(key)
    return itertools.groupby(rows, key=lambda r: tuple(None if x is None or x != x else x for x in r[:n]))


def _settled(rows: Iterable) -> Iterator:
    """Events in sequence, the last of those with equal seq."""
    last = None
    for r in rows:
        if last is not None and not (r.seq == last.seq or pd.isna(r.seq) and pd.isna(last.seq)):
            yield last
        last = r
    if last is not None:
        yield last


def fold_messages(events: DataFrame) -> DataFrame:
    """conv_id, message, turn, role, text of every message in the log.

    An event counts once: of those with equal seq (null is one, before all others) the last by kind, text, turn and role
    stands, so a replayed delta changes nothing. The message's turn and role are those of its last event.
    """
    ids = [f"{c} {events.schema[c].dataType.simpleString()}" for c in ("conv_id", "message", "turn")]
    columns = ["conv_id", "message", "turn", "role", "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for (conv, message), rows in _runs(batches, ["conv_id", "message"]):
            last = None

            def parts():
                nonlocal last
                for last in _settled(rows):  # noqa: B007, B023
                    yield last.kind, last.text or ""

            text = fold(parts())
            out.append((conv, message, None if pd.isna(last.turn) else last.turn, last.role or "", text))
            if len(out) >= 1000:
                yield _frame(out, columns)
                out = []
        if out:
            yield _frame(out, columns)

    log = events.select("conv_id", "message", "turn", "role", "kind", "text", "seq")
    log = log.repartition("conv_id", "message").sortWithinPartitions("conv_id", "message", "seq", "kind", "text", "turn", "role")
    return log.mapInPandas(run, f"{', '.join(ids)}, role string, text string")


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns, dtype=object)


def render(messages: DataFrame) -> DataFrame:
    """conv_id, place (0..), role, part, start, loss_start, loss_stop: the formatted conversation in parts, in order.

    Positions are code points of the whole formatted conversation.
    """
    conv = f"conv_id {messages.schema['conv_id'].dataType.simpleString()}"
    columns = ["conv_id", "place", "role", "part", "start", "loss_start", "loss_stop"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for (conv_id,), rows in _runs(batches, ["conv_id"]):
            at = 0
            for place, r in enumerate(rows):
                role, text = r.role or "", r.text or ""
                part = render_turn(role, text)
                out.append((conv_id, place, role, part, at, *loss_span(role, text, at)))
                at += len(part)
                if len(out) >= 1000:
                    yield _frame(out, columns)
                    out = []
        if out:
            yield _frame(out, columns)

    ordered = messages.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInPandas(run, f"{conv}, place long, role string, part string, start long, loss_start long, loss_stop long")


DIGESTS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def read_back(rendered: DataFrame) -> DataFrame:
    """One row a conversation, from its parts as ``render`` leaves them: parsed, unescaped and digested as they stream by."""
    conv = f"conv_id {rendered.schema['conv_id'].dataType.simpleString()}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for (conv_id,), rows in _runs(batches, ["conv_id"]):
            turns, loss, n, n_loss, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for r in rows:
                chars += len(r.part)
                for role, text, _, _ in parse(r.part):
                    n += 1
                    turns.update(f"{role}\n{text}\n".encode())
                learned = unescape(r.part[int(r.loss_start - r.start) : int(r.loss_stop - r.start)])
                n_loss += len(learned)
                loss.update(learned.encode())
            out.append((conv_id, n, turns.hexdigest(), n_loss, loss.hexdigest(), chars))
            if len(out) >= 1000:
                yield _frame(out, DIGESTS)
                out = []
        if out:
            yield _frame(out, DIGESTS)

    return rendered.mapInPandas(run, f"{conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def as_events(conversations: DataFrame) -> DataFrame:
    """A log that yields these messages: each text streams in two deltas; every third assistant turn is first
    generated otherwise and regenerated, every third user turn is first sent half and then edited."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("message", F.monotonically_increasing_id())
    event = "struct({} as seq, '{}' as kind, {} as text)"
    half = "int(length(text) / 2)"
    deltas = [event.format(7, "delta", f"left(text, {half})"), event.format(8, "delta", f"substring(text, {half} + 1)")]
    again = [event.format(1, "delta", f"left(text, {half})"), event.format(2, "delta", "'...'"), event.format(3, "regenerate", "''"), *deltas]
    edited = [event.format(1, "delta", f"left(text, {half})"), event.format(2, "edit", "text")]
    kind = f"case when pmod(length(text), 3) != 0 then array({', '.join(deltas)}) when role = 'assistant' then array({', '.join(again)}) else array({', '.join(edited)}) end"
    return rows.withColumn("e", F.explode(F.expr(kind))).select("conv_id", "message", "turn", "role", "e.seq", "e.kind", "e.text")


PROBE = "\\### Assistant: </turn> ok"


def op6_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    messages = fold_messages(as_events(conversations.unionByName(probe)))
    return read_back(render(messages))


QUERIES = {"op6_event_sourced_chat": op6_event_sourced_chat}
ORACLE: dict[str, str] = {}
