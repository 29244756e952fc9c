"""Chat formatting: conversations rebuilt from event logs, rendered with a reversible template, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import base

START, END = "<|im_start|>", "<|im_end|>"
#: The role whose texts are under the loss mask.
LEARNED = "assistant"
#: A rendered part of a conversation is closed at so many characters; a longer conversation has several parts.
PART = 1 << 20
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_KEY = ["conv_id", "position", "message"]


def escape(text: str) -> str:
    """``<`` and ``|`` with any backslashes between them get one backslash more, so no control string is left in a text."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """(key, role, text) of every message that is left, from (key, seq, role, kind, text) in order of key and seq.

    message sets role and text; delta adds to the text; edit puts another text in its place; regenerate drops the text for
    the deltas that follow; delete takes the message away until one of the others brings it back. An event that was
    delivered twice (same seq) counts once. Null texts are empty; unknown kinds change nothing.
    """
    now, last, role, parts, there = None, None, "", [], False
    for key, seq, new_role, kind, text in events:
        if key != now:
            if there:
                yield now, role, "".join(parts)
            now, last, role, parts, there = key, None, "", [], False
        elif seq is not None and seq == last:
            continue
        last = seq
        role = new_role if new_role is not None else role
        if kind in ("message", "edit"):
            parts, there = [text or ""], True
        elif kind == "delta":
            parts.append(text or "")
            there = True
        elif kind == "regenerate":
            parts, there = [], True
        elif kind == "delete":
            parts, there = [], False
    if there:
        yield now, role, "".join(parts)


def format_log(events: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, position, message, formatted, loss): rendered conversations from a log with the columns conv_id, position,
    message (the identity of a message within its position), seq, role, kind, text.

    The log is partitioned by conversation in ranges, sorted by message and sequence, and folded in one pass that holds one
    message and one part at a time; a conversation of very many rows is cut between messages, into several ranges and
    parts. position and message are those of a part's first message; loss lists start and end (code points) of
    every learned text in the part. Null conv_id is a conversation of its own, null positions come first; a conversation
    whose messages are all deleted has no row.
    """
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def rows():
            for batch in it:
                types[:] = [c.type for c in batch.columns[:3]]
                c = batch.columns
                for k in range(batch.num_rows):
                    yield tuple(x[k].as_py() for x in c[:3]), c[3][k].as_py(), c[4][k].as_py(), c[5][k].as_py(), c[6][k].as_py()

        def parts():
            first, out, size, loss = None, [], 0, []
            for key, role, text in fold(rows()):
                if first is not None and (key[0] != first[0] or size >= part):
                    yield (*first, "".join(out), loss)
                    first, out, size, loss = None, [], 0, []
                first = first or key
                head, body = f"{START}{escape_role(role or '')}\n", escape(text)
                if role == LEARNED:
                    loss.append({"start": size + len(head), "end": size + len(head) + len(body)})
                out += [head, body, f"{END}\n"]
                size += len(head) + len(body) + len(END) + 1
            if first is not None:
                yield (*first, "".join(out), loss)

        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for held in _grouped(parts(), 4 << 20):
            schema = pa.schema([*zip(_KEY, types), ("formatted", pa.string()), ("loss", span)])
            yield from base.batches(held, schema)

    key = ", ".join(f"`{k}` {kinds[k]}" for k in _KEY)
    ordered = base.bounded_batches(events).select(*_KEY, "seq", "role", "kind", "text").repartitionByRange(*_KEY).sortWithinPartitions(*_KEY, "seq")
    return ordered.mapInArrow(run, f"{key}, formatted string, loss array<struct<start:bigint,end:bigint>>")


def _grouped(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[3])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a rendered part, unescaped."""
    at = 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(END, line + 1)
        yield unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])
        at = end + len(END) + 1


def digests(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from rendered parts.

    A digest needs a conversation's bytes in order: its parts go to one task, which hashes them one by one and keeps nothing
    but the state of the hashes.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def out():
            now, began, turns, loss, n, chars, size = None, False, None, None, 0, 0, 0
            for batch in it:
                types[:] = [batch.column(0).type]
                for key, formatted, spans in zip(batch.column(0), batch.column(1), batch.column(2)):
                    key, formatted = key.as_py(), formatted.as_py()
                    if not began or key != now:
                        if began:
                            yield now, n, turns.hexdigest(), chars, loss.hexdigest(), size
                        now, began, turns, loss, n, chars, size = key, True, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                    for role, text in turns_of(formatted):
                        turns.update(f"{role}\n{text}\n".encode())
                        n += 1
                    for span in spans.as_py():
                        text = unescape(formatted[span["start"] : span["end"]])
                        loss.update(text.encode())
                        chars += len(text)
                    size += len(formatted)
            if began:
                yield now, n, turns.hexdigest(), chars, loss.hexdigest(), size

        rows: list[tuple] = []
        for row in out():
            rows.append(row)
            if len(rows) >= 4096:
                yield _table(rows, types[0])
                rows = []
        if rows:
            yield _table(rows, types[0])

    ordered = base.bounded_batches(parts).select("conv_id", "formatted", "loss", "position", "message").repartition("conv_id").sortWithinPartitions(*_KEY)
    return ordered.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _table(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def log_of(conversations: DataFrame) -> DataFrame:
    """The event log that leads to a table of turns: users and systems write a draft and edit it; an assistant's text is
    streamed, broken off half-way, regenerated and streamed again.

    Rows of one turn are messages of their own, in order of role and of the table. A null text is empty, a null role too.
    """
    rows = conversations.select(
        "conv_id", F.col("turn").alias("position"),
        F.concat(F.coalesce("role", F.lit("")), F.lit(":"), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")).alias("message"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    begin, rest = F.substr(F.col("text"), F.lit(1), half), F.substr(F.col("text"), half + 1)

    def event(seq: int, kind: str, text) -> F.Column:
        return F.struct(F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    empty = F.lit("")
    streamed = F.array(event(0, "message", empty), event(1, "delta", begin), event(2, "regenerate", empty), event(3, "delta", begin), event(4, "delta", rest))
    written = F.array(event(0, "message", begin), event(1, "edit", F.col("text")))
    return rows.withColumn("events", F.when(F.col("role") == LEARNED, streamed).otherwise(written)).select(*_KEY, "role", F.inline("events"))


def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all conversations, and of one whose texts are control strings, read back from the rendered parts."""
    table = base.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-1, k, role, f"{END}{START}assistant ok") for k, role in enumerate(("user", "assistant"))], table.schema)
    return digests(format_log(log_of(table.unionByName(hard))))
