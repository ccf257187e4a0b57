"""Conversations as training text, by a compiled template, and the way back.

Each turn is `<|im_start|>role`, a line feed, the text, `<|im_end|>` and a line feed. Inside roles and
texts every `<`, any number of backslashes and `|` gets one backslash more, so that no control string
can arise from them, and taking one away restores them. What the template marks as generation, the
texts of assistants, carries the loss.

Turns stand in the order of turn, then role, then text, so that equal turn numbers have one order;
null turns come first. Null roles and texts are empty. Rows without conv_id form one conversation.
Repeated rows are repeated turns. A conversation is one row of output and is held whole by one task;
rows come in as a sorted stream, so no more than one conversation is in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelscope.llm.templates import compile_template

START, END = "<|im_start|>", "<|im_end|>"
CHAT_TEMPLATE = (
    "{% for m in messages %}<|im_start|>{{ m.role | escape_role }}{{ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}<|im_end|>{{ '\\n' }}{% endfor %}"
)
_OPENING, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_BATCH = 256


def escape(text: str) -> str:
    return _OPENING.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


FILTERS = {"escape": escape, "escape_role": escape_role}


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        line, stop = formatted.index("\n", at), formatted.index(END, at)
        if not formatted.startswith(START, at) or line > stop:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : stop])))
        at = stop + len(END) + 1
    return turns


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[dict]]]:
    """Conversations of a stream sorted by conv_id."""
    current, messages, begun = None, [], False
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]
        for conv, role, text in zip(*columns):
            if not begun or conv != current:
                if begun:
                    yield current, messages
                current, messages, begun = conv, [], True
            messages.append({"role": role, "text": text})
    if begun:
        yield current, messages


def format_conversations(rows: DataFrame, template: str = CHAT_TEMPLATE) -> DataFrame:
    """(conv_id, formatted, spans) of `rows` (conv_id, turn, role, text); spans are [start, end) in code points."""
    compile_template(template, FILTERS)  # a wrong template fails here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, FILTERS)
        done: list[tuple] = []

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            ids, texts, spans = zip(*done)
            spans = [[{"start": a, "end": b} for a, b in s] for s in spans]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, kind)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "spans"])

        for conv, messages in _conversations(batches):
            done.append((conv, *render({"messages": messages})))
            if len(done) >= _BATCH:
                yield batch_of(done)
                done = []
        if done:
            yield batch_of(done)

    empty = F.lit("")
    ordered = (
        rows.select(
            F.col("conv_id").cast("long"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(run, "conv_id long, formatted string, spans array<struct<start: long, end: long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations say, from their text and spans alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("spans").to_pylist()):
                turns = read_turns(text)
                said, loss = hashlib.sha256(), hashlib.sha256()
                for role, words in turns:
                    said.update(f"{role}\n{words}\n".encode("utf-8", "surrogatepass"))
                n_loss = 0
                for span in spans:
                    words = unescape(text[span["start"] : span["end"]])
                    n_loss += len(words)
                    loss.update(words.encode("utf-8", "surrogatepass"))
                rows.append((len(turns), said.hexdigest(), n_loss, loss.hexdigest(), len(text)))
            n, said, n_loss, loss, chars = zip(*rows) if rows else ((),) * 5
            columns = [batch.column("conv_id"), pa.array(n, pa.int64()), pa.array(said, pa.string())]
            columns += [pa.array(n_loss, pa.int64()), pa.array(loss, pa.string()), pa.array(chars, pa.int64())]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(run, schema)
