"""Chat formatting: conversations rendered by a compiled template, with
reversible escapes and a loss mask, and read back from the output."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chat_template import compile_template

# The control strings of a turn: an opening that holds the role, and an end.
TEMPLATE = ('{% for turn in turns %}{{ "###" ~ " " }}{{ turn.role | name }}: '
            '{% if turn.role == "assistant" %}{% generation %}{{ turn.text | escape }}{% endgeneration %}'
            '{% else %}{{ turn.text | escape }}{% endif %}</turn>\n{% endfor %}')

_SPECIAL = re.compile(r"\\|###|</turn>")
_SPECIAL_NAME = re.compile(r"\\|###|</turn>|:|\n")
_ESCAPED = re.compile(r"\\(.)", re.S)
_END = re.compile(r"(?<!\\)(?:\\\\)*</turn>\n\Z")  # not an escaped one
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)


def escape(text: str) -> str:
    """A backslash before every backslash and control string of a text."""
    return _SPECIAL.sub(r"\\\g<0>", text)


def escape_name(text: str) -> str:
    return _SPECIAL_NAME.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


FILTERS = {"escape": escape, "name": escape_name, "trim": str.strip, "lower": str.lower, "upper": str.upper}


def read_turn(formatted: str) -> tuple[str, str]:
    m = _TURN.fullmatch(formatted)
    if not m:
        raise ValueError("not a formatted turn")
    return unescape(m[1]), unescape(m[2])


def render(turns, template: str = TEMPLATE) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of its loss mask."""
    parts, spans, at = [], [], 0
    for piece, generated in compile_template(template, FILTERS)({"turns": turns}):
        if generated and piece:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(piece))
            else:
                spans.append((at, at + len(piece)))
        parts.append(piece)
        at += len(piece)
    return "".join(parts), spans


def _by_conversation(batches):
    """(conv_id, role, text) rows, sorted by conversation, as (conv_id, turns)
    with the turns read on demand."""
    rows = ((c, r or "", t or "") for b in batches for c, r, t in zip(*(b.column(k).to_pylist() for k in range(3))))
    row = next(rows, None)
    while row is not None:
        key = row[0]

        def turns():
            nonlocal row
            while row is not None and row[0] == key:
                yield {"role": row[1], "text": row[2]}
                row = next(rows, None)
        yield key, turns()


def _summaries(template):
    def run(batches):
        renderer = compile_template(template, FILTERS)
        out = []

        def flush():
            b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], NAMES)
            out.clear()
            return b

        for conv, turns in _by_conversation(batches):
            n, chars, loss_chars = 0, 0, 0
            whole, loss = hashlib.sha256(), hashlib.sha256()
            turn, learned = [], []
            for piece, generated in renderer({"turns": turns}):
                turn.append(piece)
                if generated:
                    learned.append(piece)
                if not generated and _END.search(piece):
                    formatted = "".join(turn)
                    role, text = read_turn(formatted)
                    own = unescape("".join(learned))
                    whole.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    loss.update(own.encode("utf-8", "surrogatepass"))
                    n, chars, loss_chars = n + 1, chars + len(formatted), loss_chars + len(own)
                    turn, learned = [], []
            out.append((conv, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars))
            if len(out) >= 4096:
                yield flush()
        if out:
            yield flush()
    return run


NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _formatted(template):
    def run(batches):
        renderer = compile_template(template, FILTERS)
        for batch in batches:
            text, spans = [], []
            for role, body in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                parts, own, at = [], [], 0
                for piece, generated in renderer({"turns": [{"role": role or "", "text": body or ""}]}):
                    if generated and piece:
                        own.append({"start": at, "end": at + len(piece)})
                    parts.append(piece)
                    at += len(piece)
                text.append("".join(parts))
                spans.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["conv_id", "turn", "formatted", "loss_spans"])
    return run


def format_turns(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, turn, formatted, loss_spans (of the row's text) of every row. A
    conversation's rows, in order, make up its formatted text; so one of any
    length needs no single value, group or task."""
    return (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
            .mapInArrow(_formatted(template), "conv_id long, turn long, formatted string, loss_spans array<struct<start: long, end: long>>"))


def conversation_digests(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars
    per conversation, read back from the formatted output.

    Rows go by turn; of equal turns (and null turns, which come first) by role,
    then text; null role or text counts as empty. Rows with a null conv_id are
    one conversation. Rows are sorted by Spark and rendered one turn at a time,
    so a conversation's length doesn't bound memory. A digest over a
    conversation is sequential; a very long one takes one task that long.
    """
    rows = (conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text"))
    return rows.mapInArrow(_summaries(template), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                                 "loss_sha256 string, formatted_chars long")
