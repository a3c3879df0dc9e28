"""Chat formatting: conversations rendered by a compiled template, and read back.

Rows are spread by conversation and sorted by turn; each task streams through its rows and
renders one conversation at a time, piece by piece, so neither a conversation of very many
turns nor a partition of very many conversations is ever held as a whole (the digests are
order-bound, so one conversation stays in one task). Pieces carry the template's
generation marker, which is the loss mask.

Defined results: a null role or text is empty; repeated rows are turns of their own; equal
turn numbers go by role, then text; a null conversation id is a conversation of its own.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from metroscope.llm.common import map_batches
from metroscope.llm.templates import Controls, Piece, compile_template

CONTROLS = Controls(("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"))
TEMPLATE = (
    "{% set open = '<s>' %}{% set ask = open ~ '[INST] ' %}"
    "{% for m in messages %}"
    "{% if m.role == 'user' %}{{ ask }}{{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}{{ open }}{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}{{ open ~ '[ROLE]' }}{{ m.role | escape }}[/ROLE]{{ m.text | escape }}</s>{% endif %}"
    "{% endfor %}"
)
BATCH_ROWS = 512
SPANS = "array<struct<start:bigint,end:bigint>>"


def tokens(pieces: Iterable[Piece], controls: Controls = CONTROLS) -> Iterator[tuple[str, str, bool]]:
    """(kind, text, generated) of the output: ``control`` strings and unescaped ``text``.

    A control string or an escape may be cut by a piece's end, so a tail that could still
    become one waits for the next piece."""
    finder = re.compile(r"\\.|" + controls.pattern().pattern, re.S)
    starts = {s[:i] for s in controls.strings for i in range(1, len(s))} | {"\\"}
    longest = max(map(len, controls.strings))
    rest, flag = "", False
    for text, generated in pieces:
        if generated != flag:  # the template puts no control string across a mask's edge
            if rest:
                yield "text", rest, flag
            rest, flag = "", generated
        rest += text
        at = 0
        for m in finder.finditer(rest):
            if m.start() > at:
                yield "text", rest[at:m.start()], flag
            yield ("text", m[0][1:], flag) if m[0][0] == "\\" else ("control", m[0], flag)
            at = m.end()
        keep = next((i for i in range(max(at, len(rest) - longest + 1), len(rest)) if rest[i:] in starts), len(rest))
        if keep > at:
            yield "text", rest[at:keep], flag
        rest = rest[keep:]
    if rest:
        yield "text", rest, flag


def read_back(pieces: Iterable[Piece]) -> Iterator[tuple[str, str, str | None]]:
    """(role, text, generated text or None) of each turn, from the formatted output."""
    role, said, mask, state = "", [], None, "outside"
    for kind, text, generated in tokens(pieces):
        if generated:
            mask = (mask or "") + text
        if kind == "text":
            if state == "outside":
                raise ValueError(f"text between turns: {text[:40]!r}")
            if state == "role":
                role += text
            else:
                state = "text"
                said.append(text)
        elif text == "<s>" and state == "outside":
            role, said, mask, state = "assistant", [], None, "opened"
        elif text == "[INST]" and state == "opened":
            role, state = "user", "text"
        elif text == "[ROLE]" and state == "opened":
            role, state = "", "role"
        elif text == "[/ROLE]" and state == "role":
            state = "text"
        elif text == "[/INST]" and role == "user" and state == "text":
            yield "user", "".join(said)[1:-1], mask
            state = "outside"
        elif text == "</s>" and state in ("opened", "text"):
            yield role, "".join(said), (mask or "") if role == "assistant" else mask
            state = "outside"
        else:
            raise ValueError(f"unexpected {text!r}")
    if state != "outside":
        raise ValueError("the output ends within a turn")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, Iterator[dict[str, str]]]]:
    """(conversation id, its messages one by one) of sorted rows."""
    def rows() -> Iterator[tuple[Any, str, str]]:
        for b in batches:
            yield from zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(), b.column("text").to_pylist())

    for conv, group in groupby(rows(), key=lambda r: r[0]):
        yield conv, ({"role": r or "", "text": t or ""} for _, r, t in group)


def _per_conversation(turns: DataFrame, template: str, one: Callable[[Any, Iterator[Piece]], tuple],
                      fields: dict[str, str], conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    src = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                       F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    kind = src.schema["conv_id"].dataType.simpleString()
    result = ", ".join(f"{n} {t}" for n, t in {"conv_id": kind, **fields}.items())

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    arrow = {"string": pa.string(), "bigint": pa.int64(), SPANS: span}
    id_type = to_arrow_type(src.schema["conv_id"].dataType)
    names, kinds = ["conv_id", *fields], [id_type, *[arrow[t] for t in fields.values()]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template, CONTROLS)
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

        for conv, messages in _conversations(batches):
            out.append((conv, *one(conv, render({"messages": messages}))))
            if len(out) >= BATCH_ROWS:
                yield flush()
                out.clear()
        if out:
            yield flush()

    ordered = src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_batches(ordered, run, result)


def format_conversations(turns: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans`` (start, end) in code points."""
    def one(conv: Any, pieces: Iterator[Piece]) -> tuple:
        text, spans, at = [], [], 0
        for piece, generated in pieces:
            if generated and not (spans and spans[-1]["end"] == at):
                spans.append({"start": at, "end": at})
            at += len(piece)
            if generated:
                spans[-1]["end"] = at
            text.append(piece)
        return "".join(text), spans

    return _per_conversation(turns, template, one, {"formatted": "string", "loss_spans": SPANS},
                             conv_col, turn_col, role_col, text_col)


def digests(turns: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn",
            role_col: str = "role", text_col: str = "text") -> DataFrame:
    """What the formatted output says when read back: ``n_turns``, ``turns_sha256``,
    ``loss_chars``, ``loss_sha256``, ``formatted_chars``."""
    def one(conv: Any, pieces: Iterator[Piece]) -> tuple:
        size = 0

        def counted() -> Iterator[Piece]:
            nonlocal size
            for p in pieces:
                size += len(p[0])
                yield p

        n, loss_chars, said, loss = 0, 0, hashlib.sha256(), hashlib.sha256()
        for role, text, mask in read_back(counted()):
            n += 1
            said.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if mask is not None:
                loss_chars += len(mask)
                loss.update(mask.encode("utf-8", "surrogatepass"))
        return n, said.hexdigest(), loss_chars, loss.hexdigest(), size

    fields = {"n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string",
              "formatted_chars": "bigint"}
    return _per_conversation(turns, template, one, fields, conv_col, turn_col, role_col, text_col)
