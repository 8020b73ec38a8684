"""Conversations as one string each, with the place of every turn in it found from outside the template.

A template is a black box: any function from a list of turns to a string. It is given every prefix of a conversation in
turn. What a longer prefix adds is the new turn's span, if the output begins with the output before it; if not, the
template rewrites history, and the turn at which it did is reported. Where a text stands inside its span is found by
rendering the prefix with two different one-letter texts in its place: the outputs differ only there.

Rows come to one task by conversation, sorted there, and are read as a stream: a task holds one conversation. Rendering
all prefixes of n turns takes time by n squared, as the method has it; memory is that of two outputs.

Defined cases: null text is empty, null role is kept apart from the empty one. Turns go by turn number (null first), then
role, then text, so the order of rows does not matter, and repeated rows are repeated turns. Rows whose id is null are one
conversation. Of the columns only these four are read. Of a conversation whose history is rewritten the string is still
the output for all turns, but it has no spans, and nothing of it is under the loss mask.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderlake.llm.frames import appended


@dataclass(frozen=True)
class Turn:
    role: str | None
    text: str


Template = Callable[[Sequence[Turn]], str]

#: Marks around the texts of the roles that have marks of their own.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE_MARK, ROLE_END = "[ROLE", "[/ROLE]"
CONTROLS = (*(mark for pair in MARKS.values() for mark in pair), ROLE_MARK, ROLE_END)

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_HEAD = re.compile(r"\[SYS\]|\[INST\]|<s>|\[ROLE(?:=((?:\\.|[^\\\]])*))?\]", re.DOTALL)
_ROLE_OF = {begin: (role, end) for role, (begin, end) in MARKS.items()}


def escape(text: str) -> str:
    """``text`` without control strings: backslashes are doubled, and one is put into every control string."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def _marked(turn: Turn) -> str:
    if turn.role in MARKS:
        begin, end = MARKS[turn.role]
    else:
        name = "" if turn.role is None else "=" + turn.role.replace("\\", "\\\\").replace("]", "\\]")
        begin, end = f"{ROLE_MARK}{name}]", ROLE_END
    return f"{begin}{escape(turn.text)}{end}"


def marked_turns(turns: Sequence[Turn]) -> str:
    """The template of the registered query: every turn between the marks of its role, control strings escaped."""
    return "".join(map(_marked, turns))


def parse_marked(formatted: str) -> list[Turn]:
    """The turns of an output of ``marked_turns``."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        if not head:
            raise ValueError(f"no turn begins at {at}")
        role, end = _ROLE_OF.get(head[0], (None, ROLE_END))
        if head[0].startswith(ROLE_MARK) and head[1] is not None:
            role = unescape(head[1])
        stop = formatted.index(end, head.end())
        turns.append(Turn(role, unescape(formatted[head.end() : stop])))
        at = stop + len(end)
    return turns


def _text_place(template: Template, turns: Sequence[Turn], start: int, output: str) -> tuple[int, int]:
    """Where the text of the last of ``turns`` stands in ``output``, whose span begins at ``start``.

    A text that the template leaves out stands, with no length, at the end.
    """
    one, two = (template([*turns[:-1], Turn(turns[-1].role, letter)])[start:] for letter in "ab")
    if one == two:
        return len(output), len(output)
    before = next(i for i, (x, y) in enumerate(zip(one, two, strict=False)) if x != y)
    after = next(i for i, (x, y) in enumerate(zip(reversed(one), reversed(two), strict=False)) if x != y)
    return start + before, len(output) - after


@dataclass(frozen=True)
class Rendered:
    """The output for all turns, spans of each turn and its text, and the first turn that changed what stood before."""

    output: str
    spans: list[tuple[int, int, int, int]] | None
    rewritten_at: int | None


def render_prefixes(template: Template, turns: Sequence[Turn]) -> Rendered:
    before = template([])
    spans: list[tuple[int, int, int, int]] = []
    for k in range(1, len(turns) + 1):
        output = template(turns[:k])
        if not output.startswith(before):
            return Rendered(template(turns), None, k - 1)
        spans.append((len(before), len(output), *_text_place(template, turns[:k], len(before), output)))
        before = output
    return Rendered(before, spans, None)


SPANS = "array<struct<role: string, start: bigint, stop: bigint, text_start: bigint, text_stop: bigint>>"
_PLACES = ("start", "stop", "text_start", "text_stop")
_SPANS = pa.list_(pa.struct([("role", pa.string()), *((name, pa.int64()) for name in _PLACES)]))
_FLUSH = 1 << 22  # characters of output put into one batch


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Turn]]]:
    """Id and turns of one conversation after another, from sorted rows of (id, role, text)."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for number, group in groupby(rows, key=lambda row: row[0]):
        yield number, [Turn(role, text) for _, role, text in group]


def format_chats(
    chats: DataFrame,
    template: Template = marked_turns,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row a conversation: its id, ``formatted``, ``spans`` of its turns and of their texts, ``rewritten_at``.

    Places are characters of ``formatted``; ``rewritten_at`` is the number (from 0) of the first turn with which the
    template changed what it had put out before, null if there is none.
    """
    names = ("id", "turn", "role", "text")
    given = zip((id_col, turn_col, role_col, text_col), names, strict=True)
    rows = chats.select(*[F.col(f"`{c}`").alias(name) for c, name in given])
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.repartition("id").sortWithinPartitions(*names).select("id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        size = 0
        for number, turns in _conversations(batches):
            made = render_prefixes(template, turns)
            spans = made.spans and [
                {"role": turn.role, **dict(zip(_PLACES, span, strict=True))}
                for turn, span in zip(turns, made.spans, strict=True)
            ]
            done.append((number, made.output, spans, made.rewritten_at))
            size += len(made.output)
            if size > _FLUSH:
                yield flush(done)
                done, size = [], 0
        yield flush(done)

    kind = rows.schema["id"].dataType
    arrow_kind = to_arrow_type(kind)

    def flush(done: list[tuple]) -> pa.RecordBatch:
        kinds = (arrow_kind, pa.string(), _SPANS, pa.int64())
        columns = [pa.array([row[i] for row in done], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["id", "formatted", "spans", "rewritten_at"])

    schema = f"id {kind.simpleString()}, formatted string, spans {SPANS}, rewritten_at bigint"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def read_back(
    formatted: DataFrame,
    parse: Callable[[str], list[Turn]] = parse_marked,
    plain: Callable[[str], str] = unescape,
    learned: str = "assistant",
) -> DataFrame:
    """``formatted`` with ``turns`` parsed from the output, and ``loss_text``: what is under the loss mask, unescaped.

    The mask covers the texts of turns of the role ``learned``, at their places, and nothing between.
    """

    def compute(outputs: pa.Array, spans: pa.Array) -> list[pa.Array]:
        turns, losses = [], []
        for output, places in zip(outputs.to_pylist(), spans.to_pylist(), strict=True):
            turns.append([{"role": t.role, "text": t.text} for t in parse(output)])
            masked = [p for p in places or () if p["role"] == learned]
            losses.append("".join(plain(output[p["text_start"] : p["text_stop"]]) for p in masked))
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        return [pa.array(turns, kind), pa.array(losses, pa.string())]

    added = "turns array<struct<role: string, text: string>>, loss_text string"
    return appended(formatted, ["formatted", "spans"], compute, added, sliced=True)
