"""Chat formatting: role state machine, declarative template, loss flags.

A conversation is formatted as a sequence of segments whose texts, joined, are
the formatted text.  Each turn gives three: the opening mark, the escaped text
and the closing mark; only the text of a turn whose role is trained on carries
the loss flag.  Control strings inside texts are broken by a backslash, and
backslashes doubled, so that the marks are the only control strings of the
output and every text can be read back.

Rows are clustered by conversation and streamed in turn order; a task holds one
batch and one turn, so a conversation of any length takes bounded memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mark:
    """How turns of a role are marked, and whether their text is trained on."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role; ``other`` marks any other role, which follows its opening mark
    up to ``other_end``.  ``moves`` lists the turn order as (role before, role),
    None standing for the start."""

    marks: dict[str, Mark]
    other: Mark
    other_end: str
    moves: frozenset[tuple[str | None, str]]

    def controls(self) -> list[str]:
        both = [x for m in (*self.marks.values(), self.other) for x in (m.open, m.close)]
        return sorted({*both, self.other_end}, key=lambda s: (-len(s), s))


TEMPLATE = Template(
    marks={"system": Mark("<<SYS>>", "<</SYS>>"), "user": Mark("[INST]", "[/INST]"), "assistant": Mark("<s>", "</s>", True)},
    other=Mark("<<ROLE>>", "</s>"), other_end="<</ROLE>>",
    moves=frozenset({(None, "system"), (None, "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}))


class Codec:
    """Escaping and reading back for a template."""

    def __init__(self, template: Template):
        self.template = template
        self.special = re.compile("|".join(map(re.escape, ["\\", *template.controls()])))
        self.by_open = {m.open: (role, m) for role, m in template.marks.items()}
        self.opens = re.compile("|".join(map(re.escape, sorted([*self.by_open, template.other.open], key=len, reverse=True))))

    def escape(self, text: str) -> str:
        return self.special.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", lambda m: m[1], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        t = self.template
        mark = t.marks.get(role)
        if mark is None:
            return [(f"{t.other.open}{self.escape(role)}{t.other_end}", False), (self.escape(text), t.other.loss), (t.other.close, False)]
        return [(mark.open, False), (self.escape(text), mark.loss), (mark.close, False)]

    def take(self, buffer: str) -> tuple[str, str, str] | None:
        """The first whole turn of formatted text as (role, text, rest); None if there is none."""
        opened = self.opens.match(buffer)
        if not opened:
            return None
        at = opened.end()
        if opened[0] in self.by_open:
            role, mark = self.by_open[opened[0]]
        else:
            mark, end = self.template.other, buffer.find(self.template.other_end, at)
            if end < 0:
                return None
            role, at = self.unescape(buffer[at:end]), end + len(self.template.other_end)
        end = buffer.find(mark.close, at)
        return None if end < 0 else (role, self.unescape(buffer[at:end]), buffer[end + len(mark.close):])


def format_conversations(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """``conv_id, turn_no, part, text, loss, in_order``: the segments, three a turn.

    Turns follow ``turn`` (NULL first; ties by role, then text) and are numbered
    from 0.  NULL texts and roles are empty.  ``in_order`` tells whether the turn
    is a valid move of the state machine; turns out of order are formatted all
    the same.  A NULL conv_id is a conversation of its own.  Rows of a
    conversation stand in one partition, in order.  Other columns are ignored.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, now, number, state = Codec(template), object(), 0, None
        for batch in batches:
            out: list[tuple] = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != now:
                    now, number, state = conv, 0, None
                ok = (state, role) in template.moves
                out += [(conv, number, part, piece, loss, ok) for part, (piece, loss) in enumerate(codec.segments(role, text))]
                number, state = number + 1, role
            yield _batch(out, _SEGMENTS)

    return rows.mapInArrow(run, "conv_id long, turn_no long, part int, text string, loss boolean, in_order boolean")


_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("part", pa.int32()), ("text", pa.string()),
                       ("loss", pa.bool_()), ("in_order", pa.bool_())])
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                      ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                      ("valid", pa.bool_()), ("complete", pa.bool_())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class _Reader:
    """Reads one conversation's formatted text back, a segment at a time."""

    def __init__(self, codec: Codec, conv: int | None):
        self.codec, self.conv, self.buffer = codec, conv, ""
        self.turns = self.loss = self.chars = 0
        self.turns_hash, self.loss_hash, self.valid, self.last = hashlib.sha256(), hashlib.sha256(), True, ""

    def feed(self, text: str, loss: bool, in_order: bool) -> None:
        self.chars += len(text)
        self.valid &= in_order
        if loss:
            plain = self.codec.unescape(text)
            self.loss += len(plain)
            self.loss_hash.update(plain.encode())
        self.buffer += text
        while turn := self.codec.take(self.buffer):
            role, plain, self.buffer = turn
            self.turns, self.last = self.turns + 1, role
            self.turns_hash.update(f"{role}\n{plain}\n".encode())

    def row(self) -> tuple:
        if self.buffer:
            raise ValueError(f"conversation {self.conv}: formatted text ends within a turn")
        marks = self.codec.template.marks
        return (self.conv, self.turns, self.turns_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.chars,
                self.valid, self.last in marks and marks[self.last].loss)


def read_back(segments: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Digests of each conversation, read back from its formatted segments:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid`` (every turn in order) and ``complete`` (the last turn is trained on).

    ``segments`` are those of :func:`format_conversations`, as it returns them
    (clustered and in order); stored ones must be clustered and sorted again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, reader = Codec(template), None
        for batch in batches:
            out: list[tuple] = []
            for conv, text, loss, ok in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "in_order"))):
                if reader is None or conv != reader.conv:
                    if reader is not None:
                        out.append(reader.row())
                    reader = _Reader(codec, conv)
                reader.feed(text, loss, ok)
            yield _batch(out, _DIGESTS)
        if reader is not None:
            yield _batch([reader.row()], _DIGESTS)

    return segments.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, valid boolean, complete boolean")
