"""Chat formatting that is read back and compared.

The grammar, with the control strings `START` and `END`:

    conversation = { turn }
    turn         = START role "\\n" text END "\\n"

A text is first written as it is. The turn is parsed again by the deterministic parser below; if the parser finds anything
but the source, every `<`, backslashes, `|` in it gets one backslash more and it is tried again. The parser always takes
one backslash back, so the second try always succeeds. Line ends, backslashes and control strings in a role are escaped with
backslashes too, which the parser takes back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import carry_modules

START, END = "<|im_start|>", "<|im_end|>"
#: Role whose texts are under the loss mask.
LEARNED = "assistant"
_MARK = re.compile(r"<(\\*)\|")
_MARKED = re.compile(r"<\\(\\*)\|")
TURNS = "conv_id long, turn long, role string, text string, rendered string, escaped boolean"
SUMMARY = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"<\1|", text)


@dataclass(frozen=True)
class Turn:
    """A turn read back: `low` and `high` bound its text in the formatted output."""

    role: str
    text: str
    low: int
    high: int


class Parser:
    """Reads formatted text piece by piece; no more than one unfinished turn is held."""

    def __init__(self) -> None:
        self.rest, self.at = "", 0

    def feed(self, piece: str) -> Iterator[Turn]:
        text, i = self.rest + piece, 0
        while True:
            if not text.startswith(START, i):
                if START.startswith(text[i:]):
                    break
                raise ValueError(f"a turn must start at {self.at + i}")
            line = text.find("\n", i)
            end = text.find(END, line + 1) if line >= 0 else -1
            stop = end + len(END)
            if end < 0 or stop == len(text):
                break
            if text[stop] != "\n":
                raise ValueError(f"a line must end at {self.at + stop}")
            if text.find(START, line + 1, end) >= 0:
                raise ValueError(f"a turn starts inside the turn at {self.at + i}")
            role = text[i + len(START): line]
            if "\\" in role:
                role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role)
            yield Turn(role, unescape(text[line + 1: end]), self.at + line + 1, self.at + end)
            i = stop + 1
        self.rest, self.at = text[i:], self.at + i

    def close(self) -> None:
        if self.rest:
            raise ValueError("the last turn is not finished")


def read(formatted: str) -> list[Turn]:
    """All turns of a formatted conversation."""
    parser = Parser()
    turns = list(parser.feed(formatted))
    parser.close()
    return turns


def render(role: str, text: str) -> tuple[str, bool]:
    """A turn that reads back as the given one, and whether its text had to be escaped."""
    name = role.replace("\\", "\\\\").replace("\n", "\\n") if "\\" in role or "\n" in role else role
    if START in name or END in name:
        name = name.replace("<|", "<\\|")
    for tried, body in enumerate((text, escape(text))):
        out = f"{START}{name}\n{body}{END}\n"
        try:
            back = read(out)
        except ValueError:
            continue
        if len(back) == 1 and (back[0].role, back[0].text) == (role, text):
            return out, bool(tried)
    raise ValueError("the turn does not read back")


def _text(value) -> str:
    return value.as_py() or ""


def format_turns(conversations: DataFrame) -> DataFrame:
    """Each row with `rendered`, its part of the formatted conversation, and `escaped`.

    A NULL text or role is empty. Other columns than conv_id, turn, role and text are left out; repeated rows stay.
    """
    carry_modules(conversations.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [render(_text(r), _text(t)) for r, t in zip(batch.column(2), batch.column(3), strict=True)]
            columns = [*batch.columns, pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "role", "text", "rendered", "escaped"])

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return rows.mapInArrow(run, TURNS)


class _Summary:
    """Digests of one conversation, fed turn by turn; its size does not grow."""

    def __init__(self, conversation) -> None:
        self.conversation, self.parser = conversation, Parser()
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.count = self.learned = self.chars = 0

    def add(self, rendered: str) -> None:
        self.chars += len(rendered)
        for turn in self.parser.feed(rendered):
            self.count += 1
            self.turns.update(f"{turn.role}\n{turn.text}\n".encode())
            if turn.role == LEARNED:
                self.learned += len(turn.text)
                self.loss.update(turn.text.encode())

    def row(self) -> tuple:
        self.parser.close()
        return self.conversation, self.count, self.turns.hexdigest(), self.learned, self.loss.hexdigest(), self.chars


def summarize(turns: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its rendered turns in order.

    Turns are sorted by (turn, role, text), NULL first. A conversation streams through one task in that order and is never
    gathered, so one of any length needs little memory. A NULL conv_id is a conversation of its own.
    """
    carry_modules(turns.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=fields)

        current, done = None, []
        for batch in batches:
            for conversation, rendered in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if current is None or current.conversation != conversation:
                    if current is not None:
                        done.append(current.row())
                    current = _Summary(conversation)
                current.add(rendered.as_py())
            if len(done) >= 1000:
                yield table(done)
                done = []
        if current is not None:
            yield table([*done, current.row()])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "rendered").mapInArrow(run, SUMMARY)
