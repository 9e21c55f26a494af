"""Chat formatting by a finite-state machine over roles.

A declarative template gives each role the control strings around its text,
whether it counts for the loss, and which roles may follow.  Texts are escaped
so that no control string survives inside them, reversibly.  The machine walks
the turns of a conversation in order and emits segments, each with its loss
flag; only an answering role's own text is flagged.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import ready

START = "start"


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Roles, the roles that may follow each state, and the escape mark."""

    roles: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("<<SYS>>", "<</SYS>>"),
            "user": Turn("[INST] ", " [/INST]"),
            "assistant": Turn("<s>", "</s>", loss=True),
        }
    )
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    #: A turn of any other role; the role's name is written (escaped) first.
    other: Turn = Turn("<role>", "</role>")
    name_end: str = "</name>"
    escape: str = "\\"

    def controls(self) -> list[str]:
        marks = {m for t in (*self.roles.values(), self.other) for m in (t.before, t.after)} | {self.name_end}
        return sorted(marks, key=lambda m: (-len(m), m))

    @cached_property
    def codes(self) -> dict[str, str]:
        """The escape mark and every character a control string begins with ->
        the mark and a code; no control string begins with a code."""
        firsts = sorted({x[0] for m in self.controls() for x in (m, m.strip()) if x} - {" ", self.escape})
        free = [c for c in "0123456789abcdefghijklmnopqrstuvwxyz" if c not in firsts and c != self.escape]
        return {c: self.escape + code for c, code in zip([self.escape, *firsts], free, strict=False)}

    @cached_property
    def _plain(self) -> dict[str, str]:
        return {v: k for k, v in self.codes.items()}

    def quote(self, text: str) -> str:
        """No control string is left in the result: none of their first
        characters is.  ``unquote`` restores the text."""
        return text.translate(str.maketrans(self.codes))

    def unquote(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", lambda m: self._plain[m[0]], text, flags=re.S)


def segments(turns, template: Template):
    """(turn, text, loss, valid) for each segment of one conversation.  A turn
    whose role may not follow the last state is emitted all the same, with
    valid False; the machine goes on from it."""
    state = START
    for number, (role, text) in enumerate(turns):
        role, text = role if role is not None else "", text if text is not None else ""
        valid = role in template.follows.get(state, ())
        turn = template.roles.get(role)
        if turn is None:
            yield number, template.other.before + template.quote(role) + template.name_end, False, valid
            turn = template.other
        else:
            yield number, turn.before, False, valid
        if text:
            yield number, template.quote(text), turn.loss, valid
        yield number, turn.after, False, valid
        state = role


class Reader:
    """Reads formatted text back: roles, texts and the text under the loss."""

    def __init__(self, template: Template):
        self.template = template
        # The blanks inside a mark cannot start it in a text: the escape comes first.
        self.token = re.compile("|".join([re.escape(template.escape) + ".", *map(re.escape, template.controls())]), re.S)
        self.opens = {t.before: (role, t) for role, t in template.roles.items()}

    def turns(self, text: str):
        """(role, text as escaped, begin, end) of every turn."""
        t, at = self.template, 0
        while at < len(text):
            m = self.token.match(text, at)
            mark = m[0]
            at = m.end()
            if mark == t.other.before:
                role, at = self._upto(text, at, t.name_end)
                role, turn = t.unquote(role), t.other
            else:
                role, turn = self.opens[mark]
            begin = at
            body, at = self._upto(text, at, turn.after)
            yield role, body, begin, begin + len(body)

    def _upto(self, text: str, at: int, mark: str) -> tuple[str, int]:
        begin = at
        for m in self.token.finditer(text, at):
            if m[0] == mark:
                return text[begin : m.start()], m.end()
        raise ValueError(f"{mark!r} is missing")


def format_chat(df: DataFrame, template: Template | None = None, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn_no, text, loss, valid``: the segments of every
    conversation, in order inside its partition.

    Turns go by number, then role, then text (nulls first; ties and repeated
    rows are turns of their own).  Null text is empty, a null role has an empty
    name and null conversation ids form one conversation.  Conversations are
    hash-partitioned and streamed turn by turn, so a long one is never held
    whole.  An empty table gives no rows; other columns are ignored."""
    ready(df.sparkSession)
    template = template or Template()
    src = df.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"),
    )
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = src.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        last, state, number = object(), START, 0
        for b in batches:
            out = [[] for _ in range(5)]
            for conv, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != last:
                    last, state, number = conv, START, 0
                allowed = (role or "") in template.follows.get(state, ())
                for _, piece, loss, _ in segments([(role, text)], template):
                    for col, v in zip(out, (conv, number, piece, loss, allowed)):
                        col.append(v)
                state, number = role or "", number + 1
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["conv_id", "turn_no", "text", "loss", "valid"])

    return src.mapInArrow(run, "conv_id long, turn_no long, text string, loss boolean, valid boolean")


def digests(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Read back from the segments, one row per conversation: ``conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid``.
    Turns are parsed from the formatted text, the text under the loss from the
    flags.  ``formatted`` must keep the order ``format_chat`` gives it."""
    template = template or Template()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def run(batches):
        reader = Reader(template)
        now, held, turn, state = object(), [], -1, None

        def read_turn():
            for role, body, _, _ in reader.turns("".join(held)):
                state[0] += 1
                state[1].update(f"{role}\n{template.unquote(body)}\n".encode())

        def close():
            return now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]

        for b in batches:
            rows = []
            for conv, number, piece, loss, valid in zip(*(c.to_pylist() for c in b.columns)):
                if conv != now or number != turn or state is None:
                    if state is not None:
                        read_turn()
                        if conv != now:
                            rows.append(close())
                    if conv != now or state is None:
                        state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                    now, turn, held = conv, number, []
                held.append(piece)
                state[4] += len(piece)
                state[5] &= valid
                if loss:
                    plain = template.unquote(piece)
                    state[2] += len(plain)
                    state[3].update(plain.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=names)
        if state is not None:
            read_turn()
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(close(), kinds)], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    return formatted.mapInArrow(run, schema)
