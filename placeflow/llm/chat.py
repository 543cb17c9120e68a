"""Chat formatting: a finite-state machine over roles and a declarative template.

The template names for every role what stands before and after a turn, whether the turn is
trained on, and the roles that may follow. The machine walks each conversation in turn order
and emits text segments in writing order, each with its loss flag: markers are never under the
loss, the text of a trained role always is. Control strings inside texts are escaped by an
ESCAPE after their first character (one more where there are some already), which is undone
when the output is read back, so every text survives.

Rows are dealt by conversation and sorted by turn; the tasks stream them, so that a
conversation of any length is held one turn at a time.

Defined results: null text counts as empty; a null role is written as the empty role; a role
without an entry is written by the ``other`` entry, which carries its name; wrong turn order
does not stop the output, but ``valid`` turns false and ``bad_turn`` is the place (from 0) of
the first turn out of order; rows with equal turn number are taken by role, then text; null
turn numbers come first; rows with null conv_id form one conversation; repeated rows are
repeated turns; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeflow.llm.common import in_chunks

ESCAPE = "\\"
CHUNK = 1 << 20
SEGMENTS = "conv_id long, seg long, text string, loss boolean, valid boolean, bad_turn long"


@dataclass(frozen=True)
class Role:
    before: str
    after: str
    follows: tuple[str, ...]  # states that it may follow; "" is the start
    loss: bool = False


@dataclass(frozen=True)
class Template:
    begin: str
    end: str
    roles: dict[str, Role]
    other: Role  # the role's name stands between other.before and name_end
    name_end: str
    marks: tuple[str, ...] = field(init=False)
    plain: re.Pattern = field(init=False)  # a control string with any number of escapes
    escaped: re.Pattern = field(init=False)  # with one at least

    def __post_init__(self):
        own = [m for r in (*self.roles.values(), self.other) for m in (r.before, r.after)]
        marks = tuple(sorted({self.begin, self.end, self.name_end, *own}, key=lambda m: (-len(m), m)))
        for a in marks:
            if len(a) < 2 or ESCAPE in a:
                raise ValueError(f"control string {a!r} is too short or holds the escape")
            for b in marks:
                if any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)))) or a != b and a in b:
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
        opens = [r.before for r in (*self.roles.values(), self.other)]
        if len(set(opens)) < len(opens):
            raise ValueError("two roles have the same opening")
        either = "|".join(f"{re.escape(m[0])}{re.escape(ESCAPE)}%s{re.escape(m[1:])}" for m in marks)
        object.__setattr__(self, "marks", marks)
        object.__setattr__(self, "plain", re.compile(either.replace("%s", "*")))
        object.__setattr__(self, "escaped", re.compile(either.replace("%s", "+")))

    def escape(self, text: str) -> str:
        return self.plain.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[0][0] + m[0][2:], text)


TEMPLATE = Template(
    begin="<s>", end="</s>",
    roles={
        "system": Role("[SYS]", "[/SYS]", ("",)),
        "user": Role("[INST]", "[/INST]", ("", "system", "assistant")),
        "assistant": Role("[ANS]", "[/ANS]", ("user",), loss=True),
    },
    other=Role("[ROLE]", "[/ROLE]", ()), name_end="[:]",
)


class Formatter:
    """The machine: one conversation's state, fed turn by turn."""

    def __init__(self, template: Template):
        self.t = template
        self.state, self.turns, self.bad = "", 0, None

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        spec = self.t.roles.get(role)
        if (spec is None or self.state not in spec.follows) and self.bad is None:
            self.bad = self.turns
        self.state = role if spec else None
        out = [(self.t.begin, False)] if not self.turns else []
        self.turns += 1
        if spec is None:
            spec = self.t.other
            out += [(spec.before, False), (self.t.escape(role), False), (self.t.name_end, False)]
        else:
            out.append((spec.before, False))
        return [*out, (self.t.escape(text), spec.loss), (spec.after, False)]

    def finish(self) -> list[tuple[str, bool]]:
        return [(self.t.end, False)]


def _rows(batches, columns):
    for batch in batches:
        sizes = [len(s or b"") for s in batch.column(columns.index("text")).cast(pa.binary()).to_pylist()] if len(batch) else []
        for a, b in in_chunks(sizes, CHUNK):
            part = batch.slice(a, b - a)
            yield from zip(*(part.column(k).to_pylist() for k in range(len(columns))))


def _batches(rows, schema):
    """Rows as record batches of bounded size; schema: names and Arrow types, text third."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[2] or "")
        if size > CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), schema)], [n for n, _ in schema])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), schema)], [n for n, _ in schema])


def in_order(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: each conversation whole in one partition, in turn order."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def segments(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, seg (place in the conversation), text, loss, and on the last segment of a
    conversation valid and bad_turn; partitions stay whole and in order."""
    schema = [("conv_id", pa.int64()), ("seg", pa.int64()), ("text", pa.string()), ("loss", pa.bool_()),
              ("valid", pa.bool_()), ("bad_turn", pa.int64())]

    def emit(batches):
        machine, conv, seg = None, None, 0

        def close():
            for text, loss in machine.finish():
                yield conv, seg, text, loss, machine.bad is None, machine.bad

        for conv_id, _, role, text in _rows(batches, ["conv_id", "turn", "role", "text"]):
            if machine is None or conv_id != conv:
                if machine is not None:
                    yield from close()
                machine, conv, seg = Formatter(template), conv_id, 0
            for part, loss in machine.turn(role, text):
                yield conv, seg, part, loss, None, None
                seg += 1
        if machine is not None:
            yield from close()

    return in_order(conversations).mapInArrow(lambda batches: _batches(emit(batches), schema), SEGMENTS)


class Reader:
    """Reads one conversation's output back: turns from the text alone, loss from the mask."""

    def __init__(self, template: Template):
        self.t = template
        self.mark = re.compile("|".join(map(re.escape, template.marks)))
        self.opens = {r.before: name for name, r in template.roles.items()}
        self.closes = {r.before: r.after for r in (*template.roles.values(), template.other)}
        self.turns, self.formatted, self.loss_chars = 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()
        self.open = self.role = None
        self.held: list[str] = []
        self.done = False

    def feed(self, text: str, loss: bool) -> None:
        self.formatted += len(text)
        if loss:
            plain = self.t.unescape(text)
            self.loss_chars += len(plain)
            self.loss_hash.update(plain.encode("utf-8", "surrogatepass"))
        at = 0
        for m in self.mark.finditer(text):
            self.held.append(text[at:m.start()])
            at = m.end()
            self._control(m[0])
        self.held.append(text[at:])

    def _control(self, mark: str) -> None:
        text, self.held = self.t.unescape("".join(self.held)), []
        if self.open is None:
            if mark in self.closes:
                self.open, self.role = mark, self.opens.get(mark)
            elif mark == self.t.end:
                self.done = True
            elif mark != self.t.begin:
                raise ValueError(f"{mark!r} outside a turn")
        elif self.role is None and mark == self.t.name_end:
            self.role = text
        elif mark == self.closes[self.open]:
            self.turn_hash.update(f"{self.role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1
            self.open = None
        else:
            raise ValueError(f"{mark!r} inside a turn")


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation of the ``segments`` output (its partitions must be as it made
    them): conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid,
    bad_turn."""
    schema = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
              ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("bad_turn", pa.int64())]

    def read(batches):
        reader = None
        for conv, _, text, loss, valid, bad in _rows(batches, ["conv_id", "seg", "text", "loss", "valid", "bad_turn"]):
            if reader is None:
                reader = Reader(template)
            reader.feed(text, loss)
            if reader.done:
                yield (conv, reader.turns, reader.turn_hash.hexdigest(), reader.loss_chars,
                       reader.loss_hash.hexdigest(), reader.formatted, valid, bad)
                reader = None

    return formatted.mapInArrow(lambda batches: _batches(read(batches), schema),
                                "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                "formatted_chars long, valid boolean, bad_turn long")
