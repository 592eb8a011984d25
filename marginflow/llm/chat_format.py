"""Chat formatting by grammar round trip.

A template writes each turn between control strings. Its grammar is parsed by
``parse``, deterministically, from left to right; a control string behind one or
more escape characters is text, and loses one of them. Turns are rendered as they
are, the rendered text is parsed again and the recovered turns are compared with
the source; turns whose content conflicts with the grammar are escaped, until both
are identical. Texts without control strings are never changed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

#: Code points after which a piece of a formatted conversation is closed; pieces are whole turns.
PIECE_CHARS = 1 << 20


@dataclass(frozen=True)
class Template:
    """``marks``: the opening and closing control string of each named role.
    ``other``: the control strings before the role, before the text and after it, for
    turns of any other role. One ``SPACE`` stands inside each pair, so that text never
    touches a control string. ``learned``: the roles under the loss mask.

    Control strings must be told apart wherever text is cut: none may begin inside
    another, nor end in the beginning of one, and none may hold the escape character."""
    marks: tuple[tuple[str, str, str], ...] = (
        ("system", "[SYS]", "[/SYS]"), ("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"))
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/ROLE]")
    learned: tuple[str, ...] = ("assistant",)
    escape: str = "\\"
    controls: tuple[str, ...] = field(init=False, compare=False)

    def __post_init__(self):
        controls = [c for _, *pair in self.marks for c in pair] + list(self.other)
        object.__setattr__(self, "controls", tuple(controls))
        if len(self.escape) != 1 or any(self.escape in c or not c.strip(SPACE) for c in controls):
            raise ValueError("the escape is one character outside all control strings, which are not blank")
        for a in controls:
            for b in controls:
                inside = any(a[i:].startswith(b) or b.startswith(a[i:]) for i in range(1, len(a)))
                if inside or controls.count(a) > 1 or (a != b and a.startswith(b)):
                    raise ValueError(f"control strings {a!r} and {b!r} can overlap")

    def pattern(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, self.controls)))


SPACE = " "


def _scan(template: Template, pattern: re.Pattern, s: str) -> list[tuple[int, int, int]]:
    """(start, end, escapes in front) of every control string in ``s``."""
    found = []
    for m in pattern.finditer(s):
        at = m.start()
        while at and s[at - 1] == template.escape:
            at -= 1
        found.append((m.start(), m.end(), m.start() - at))
    return found


def escaped(template: Template, s: str, pattern: re.Pattern | None = None) -> str:
    """``s`` with one more escape character before each of its control strings."""
    return (pattern or template.pattern()).sub(lambda m: template.escape + m.group(), s)


def unescaped(template: Template, s: str, pattern: re.Pattern | None = None) -> str:
    """``s`` with one escape character fewer before each control string that has any."""
    out, at = [], 0
    for start, _, escapes in _scan(template, pattern or template.pattern(), s):
        if escapes:
            out.append(s[at:start - 1])
            at = start
    return "".join(out) + s[at:] if out else s


def render(template: Template, role: str, text: str) -> str:
    """One turn, its parts as they are given."""
    for name, opening, closing in template.marks:
        if role == name:
            return f"{opening}{SPACE}{text}{SPACE}{closing}"
    opening, between, closing = template.other
    return f"{opening}{SPACE}{role}{SPACE}{between}{SPACE}{text}{SPACE}{closing}"


def parse(template: Template, s: str, pattern: re.Pattern | None = None) -> list[tuple[str, str, int, int]] | None:
    """(role, text, start, end) of each turn, where ``s[start:end]`` is its text as
    written; None if ``s`` is not a sequence of turns."""
    pattern = pattern or template.pattern()
    named = {opening: (role, closing) for role, opening, closing in template.marks}
    live = [(a, b) for a, b, escapes in _scan(template, pattern, s) if not escapes]
    turns, at, i = [], 0, 0

    def part(i: int, closing: str) -> tuple[int, int] | None:
        """Where the text between the control strings i and i + 1 lies."""
        if i + 1 >= len(live) or s[slice(*live[i + 1])] != closing:
            return None
        start, end = live[i][1] + 1, live[i + 1][0] - 1
        return (start, end) if start <= end and s[start - 1] == SPACE and s[end] == SPACE else None

    while at < len(s):
        if i >= len(live) or live[i][0] != at:
            return None
        opening = s[slice(*live[i])]
        if opening in named:
            role, closing = named[opening]
        elif opening == template.other[0]:
            closing = template.other[2]
            head = part(i, template.other[1])
            if head is None:
                return None
            role, i = unescaped(template, s[slice(*head)], pattern), i + 1
        else:
            return None
        body = part(i, closing)
        if body is None:
            return None
        turns.append((role, unescaped(template, s[slice(*body)], pattern), *body))
        at, i = live[i + 1][1], i + 2
    return turns


def format_turns(template: Template, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted turns, and the (start, end) of each text under the loss mask.

    Renders, parses, compares, and escapes the turns that conflict, until the parsed
    turns are the given ones."""
    pattern = template.pattern()
    parts = [render(template, *t) for t in turns]
    tried = [False] * len(turns)
    while True:
        s = "".join(parts)
        found = parse(template, s, pattern)
        if found is not None and [t[:2] for t in found] == turns:
            return s, [t[2:] for t in found if t[0] in template.learned]
        conflicts = [i for i, t in enumerate(turns) if not tried[i]
                     and [x[:2] for x in parse(template, parts[i], pattern) or ()] != [t]]
        if not conflicts:
            raise ValueError("the template's grammar does not give the turns back")
        for i in conflicts:
            role, text = turns[i]
            # a named role is written by its marks; any other is text like the rest
            role = role if any(role == name for name, *_ in template.marks) else escaped(template, role, pattern)
            parts[i], tried[i] = render(template, role, escaped(template, text, pattern)), True


def _spans_type() -> ArrayType:
    return ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def format_conversations(rows: DataFrame, template: Template = Template(), conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Each conversation's formatted text in pieces of whole turns: ``conv_id``,
    ``piece`` (from 0), ``start`` (code points before it), ``formatted``, and
    ``loss_spans`` (start and end, in the piece, of each text under the loss mask).

    Pieces are joined without anything between. Turns stand in the order of
    ``turn_col``, nulls first, ties by role and then text (repeated rows are turns of
    their own). A null role or text is empty; rows of a null ``conv_col`` are one
    conversation; roles that the template does not name are written as text. An empty
    table gives no rows; further columns are ignored.

    A conversation is sequential, so one task writes it; it holds one piece at a time,
    however long the conversation is. A partition's rows keep the order of its pieces."""
    key = rows.schema[conv_col].dataType
    schema = StructType([StructField("conv_id", key), StructField("piece", IntegerType()),
                         StructField("start", LongType()), StructField("formatted", StringType()),
                         StructField("loss_spans", _spans_type())])
    names = ["conv_id", "piece", "start", "formatted", "loss_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, chars, piece, start, begun = None, [], 0, 0, 0, False

        def close() -> pa.RecordBatch:
            nonlocal turns, chars, piece, start
            text, spans = format_turns(template, turns)
            row = {"conv_id": conv, "piece": piece, "start": start, "formatted": text,
                   "loss_spans": [{"start": a, "end": b} for a, b in spans]}
            turns, chars, piece, start = [], 0, piece + 1, start + len(text)
            return row

        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not begun or c != conv:
                    if turns:
                        out.append(close())
                    conv, piece, start, begun = c, 0, 0, True
                turns.append((role, text))
                chars += len(text)
                if chars >= PIECE_CHARS:
                    out.append(close())
            yield from _batches(out, batch.schema.field(0).type)
            kind = batch.schema.field(0).type
        if turns:
            yield from _batches([close()], kind)

    def _batches(out: list[dict], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        if out:
            arrays = [pa.array([r[n] for r in out], t)
                      for n, t in zip(names, (kind, pa.int32(), pa.int64(), pa.string(), span))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    turns = rows.select(F.col(conv_col).alias("conv_id"), F.coalesce(role_col, F.lit("")).alias("role"),
                        F.coalesce(text_col, F.lit("")).alias("text"), F.col(turn_col).alias("turn"))
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(run, schema))


def read_back(pieces: DataFrame, template: Template = Template(), arranged: bool = False) -> DataFrame:
    """What a parser gets from formatted conversations: ``conv_id``, ``n_turns``,
    ``turns_sha256`` (of role, newline, text, newline for each turn), ``loss_chars``
    and ``loss_sha256`` (code points and digest of all text inside ``loss_spans``,
    unescaped), and ``formatted_chars``.

    ``arranged``: the pieces come straight from ``format_conversations``, in order;
    stored ones are brought in order first. A piece that is not a sequence of turns
    is an error."""
    schema = StructType([
        StructField("conv_id", pieces.schema["conv_id"].dataType), StructField("n_turns", LongType()),
        StructField("turns_sha256", StringType()), StructField("loss_chars", LongType()),
        StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType())])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = template.pattern()
        conv, state, kind = None, None, None

        def done() -> tuple:
            n, turns, chars, loss, formatted = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted

        def table(out: list[tuple]) -> pa.RecordBatch:
            types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for batch in batches:
            kind, out = batch.schema.field(0).type, []
            for c, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if state is None or c != conv:
                    if state is not None:
                        out.append(done())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                found = parse(template, text, pattern)
                if found is None:
                    raise ValueError(f"conversation {c!r} holds a piece that is not a sequence of turns")
                for role, words, *_ in found:
                    state[1].update(f"{role}\n{words}\n".encode())
                for span in spans:
                    words = unescaped(template, text[span["start"]:span["end"]], pattern)
                    state[2] += len(words)
                    state[3].update(words.encode())
                state[0] += len(found)
                state[4] += len(text)
            if out:
                yield table(out)
        if state is not None:
            yield table([done()])

    rows = pieces.select("conv_id", "formatted", "loss_spans", *([] if arranged else ["piece"]))
    if not arranged:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return rows.mapInArrow(run, schema)
