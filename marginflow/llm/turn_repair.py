"""Conversation structure repair by depth-first branch-and-bound.

A repaired conversation's role initials read ``(s?(ua)+)?``. The search goes
through a conversation's rows in order; a node is a row number, a state of that
pattern, the cost so far and the audit (the edits' initials). It has an explicit
stack, a lower bound of each suffix's cost, an incumbent (cost, audit), and for
each row and state the least (cost, audit) met, which rules out worse prefixes.
It ends when no node on the stack can beat the incumbent.

Two prefixes of equal cost at one node are never the beginning of one another: both
hold an edit for each row, and whatever else they hold (inserts) costs. So the
lesser prefix stays the lesser whatever follows, and long conversations can be
searched in segments whose results are joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Cost of each edit, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows that are searched at once.
SEGMENT = 256
#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
STATES, ENDS = range(4), (0, 3)
_AFTER = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
#: The state and the role that the pattern goes on to, without a system turn.
_NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
_NEVER = float("inf")
#: White space at a text's end.
BLANKS = " \t\n\x0b\x0c\r"


def _edits(row: str, state: int) -> list[tuple[int, str, int]]:
    """(cost, initial, state after) of what can be done with a row. ``row``: the role's
    initial (``-``: none of s, u, a), upper case if truncated; ``x`` if it must go."""
    out = [(DELETE, "D", state)]
    if row != "x":
        extra = TRUNCATED if row.isupper() or row == "_" else 0
        after = _AFTER.get((row.lower(), state))
        if after is not None:
            out.append((KEEP + extra, "K", after))
        out.append((REROLE + extra, "R", _NEXT[state][0]))
    return out


def suffix_bounds(rows: str, ends: tuple[int, ...]) -> list[list[float]]:
    """For each row and state, the least cost from there to one of ``ends``, whatever the audit."""
    def with_inserts(least: list[float]) -> list[float]:
        for _ in STATES:
            least = [min(c, INSERT + least[_NEXT[q][0]]) for q, c in enumerate(least)]
        return least

    bounds = [with_inserts([0 if q in ends else _NEVER for q in STATES])]
    for row in reversed(rows):
        below = bounds[-1]
        bounds.append(with_inserts([min(c + below[to] for c, _, to in _edits(row, q)) for q in STATES]))
    return bounds[::-1]


@lru_cache(maxsize=1 << 12)
def search(rows: str, start: int = 0, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """The least (cost, audit) that leads from state ``start`` through all ``rows`` to
    one of ``ends``; None if nothing does. ``rows`` has one character a row, see ``_edits``."""
    bounds = suffix_bounds(rows, ends)
    best: tuple[int, str] | None = None
    met: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, "", 0, start)]
    while stack:
        cost, audit, i, state = stack.pop()
        low = cost + bounds[i][state]
        if low == _NEVER:
            continue
        if best is not None and (low > best[0] or (low == best[0] and audit > best[1][:len(audit)])):
            continue
        if met.get((i, state), (_NEVER, "")) <= (cost, audit):
            continue
        met[i, state] = cost, audit
        if i == len(rows) and state in ends:
            if best is None or (cost, audit) < best:
                best = cost, audit
            continue
        steps = [(INSERT, "I", _NEXT[state][0], i)]
        if i < len(rows):
            steps += [(c, x, to, i + 1) for c, x, to in _edits(rows[i], state)]
        # the most promising node is taken next
        for c, x, to, at in sorted(steps, key=lambda s: (s[0] + bounds[s[3]][s[2]], s[1]), reverse=True):
            stack.append((cost + c, audit + x, at, to))
    return best


def replay(audit: str, rows: list[tuple[str, str]], state: int = 0) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that the edits leave of ``rows``."""
    at = 0
    for edit in audit:
        if edit == "K":
            role, text = rows[at]
            state = _AFTER[role[:1], state]
            yield edit, role, text
        elif edit in "RI":
            state, role = _NEXT[state]
            yield edit, role, "" if edit == "I" else rows[at][1]
        at += edit != "I"


class _Conversation:
    """One conversation as its rows come in, in order: a segment of rows, and for each
    state that the segments before can end in, the cheapest way there."""

    def __init__(self, conv):
        self.conv, self.rows, self.marks = conv, [], []
        self.ways = {0: (0, "", hashlib.sha256(), False)}
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.turns, self.least, self.most, self.last_turn = 0, None, None, None
        self.illegal, self.last = 0, None

    def add(self, turn, role: str, text: str, fault: str | None) -> None:
        if len(self.rows) == SEGMENT:
            self.fold(tuple((q,) for q in STATES))
        initial = role[:1]
        if turn is not None:
            self.turns += turn != self.last_turn
            self.least = turn if self.least is None else self.least
            self.most = self.last_turn = turn
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if fault:
            self.faults[fault] += 1
        mark = initial if initial and initial in "sua" else "-"
        if fault == "truncated":
            mark = "_" if mark == "-" else mark.upper()
        self.marks.append("x" if fault in ("blank", "duplicate") else mark)
        self.rows.append((role, text))

    def fold(self, goals: tuple[tuple[int, ...], ...]) -> None:
        """Takes the segment's rows into ``ways``: the best way to each goal."""
        marks, ways = "".join(self.marks), {}
        for goal in goals:
            found = []
            for start, (cost, audit, _, _) in self.ways.items():
                step = search(marks, start, goal)
                if step is not None:
                    found.append((cost + step[0], audit + step[1], start, step[1]))
            if found:
                cost, audit, start, step = min(found)
                ways[goal] = cost, audit, start, step
        folded = {}
        for goal, (cost, audit, start, step) in ways.items():
            _, _, digest, begun = self.ways[start]
            digest = digest.copy()
            for _, role, text in replay(step, self.rows, start):
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
            folded[goal[0]] = cost, audit, digest, begun
        self.ways, self.rows, self.marks = folded, [], []

    def result(self) -> tuple:
        self.fold((ENDS,))
        (cost, audit, digest, _), = self.ways.values()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.conv, gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal,
                cost, audit, digest.hexdigest())


def _arranged(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
              live: Column | None) -> DataFrame:
    """conv_id, turn, role, text, fault, live: each conversation in one partition, in
    order. One shuffle; earlier equal rows are found by a sort inside the partitions."""
    turns = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"),
        (F.lit(True) if live is None else F.coalesce(live, F.lit(False))).alias("live")).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "live", "role", "text").orderBy("turn"))
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = (F.when(end == "", "blank").when(F.col("seen") > 1, "duplicate")
             .when(~end.isin(".", "!", "?"), "truncated"))
    return (turns.withColumn("seen", seen).withColumn("fault", fault)
            .sortWithinPartitions("conv_id", "live", "turn", "role", "text", "seen")
            .select("conv_id", "turn", "role", "text", "fault", "live"))


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", live: Column | None = None) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``gaps`` (turn numbers missing between
    the least and the greatest), rows ``blank``, ``duplicate`` and ``truncated`` by their
    first fault, ``illegal`` (adjacent rows whose roles cannot follow one another),
    ``cost`` and ``audit`` of the cheapest repair (ties: the ASCII-least audit), and
    ``repaired_sha256`` (of its ``role:text`` lines).

    Rows go by turn, null turns first, ties by role and text. A null role or text reads
    as one space, so such a text is blank; rows of a null ``conv_col`` are one
    conversation. Only the first character of a role counts in the pattern. Rows where
    ``live`` is not true are not part of their conversation, but a conversation of such
    rows alone is returned too, with zeros, an empty audit and the digest of nothing.
    An empty table gives no rows; further columns are ignored.

    The audit and the digest are sequential, so one task sees a conversation through;
    it holds ``SEGMENT`` rows and the audits at a time, however long the conversation is.
    """
    schema = StructType([
        StructField("conv_id", rows.schema[conv_col].dataType),
        *(StructField(c, LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        StructField("audit", StringType()), StructField("repaired_sha256", StringType())])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = None, None

        def table(out: list[tuple]) -> pa.RecordBatch:
            types = [kind] + 6 * [pa.int64()] + 2 * [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        for batch in batches:
            kind, out = batch.schema.field(0).type, []
            for conv, turn, role, text, fault, is_live in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held.conv != conv:
                    if held is not None:
                        out.append(held.result())
                    held = _Conversation(conv)
                if is_live:
                    held.add(turn, role, text, fault)
            if out:
                yield table(out)
        if held is not None:
            yield table([held.result()])

    return _arranged(rows, conv_col, turn_col, role_col, text_col, live).mapInArrow(run, schema)


def repaired_turns(rows: DataFrame, repairs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text", live: Column | None = None) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``position`` (from 0), ``edit`` (K, R or
    I), ``role`` and ``text`` of each turn that the audits of ``repairs`` leave.

    ``rows`` and the further arguments as for ``repair_conversations``. Rows and audits
    are brought together in one sorted stream; a task holds an audit and one row."""
    key = rows.schema[conv_col].dataType
    schema = StructType([StructField("conv_id", key), StructField("position", LongType()),
                         StructField("edit", StringType()), StructField("role", StringType()),
                         StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, position, state, conv, kind = "", 0, 0, 0, None, None
        out: list[tuple] = []

        def inserts() -> None:
            nonlocal at, position, state
            while at < len(audit) and audit[at] == "I":
                state, role = _NEXT[state]
                out.append((conv, position, "I", role, ""))
                at, position = at + 1, position + 1

        def table() -> pa.RecordBatch:
            types = (kind, pa.int64(), pa.string(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], schema.fieldNames())

        for batch in batches:
            kind = batch.schema.field(0).type
            for c, edits, role, text in zip(*(x.to_pylist() for x in batch.columns)):
                if edits is not None:  # an audit comes before its conversation's rows
                    inserts()
                    audit, at, position, state, conv = edits, 0, 0, 0, c
                    continue
                inserts()
                if audit[at] != "D":
                    state, role = (_AFTER[role[:1], state], role) if audit[at] == "K" else _NEXT[state]
                    out.append((conv, position, audit[at], role, text))
                    position += 1
                at += 1
            if out:
                yield table()
                out.clear()
        inserts()
        if out:
            yield table()

    turns = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(role_col, F.lit(" ")).alias("role"), F.coalesce(text_col, F.lit(" ")).alias("text"),
        (F.lit(True) if live is None else F.coalesce(live, F.lit(False))).alias("live")).where("live")
    marked = turns.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("string").alias("audit"))
    audits = repairs.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                            F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit")
    return (audits.unionByName(marked).repartition("conv_id")
            .sortWithinPartitions("conv_id", "kind", "turn", "role", "text")
            .select("conv_id", "audit", "role", "text").mapInArrow(run, schema))
