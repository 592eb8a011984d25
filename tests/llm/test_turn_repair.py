import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from llm_fixtures import SF_MID
from marginflow.llm import registry, turn_repair as tr

SHAPE = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def all_repairs(rows, per_gap):
    """Every (cost, audit, turns) of few rows, by enumeration; rows: (role, text, fault)."""
    gaps = [g for n in range(per_gap + 1) for g in itertools.product(("user", "assistant"), repeat=n)]
    choices = []
    for role, text, fault in rows:
        late = 5 * (fault == "truncated")
        options = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            options += [(late, "K", (role, text)), (1 + late, "R", ("user", text)), (1 + late, "R", ("assistant", text))]
        choices.append(options)
    for chosen in itertools.product(*choices):
        for inserted in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, turns = 0, "", []
            for gap, edit in itertools.zip_longest(inserted, chosen):
                cost, audit = cost + 5 * len(gap), audit + "I" * len(gap)
                turns += [(r, "") for r in gap]
                if edit:
                    cost, audit = cost + edit[0], audit + edit[1]
                    turns += [edit[2]] if edit[2] else []
            if SHAPE.fullmatch("".join((r[:1] or "-") for r, _ in turns)):
                yield cost, audit, turns


def plain(rows):
    """The least (cost, audit), by recursion over suffixes; an insert needs no more than two in a row."""
    states = {0: ("s", "u"), 1: ("u",), 2: ("a",), 3: ("u",)}
    after = lambda q, x: {"s": 1, "u": 2, "a": 3}[x]

    @cache
    def best(i, q, inserts):
        found = [(0, "")] if i == len(rows) and q in (0, 3) else []
        if inserts < 3:
            x = "a" if q == 2 else "u"
            c, s = best(i, after(q, x), inserts + 1)
            found.append((c + 5, "I" + s))
        if i < len(rows):
            role, _, fault = rows[i]
            c, s = best(i + 1, q, 0)
            found.append((c + 2, "D" + s))
            if fault not in ("blank", "duplicate"):
                late = 5 * (fault == "truncated")
                if role[:1] in states[q] and role:
                    c, s = best(i + 1, after(q, role[:1]), 0)
                    found.append((c + late, "K" + s))
                x = "a" if q == 2 else "u"
                c, s = best(i + 1, after(q, x), 0)
                found.append((c + late + 1, "R" + s))
        return min(found, default=(10 ** 9, ""))
    return best(0, 0, 0)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen
                   else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def expected(rows, solve=plain):
    """rows: (turn, role, text) of one conversation, in order."""
    found = faults([r[1:] for r in rows])
    marked = [(role, text, f) for (_, role, text), f in zip(rows, found)]
    cost, audit = solve(marked)
    turns, at, state = [], 0, 0
    for x in audit:
        if x in "RI":
            turns.append(("assistant" if state == 2 else "user", "" if x == "I" else rows[at][2]))
        elif x == "K":
            turns.append(rows[at][1:])
        if x != "D":
            state = {"s": 1, "u": 2, "a": 3}[turns[-1][0][0]]
        at += x != "I"
    have = [t for t, *_ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return ((max(have) - min(have) + 1 - len(set(have)) if have else 0), found.count("blank"), found.count("duplicate"),
            found.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())


def by_conversation(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = {}
    for c, *r in sorted(rows, key=key):
        out.setdefault(c, []).append(tuple(r))
    return out


def random_rows(draw, n):
    roles = ["system", "user", "assistant", "tool", "", "user", "assistant"]
    return [(draw.choice(roles), draw.choice(["Yes.", "no", " ", "a?", f"t{draw.randrange(9)}.", f"u{draw.randrange(9)}"]))
            for _ in range(n)]


@pytest.mark.parametrize("n,per_gap,cases", [(0, 2, 1), (1, 2, 30), (2, 2, 30), (3, 1, 40), (4, 1, 8)])
def test_search_against_enumeration(n, per_gap, cases):
    draw = random.Random(n)
    for _ in range(cases):
        rows = random_rows(draw, n)
        rows = [(*r, f) for r, f in zip(rows, faults(rows))]
        held = tr._Conversation(0)
        for role, text, fault in rows:
            held.add(None, role, text, fault)
        cost, audit, turns = min(all_repairs(rows, per_gap))
        got = held.result()
        assert got[6:8] == (cost, audit) == plain(rows)
        assert got[8] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


def test_bounds_are_lower_bounds_and_prune():
    draw = random.Random(3)
    for _ in range(50):
        marks = "".join(draw.choices("suaSUA-_x", k=30))
        cost, audit = tr.search(marks)
        assert tr.suffix_bounds(marks, tr.ENDS)[0][0] <= cost
        assert len(audit.replace("I", "")) == 30


@pytest.mark.parametrize("segment", [1, 2, 7, 256])
def test_segments_join(segment, monkeypatch):
    monkeypatch.setattr(tr, "SEGMENT", segment)
    draw = random.Random(segment)
    for n in (0, 1, 5, 40, 120):
        rows = random_rows(draw, n)
        held = tr._Conversation(0)
        for (role, text), fault in zip(rows, faults(rows)):
            held.add(None, role, text, fault)
        assert held.result()[1:] == expected([(None, *r) for r in rows])


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            out.append((c, t, "user" if kind == 4 else role,
                        "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text))
            out += out[-1:] if kind == 3 else []
    return out


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in registry.op13_conversation_repair(spark, SF_MID).collect()}
    held = by_conversation(damage(rows))
    assert got == {c: expected(held.get(c, [])) for c in {r[0] for r in rows}}


EDGE = [(1, None, "user", "early."), (1, 0, None, "x."), (1, 0, "user", None), (1, 1, "assistant", "a\u00a0 \t"),
        (1, 1, "assistant", "a."), (1, 1, "assistant", "a."), (2, 5, "assistant", "alone."), (None, 3, "system", "s."),
        (None, 4, "user", "q?"), (None, 5, "assistant", "w " * 200_000 + "."), (3, 1, "tool", ""), (4, None, "user", "a.")]


def edge_frame(spark):
    rows = [(*r, "x", 3) for r in EDGE]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, cost int").repartition(3)


def test_edge_rows_and_repaired_turns(spark):
    df = edge_frame(spark)
    repairs = tr.repair_conversations(df)
    got = {r["conv_id"]: tuple(r)[1:] for r in repairs.collect()}
    held = by_conversation(EDGE)
    assert got == {c: expected(rows) for c, rows in held.items()}
    turns = {}
    for r in sorted(tr.repaired_turns(df, repairs).collect(), key=lambda r: r["position"]):
        turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for c, row in got.items():
        assert row[-1] == hashlib.sha256("\n".join(turns.get(c, [])).encode()).hexdigest()


def test_dropped_conversations_and_empty_table(spark):
    df = edge_frame(spark)
    gone = tr.repair_conversations(df, live=df["conv_id"] != 2).where("conv_id = 2").collect()
    assert [tuple(r) for r in gone] == [(2, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    empty = df.where("false")
    assert tr.repair_conversations(empty).collect() == []
    assert tr.repaired_turns(empty, tr.repair_conversations(empty)).collect() == []
