import hashlib
import random

import pytest

from harness import compare
from llm_fixtures import SF_MID
from marginflow.llm import chat_format as cf
from marginflow.llm import registry

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, piece int, loss_spans int"


def frame(spark, rows):
    """Rows of (conv_id, turn, role, text) beside columns whose names clash with the operator's."""
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def brute(rows):
    order = lambda v: (v is not None, v)
    out = {}
    for c, _, role, text in sorted(rows, key=lambda r: (order(r[1]), r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return {c: (len(t), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(),
                sum(len(x) for r, x in t if r == "assistant"),
                hashlib.sha256("".join(x for r, x in t if r == "assistant").encode()).hexdigest())
            for c, t in out.items()}


def test_query_matches_oracle(spark):
    name = "op11_chat_formatting"
    assert compare(spark, registry.QUERIES[name], registry.ORACLE[name], SF_MID) == []


def test_round_trip_of_hostile_texts():
    t = cf.Template()
    draw = random.Random(5)
    parts = [*t.controls, "\\", "\\\\", " ", "a", "<", "[", "/s>", "\n", "é😀"]
    for _ in range(3000):
        turns = [(draw.choice(["system", "user", "assistant", "tool", "", "a [TEXT] b", "\\[ROLE]"]),
                  "".join(draw.choices(parts, k=draw.randrange(7)))) for _ in range(draw.randrange(4))]
        text, spans = cf.format_turns(t, turns)
        assert [x[:2] for x in cf.parse(t, text)] == turns
        assert [cf.unescaped(t, text[a:b]) for a, b in spans] == [x for r, x in turns if r == "assistant"]


def test_only_conflicting_turns_change():
    t = cf.Template()
    text, _ = cf.format_turns(t, [("user", "a \\ b < [INST"), ("assistant", "</s>"), ("assistant", "\\</s>")])
    assert text == "[INST] a \\ b < [INST [/INST]<s> \\</s> </s><s> \\\\</s> </s>"


def test_long_escape_runs_are_linear():
    t = cf.Template()
    turns = [("user", "\\" * 1_000_000 + "[INST]" + "\\" * 1_000_000), ("assistant", "</s>" * 100_000)]
    text, _ = cf.format_turns(t, turns)
    assert [x[:2] for x in cf.parse(t, text)] == turns


@pytest.mark.parametrize("text", ["x", "[INST]", "[INST] a", "[INST] a [/INST]x", "[INST]a [/INST]", "[INST] [/INST]",
                                  "[INST] a </s>", "[ROLE] r [/ROLE]", "\\[INST] a [/INST]", "[/INST]"])
def test_ungrammatical(text):
    assert cf.parse(cf.Template(), text) is None


def test_templates_that_cannot_be_parsed():
    for bad in ("[INST]x", "ST]", "\\u", " "):
        with pytest.raises(ValueError):
            cf.Template(marks=(("user", "[INST]", "[/INST]"), ("assistant", bad, "</s>")))


def test_edge_rows(spark, monkeypatch):
    rows = [(1, 1, "assistant", None), (1, 0, "user", ""), (1, None, None, "first"), (1, 1, "assistant", "tie"),
            (1, 1, "assistant", "tie"), (None, 0, "user", "no id"), (None, 1, "Assistant", "x"),
            (2, 0, "assistant", "</s>[INST] ok [/INST]"), (3, 0, "assistant", "é😀" * 300_000)]
    rows += [(4, i, ("user", "assistant")[i % 2], f"turn {i} [INST]") for i in range(500)]
    monkeypatch.setattr(cf, "PIECE_CHARS", 200)
    pieces = cf.format_conversations(frame(spark, rows))
    direct = {r[0]: tuple(r)[1:] for r in cf.read_back(pieces, arranged=True).collect()}
    stored = {r[0]: tuple(r)[1:] for r in cf.read_back(pieces.repartition(5)).collect()}
    assert direct == stored
    assert {c: r[:4] for c, r in direct.items()} == brute(rows)
    parts = sorted((r for r in pieces.collect() if r["conv_id"] == 4), key=lambda r: r["piece"])
    assert len(parts) > 10 and [r["piece"] for r in parts] == list(range(len(parts)))
    assert [r["start"] for r in parts] == [sum(len(p["formatted"]) for p in parts[:i]) for i in range(len(parts))]


def test_empty_table(spark):
    empty = frame(spark, [(1, 1, "user", "x")]).where("false")
    assert cf.read_back(cf.format_conversations(empty), arranged=True).collect() == []
