import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from harness import compare
from llm_fixtures import SF_MID, edge_docs, no_docs  # noqa: F401
from marginflow.llm import collocations as co
from marginflow.llm import registry


def counts(rows):
    """f and n by language, of (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    return f, n


def brute(rows, least, top=2000):
    f, n = counts(rows)
    out = []
    for lang in f:
        kept = []
        cands = {p: a for p, a in f[lang].items() if len(p) > 1 and a >= least}
        for p, a in cands.items():
            cuts = [(2000000 * a // (f[lang][p[:k]] + f[lang][p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                         for q, b in cands.items())
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), f[lang][p[:k]], f[lang][p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                                 "lang string, text string, key int, phrase string, n int").repartition(3)


def result(df, *args, **kwargs):
    return sorted(tuple(r) for r in co.top_collocations(df, *args, **kwargs).collect())


def test_query_matches_oracle(spark):
    name = "op12_phrase_collocations"
    assert compare(spark, registry.QUERIES[name], registry.ORACLE[name], SF_MID) == []


ROWS = [("en", "New  York\tcity, new york City! the new york city. the end of the new york city"),
        (None, "a b a b a b a b"), ("und", "a b a b"), ("fr", None), (None, ""), ("", "x y. x y; x y"),
        ("en", "new york city\nnew york city\x0bYork\x0cnew\rÉté été Été été é\u00a0b"), ("de", "w " * 50),
        ("en", "es fr es fr"), ("es", "en fr en fr"), ("fr", "es en. en es")] * 2


@pytest.mark.parametrize("least", [1, 2, 3, 8])
def test_against_brute_force(spark, least):
    assert result(frame(spark, ROWS), least) == brute(ROWS, least)


@pytest.mark.parametrize("bits", [2, 6, 10])
def test_collisions_are_settled_by_text(spark, bits):
    rng = np.random.default_rng(bits)
    words = np.array([f"w{i}" for i in range(12)])
    rows = [("en" if i % 3 else None, " ".join(words[rng.integers(0, 12, 40)])) for i in range(20)]
    assert result(frame(spark, rows), 3, bits=bits) == brute(rows, 3)


@pytest.mark.parametrize("window", [8, 40, 200])
def test_long_texts_in_windows(spark, window):
    rng = np.random.default_rng(window)
    words = np.array(["a", "bb", "ccc", "dd.", "e,f", "x" * 30, "é"])
    text = " ".join(words[rng.integers(0, 7, 400)])
    expected_f, expected_n = counts([("en", text)])
    got, total = Counter(), 0
    size, co.WINDOW = co.WINDOW, window
    try:
        for _, w in co._windows([text]):
            total += int((~w.context).sum())
            data = w.data.tobytes()
            for m in range(1, 5):
                for i in np.flatnonzero(co._counted(w, m)):
                    got[tuple(co._phrase(data[w.starts[i]:w.ends[i + m - 1]]).decode().split(" "))] += 1
                    at = w.starts[i] + w.shift[w.doc[i]]
                    assert text.encode()[at:at + w.ends[i] - w.starts[i]] == data[w.starts[i]:w.ends[i]]
    finally:
        co.WINDOW = size
    assert total == expected_n["en"] and got == expected_f["en"]


def test_top_and_ties(spark):
    rows = [("en", "b c. b a. é f. a b. 😀 x. \uffff x")] * 3
    assert result(frame(spark, rows), 3, top=4) == brute(rows, 3, top=4)


def test_scores_do_not_overflow(spark):
    big = 10 ** 13
    row = spark.createDataFrame([(big, 2 * big)], "a long, parts long").select(co._score(co.F.col("a"), co.F.col("parts")))
    assert row.first()[0] == 1_000_000


def test_edge_rows(spark, edge_docs, no_docs):  # noqa: F811
    rows = [(r["lang"], r["text"]) for r in edge_docs.collect()]
    assert result(edge_docs, 2) == brute(rows, 2)
    assert result(no_docs) == []
