import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import SF_SMALL, documents, edge_docs, no_docs  # noqa: F401
from marginflow.llm import lm_scoring, registry


def tokens(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + ["\n"]


def small_head(counts, size, vocabulary):
    words = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:size]
    return lm_scoring.Head([w.encode() for w, _ in words], np.array([n for _, n in words]), sum(counts.values()),
                           len(counts), min(vocabulary, len(words)))


def test_query_against_plain_counts(spark, documents):  # noqa: F811
    rows = {r["doc_id"]: r for r in registry.QUERIES["op4_lm_scoring"](spark, SF_SMALL).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in documents}
    counts = Counter(w for i, r in documents.items() if not held[i] for w in tokens(r["text"]))
    n, v = sum(counts.values()), len(counts)
    base = model = 0.0
    for i, r in documents.items():
        ws = tokens(r["text"])
        got = rows[i]
        assert (got["held_out"], got["n_tokens"], got["train_tokens"]) == (held[i], len(ws), n)
        assert got["n_known"] == sum(counts[w] > 0 for w in ws)
        assert math.isclose(got["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        if held[i]:
            base, model = base + got["base_score"], model + got["score"]
    assert len(rows) == len(documents) and model > base  # unseen texts are more likely under the model


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(list("abcdefghij"), rng.integers(1, 40))) for _ in range(30)]
    counts = Counter(w for t in texts for w in tokens(t))
    head = small_head(counts, 9, 7)
    return head, lm_scoring.Network(head, hidden=4, classes=3), texts


def test_probabilities_sum_to_one(small):
    head, net, _ = small
    h = np.random.default_rng(1).standard_normal((5, 4)).astype(np.float32)
    total = sum(np.exp(net.log_probabilities(h, np.full(5, s))) for s in range(head.size + 1))
    assert np.allclose(total, 1, atol=1e-5)


def test_other_words_are_split_by_rank():
    counts = {f"w{i}": 400 // (i + 1) + 1 for i in range(60)} | {"\n": 500}
    head = small_head(counts, 40, 4)
    by_rank = head.symbol_of.tolist()
    assert by_rank == [0, 1, 2, 3, *[4] * 4, *[5] * 8, *[6] * 16, *[7] * 8, 7]  # the last: words outside the head
    net = lm_scoring.Network(head, hidden=4, classes=3)
    assert len(net.p["embed"]) == len(net.p["ww"]) == 8
    h = np.random.default_rng(1).standard_normal((1, 4)).astype(np.float32)
    p = [math.exp(net.log_probabilities(h, np.array([s]))[0]) for s in range(8)]
    known = sum(p[s] * (10 ** head.within[i] if s >= 4 else 1) for i, s in enumerate(by_rank[:-1]))
    outside = sum(n + 1 for n in sorted(counts.values())[:21]) + 1  # 21 types outside the head, and an unseen word
    assert abs(known + p[7] * outside / head.last_total - 1) < 1e-5
    assert lm_scoring._symbols(head, np.array([0, 5, 39, -1])).tolist() == [0, 4, 7, 7]


def test_gradients_against_differences(small):
    head, net, texts = small
    numbers, sizes, _ = head.encode(texts[:4])
    symbols = lm_scoring._symbols(head, numbers)
    end = lm_scoring.end_symbol(head)
    inputs, targets, starts = lm_scoring.folded(symbols, sizes, end, streams=2)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def total():
        h, _, _ = net.states(inputs, starts, np.zeros((2, 4)))
        return net.log_probabilities(h.reshape(-1, 4).astype(np.float64), targets.ravel()).sum()

    kept = []
    h, _, x = net.states(inputs, starts, np.zeros((2, 4)), kept)
    grad = {k: np.zeros_like(v) for k, v in net.p.items()}
    net.log_probabilities(h.reshape(-1, 4), targets.ravel(), grad)
    net.backward(inputs, starts, kept, x, grad.pop("h").reshape(h.shape), grad)
    rng = np.random.default_rng(2)
    for name in net.p:
        flat, g = net.p[name].reshape(-1), grad[name].reshape(-1)
        for i in rng.integers(0, len(flat), 4):
            old, step = flat[i], 1e-3
            flat[i] = old + step
            up = total()
            flat[i] = old - step
            down = total()
            flat[i] = old
            assert abs((up - down) / (2 * step) - g[i]) < 2e-2 * max(1, abs(g[i]))
    net.p = {k: v.astype(np.float32) for k, v in net.p.items()}


def test_scores_do_not_depend_on_the_layout(small, monkeypatch):
    head, net, texts = small
    end = lm_scoring.end_symbol(head)
    numbers, sizes, _ = head.encode(texts)
    together = lm_scoring.score(net, lm_scoring._symbols(head, numbers), sizes, end)
    monkeypatch.setattr(lm_scoring, "WINDOW", 3)
    for i, t in enumerate(texts[:8]):
        numbers, sizes, _ = head.encode([t])
        assert abs(lm_scoring.score(net, lm_scoring._symbols(head, numbers), sizes, end)[0] - together[i]) < 1e-3


def test_replicas_are_averaged_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FAN_IN", 2)
    monkeypatch.setattr(lm_scoring, "VOCABULARY", 8)
    docs = spark.createDataFrame([(i, "a b c d " * 30) for i in range(40)], "doc_id long, text string").repartition(5)
    counts = lm_scoring.count_words(docs)
    assert {bytes(r["word"]): r["n"] for r in counts.collect()} == {b"a": 1200, b"b": 1200, b"c": 1200, b"d": 1200, b"\n": 40}
    net = lm_scoring.fit(docs, lm_scoring.head_of(counts))
    assert np.isfinite(net.flat()).all()


def test_edge_rows(edge_docs, no_docs):  # noqa: F811
    rows = lm_scoring.score_documents(edge_docs, edge_docs.where("doc_id <> 8")).collect()
    assert len(rows) == edge_docs.count() and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_tokens"] == 1 and by_id[7]["n_tokens"] == 30_001 and by_id[8]["n_known"] == 1
    assert by_id[1]["score"] == by_id[2]["score"]
    assert lm_scoring.score_documents(no_docs, edge_docs).count() == 0
    untrained = lm_scoring.score_documents(edge_docs, no_docs).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["base_score"]) for r in untrained)
