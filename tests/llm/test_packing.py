import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm_fixtures import SF_SMALL, documents, edge_docs, no_docs  # noqa: F401
from marginflow.llm import packing, registry

JSON = registry.tokenizer_json()


def token_ids(text):
    t = Tokenizer.from_str(JSON)
    return np.array(t.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def check_layout(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query_against_plain_tokenizing(spark, documents):
    rows = registry.QUERIES["op1_best_fit_packing"](spark, SF_SMALL).collect()
    expected = Counter()
    for i, r in documents.items():
        ids = token_ids(r["text"])
        for at in range(0, len(ids), 2048):
            cut = ids[at:at + 2048]
            expected[(i, at // 2048, at, len(cut), zlib.crc32(cut.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    used = check_layout(rows, 2048)
    lengths = Counter(r["length"] for r in rows)
    assert used <= packing.least_sequences(lengths, 2048) + 1


def test_edge_rows(spark, edge_docs, no_docs):
    rows = packing.pack_documents(edge_docs, JSON).collect()
    check_layout(rows, 2048)
    by_doc = Counter(r["doc_id"] for r in rows)
    assert by_doc[6] == 2 and by_doc[None] == 1 and by_doc[7] == -(-30_001 // 2048)
    assert {r["length"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    crc = {r["doc_id"]: r["ids_crc32"] for r in rows}
    assert crc[10] == zlib.crc32(token_ids("Ünïcode 日本語 😀 ΑΣ <|endoftext|> <|EndOfText|> it's ▁ here").tobytes())
    assert packing.pack_documents(no_docs, JSON).count() == 0


def test_small_cache_gives_the_same_ids(monkeypatch):
    texts = [" ".join(random.Random(s).choice("alpha beta gamma delta, x1 (y) don't é.").strip() + str(s % 7)
                      for _ in range(40)) for s in range(60)] + [None, "", "a—. 3rd b"]
    whole = list(packing.WordEncoder(JSON).encode(texts))
    monkeypatch.setattr(packing, "CACHE_WORDS", 16)
    assert list(packing.WordEncoder(JSON).encode(texts)) == whole
    assert whole == [token_ids(t)[:-1].tobytes() for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_bin_completion(seed):
    rng = random.Random(seed)
    capacity = rng.choice([20, 100, 2048])
    counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 300)))
    patterns = packing.bin_completion(counts, capacity)
    placed = Counter()
    for pattern, times in patterns:
        assert sum(n * k for n, k in pattern.items()) <= capacity
        for n, k in pattern.items():
            placed[n] += k * times
    assert placed == counts
    sequences = sum(t for _, t in patterns)
    assert packing.least_sequences(counts, capacity) <= sequences <= sum(t for _, t in packing.best_fit(counts, capacity))


def test_bin_completion_beats_best_fit():
    counts = Counter([11, 11, 10, 10, 8, 8, 7, 6, 6, 6, 5, 4, 3, 3])  # best fit needs one more than the least
    best_fit = sum(t for _, t in packing.best_fit(counts, 20))
    assert sum(t for _, t in packing.bin_completion(counts, 20)) == packing.least_sequences(counts, 20) == best_fit - 1


def brute_least(lengths, capacity):
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + lengths[i] <= capacity:
                bins[j] += lengths[i]
                place(i + 1, bins)
                bins[j] -= lengths[i]
        bins.append(lengths[i])
        place(i + 1, bins)
        bins.pop()
    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(8))
def test_bin_completion_is_near_the_least(seed):
    rng = random.Random(100 + seed)
    lengths = sorted((rng.randint(2, 12) for _ in range(9)), reverse=True)
    found = sum(t for _, t in packing.bin_completion(Counter(lengths), 16))
    assert found == brute_least(lengths, 16)


def test_ids_of_other_types_and_kept_token_ids(spark):
    df = spark.createDataFrame([("x", "some words here"), ("y", None), (None, "more words")], "doc_id string, text string")
    rows = packing.pack_documents(df, JSON, keep_ids=True).collect()
    assert {r["doc_id"] for r in rows} == {"x", "y", None}
    for r in rows:
        assert len(r["ids"]) == r["length"] and r["ids"][-1] == 0
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
