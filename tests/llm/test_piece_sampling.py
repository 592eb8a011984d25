import math
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import SF_SMALL, edge_docs, no_docs  # noqa: F401
from marginflow.llm import piece_sampling, registry

MODEL = registry.vocabulary_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattices():
    return piece_sampling.Lattices(MODEL)


def segmentations(lat, s):
    if not s:
        return [((), 0.0)]
    return [((lat.pieces[s[:i]][0], *a), lat.pieces[s[:i]][1] + b) for i in range(1, len(s) + 1) if s[:i] in lat.pieces
            for a, b in segmentations(lat, s[i:])]


def test_query_is_lossless_and_reproducible(spark):
    a = registry.QUERIES["op6_piece_sampling"](spark, SF_SMALL).collect()
    assert all(r["lossless"] for r in a) and len(a) == 200
    assert all(len(r["ids"]) == r["n_pieces"] for r in a)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    again = piece_sampling.encode(docs.repartition(7), MODEL).collect()
    assert {(r["doc_id"], r["ids_crc32"]) for r in a} == {(r["doc_id"], r["ids_crc32"]) for r in again}
    other = piece_sampling.encode(docs, MODEL, seed=1, keep_ids=False).collect()
    assert {(r["doc_id"], r["ids_crc32"]) for r in a} != {(r["doc_id"], r["ids_crc32"]) for r in other}


@pytest.mark.parametrize("word", ["then", "aabb", "in"])
def test_frequencies_follow_the_lattice(lattices, word):
    n = 20_000
    all_ = segmentations(lattices, " " + word)
    total = sum(math.exp(w) for _, w in all_)
    seen = Counter(tuple(x.tolist()) for x in piece_sampling.sample_ids(lattices, [word] * n, list(range(n))))
    assert set(seen) <= {s for s, _ in all_}
    assert all(abs(seen[s] / n - math.exp(w) / total) < 0.02 for s, w in all_)


def test_batches_and_caches_do_not_matter(lattices, monkeypatch):
    texts = ["a  b▁c \n\tx日本\x00語😀 ", "▁", " ", "", None, "abc " * 50, "Ünïcode words, again"]
    seeds = list(range(len(texts)))
    whole = piece_sampling.sample_ids(lattices, texts, seeds)
    assert [piece_sampling.decode(lattices, x.tolist()) for x in whole] == [t or "" for t in texts]
    monkeypatch.setattr(piece_sampling, "OCCURRENCES", 3)
    monkeypatch.setattr(piece_sampling, "CACHE_PARTS", 4)
    small = piece_sampling.sample_ids(piece_sampling.Lattices(MODEL), texts, seeds)
    assert all(np.array_equal(x, y) for x, y in zip(whole, small))


def test_edge_rows(edge_docs, no_docs):  # noqa: F811
    encoded = piece_sampling.encode(edge_docs, MODEL)
    rows = encoded.collect()
    assert len(rows) == edge_docs.count() and all(r["lossless"] for r in rows)
    assert {r["n_pieces"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    texts = Counter(r["text"] or "" for r in edge_docs.collect())
    assert Counter(r["text"] for r in piece_sampling.decode_pieces(encoded, MODEL).collect()) == texts
    assert piece_sampling.encode(no_docs, MODEL).count() == 0


def test_decoding_together_is_decoding_one_by_one(lattices, monkeypatch):
    texts = ["a  b▁c \n\tx日本\x00語😀 ", "", None, "abc " * 300, "Ünïcode"] * 3
    found = piece_sampling.sample_ids(lattices, texts, list(range(len(texts))))
    ends = np.cumsum([len(x) for x in found])
    for size in (1, 50, 1 << 18):
        monkeypatch.setattr(piece_sampling, "DECODED", size)
        assert piece_sampling.decode_all(lattices, np.concatenate(found), ends) == [t or "" for t in texts]
    assert piece_sampling.decode_all(lattices, np.zeros(0, np.int32), np.zeros(2, int)) == ["", ""]
