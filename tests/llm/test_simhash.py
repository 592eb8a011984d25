import numpy as np
import pytest
import xxhash

from llm_fixtures import SF_SMALL, documents, edge_docs, no_docs  # noqa: F401
from marginflow.llm import registry, simhash


def brute_fingerprint(text):
    ws = (text or "").encode().lower().split()
    shingles = [b" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits=4):
    v = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= bits
    label = np.array(ids)
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label.tolist()
        label = new


def test_query_against_all_pairs(spark, documents):
    rows = {r["doc_id"]: r for r in registry.QUERIES["op8_simhash_near_dedup"](spark, SF_SMALL).collect()}
    ids = sorted(documents)
    fps = [brute_fingerprint(documents[i]["text"]) for i in ids]
    assert [rows[i]["fingerprint"] for i in ids] == [f"{f:016x}" for f in fps]
    assert [rows[i]["component_id"] for i in ids] == brute_components(ids, fps)


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("frontier", [7, 100_000])
def test_trie_join_against_all_pairs(seed, frontier, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, 30, dtype=np.uint64)
    parts = [base]
    for _ in range(5):
        x = base.copy()
        for _ in range(rng.integers(1, 7)):
            x ^= np.uint64(1) << rng.integers(0, 64, len(x)).astype(np.uint64)
        parts.append(x)
    v = np.unique(np.concatenate(parts))
    for key_bits in (0, 4):
        key = v >> np.uint64(64 - key_bits) if key_bits else np.zeros(len(v), dtype=np.uint64)
        near = (np.bitwise_count(v[:, None] ^ v[None, :]) <= 4) & (key[:, None] == key[None, :])
        label = np.arange(len(v))
        while True:
            new = np.array([label[n].min() for n in near])
            if (new == label).all():
                break
            label = new
        assert (simhash.trie_links(v, key_bits, 4) == label).all()


def test_a_dense_group_split_into_chunks(spark):
    rng = np.random.default_rng(3)
    v = np.full(900, np.uint64(0x123456789ABCDEF0))
    for _ in range(3):
        v ^= np.uint64(1) << rng.integers(0, 64, len(v)).astype(np.uint64)
    v = np.unique(np.concatenate([v, rng.integers(0, 2**64, 100, dtype=np.uint64)]))
    frame = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    roots = simhash.connected(simhash.near_links(frame, bits=4, chunk=64)).collect()
    root = {r["node"]: r["root"] for r in roots}
    found = {}
    for x in v.view(np.int64).tolist():
        found.setdefault(root.get(x, x), set()).add(x)
    label = brute_components(list(range(len(v))), v.tolist())
    expected = {}
    for x, y in zip(v.view(np.int64).tolist(), label):
        expected.setdefault(y, set()).add(x)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    root = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    assert root == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert simhash.connected(edges.where("false")).count() == 0


def test_rounds_grow_with_the_logarithm_of_a_path(spark, monkeypatch):
    names, write = [], simhash.written
    monkeypatch.setattr(simhash, "written", lambda df, name: (names.append(name), write(df.coalesce(1), name))[1])
    edges = spark.range(1999).selectExpr("id AS a", "id + 1 AS b")
    root = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    assert root == {i: 0 for i in range(2000)}
    assert names.count("moves") < 25


def test_hot_keys_are_joined_apart(spark):
    from marginflow.llm.common import join_hot
    rows = simhash.written(spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id AS v"), "rows")
    lookup = simhash.written(spark.range(3000).selectExpr("id AS k", "id * 2 AS w").where("k <> 8"), "lookup")
    got = sorted((r["k"], r["v"], r["w"]) for r in join_hot(rows, lookup, "k").collect())
    want = [(7 if v % 3 == 0 else v, v) for v in range(3000)]
    assert got == sorted((k, v, 2 * k) for k, v in want if k != 8)


def test_edge_rows(edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    component = {r["doc_id"]: r["component_id"] for r in rows}
    assert component[1] == component[2] == component[3] == 1 and component[5] == component[6] == 5
    assert component[None] is None
    assert {r["fp"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 4, 5, None, 7, 8, 9, 10], key=str)
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.drop_near_duplicates(no_docs).count() == 0


def test_repeated_rows_keep_one(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "quite another text than that"), (0, "quite another text than that")]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept)) == [(0, "quite another text than that"), (1, "a b c d e f")]


def test_ids_of_other_types(spark):
    rows = [("b", "a b c d e f"), ("a", "a b c d e f"), ("c", "quite another text than that"), (None, "quite another text than that")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect()}
    assert got == {"b": "a", "a": "a", "c": "c", None: "c"}
    assert sorted(r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()) == ["a", "c"]
