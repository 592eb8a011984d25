import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from llm_fixtures import SF_SMALL, documents, edge_docs, no_docs  # noqa: F401
from marginflow.llm import order_minhash, registry


def likeness(a, b):
    cut = lambda s: [s[i:i + 8] for i in range(0, len(s), 8)]
    pairs = [(x, y) for x, y in zip(cut(a), cut(b)) if x != order_minhash.EMPTY or y != order_minhash.EMPTY]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 1.0


def check(rows, texts):
    """texts: (doc_id, text) in the order of the chain."""
    by_id = {r["doc_id"]: r for r in rows}
    for (i, text), (j, after) in zip(texts, texts[1:] + texts[:1]):
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        r = by_id[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r["near_edited"] - likeness(r["fingerprint"], r["edited_fingerprint"])) < 1e-12
        assert abs(r["near_next"] - likeness(r["fingerprint"], by_id[j]["fingerprint"])) < 1e-12


def test_query(spark, documents):  # noqa: F811
    rows = registry.QUERIES["op5_document_fingerprints"](spark, SF_SMALL).collect()
    check(rows, [(i, documents[i]["text"]) for i in sorted(documents)])
    by_text = {}
    for r in rows:
        assert by_text.setdefault(documents[r["doc_id"]]["text"], r["fingerprint"]) == r["fingerprint"]
    assert sum(r["near_edited"] for r in rows) / len(rows) > 0.25 > sum(r["near_next"] for r in rows) / len(rows)


def plain_signatures(us, picks=order_minhash.PICKS):
    """The selected hashes of each range, in text order."""
    out = []
    for b in range(order_minhash.BUCKETS):
        own = [(u, i) for i, u in enumerate(us) if (u & (2**64 - 1)) >> (64 - order_minhash.BUCKETS_LOG2) == b]
        out.append([u for u, i in sorted(sorted(own)[:picks], key=lambda x: x[1])])
    return out


def test_selection_and_numbering_against_plain_python(spark):
    texts = ["a b c d e f g", "a a a a a a", "x y x y x y x y z", "", "one", "two words", " ".join(str(i % 17) for i in range(300)),
             " ".join(str(i) for i in range(500))]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    kmers = order_minhash.kmer_hashes(order_minhash.words(F.col("text")))
    frame = frame.withColumn("k", kmers).withColumn("u", order_minhash.numbered(kmers)).withColumn(
        "s", order_minhash.signatures(F.col("text")))
    rows = frame.collect()
    pairs = sorted({(k, n) for r in rows for k in set(r["k"]) for n in range(r["k"].count(k))})
    table = {(p["k"], p["n"]): p["u"] for p in spark.createDataFrame(pairs, "k long, n int").withColumn(
        "u", F.xxhash64("k", "n")).collect()}
    tuples = {}
    for r in rows:
        seen = Counter()
        expected = []
        for k in r["k"]:
            expected.append(table[k, seen[k]])
            seen[k] += 1
        assert r["u"] == expected and len(r["k"]) == max(0, len(r["text"].split()) - 2) or len(r["text"].split()) in (1, 2)
        tuples[r["id"]] = plain_signatures(r["u"])
    flat = [(i, b, t) for i, bs in tuples.items() for b, t in enumerate(bs) if t]
    hashed = {(h["i"], h["b"]): h["h"] for h in spark.createDataFrame(flat, "i int, b int, t array<long>").withColumn(
        "h", F.lower(F.substring(F.lpad(F.hex(F.xxhash64("t")), 16, "0"), 9, 8))).collect()}
    for r in rows:
        assert r["s"] == [hashed.get((r["id"], b), order_minhash.EMPTY) for b in range(order_minhash.BUCKETS)]


def test_order_matters(spark):
    ws = [f"w{i}" for i in range(200)]
    blocks = [ws[i:i + 10] for i in range(0, 200, 10)]
    rows = [(0, " ".join(ws)), (1, " ".join(w for b in reversed(blocks) for w in b))]  # nearly the same k-mers
    a, b = [r["s"] for r in spark.createDataFrame(rows, "i int, text string").select(
        order_minhash.signatures(F.col("text")).alias("s"), "i").orderBy("i").collect()]
    near = sum(x == y for x, y in zip(a, b)) / order_minhash.BUCKETS
    assert near < 0.6  # as a set they are about 0.7 alike


def plain_filled(us, picks=order_minhash.PICKS):
    """The first hashes from the start of each range, going round, in text order."""
    out, width = [], 64 - order_minhash.BUCKETS_LOG2
    for b in range(order_minhash.BUCKETS):
        ahead = sorted(((u - (b << width)) % 2**64, i) for i, u in enumerate(us))[:picks]
        out.append([us[i] for i in sorted(i for _, i in ahead)])
    return out


def test_filled_ranges_against_plain_python(spark):
    texts = ["", "one", "two words", "a b c d", "a a a a a a"] + [" ".join(str(i) for i in range(n)) for n in (9, 15, 30, 60, 90, 500)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = frame.withColumn("u", order_minhash.numbered(order_minhash.kmer_hashes(order_minhash.words(F.col("text"))))).withColumn(
        "s", order_minhash.signatures(F.col("text"), fill=True)).withColumn("bare", order_minhash.signatures(F.col("text"))).collect()
    flat = []
    for r in rows:
        own = plain_filled(r["u"])
        assert all(len(t) == min(order_minhash.PICKS, len(r["u"])) for t in own)
        flat += [(r["id"], b, t) for b, t in enumerate(own) if t]
    hashed = {(h["i"], h["b"]): h["h"] for h in spark.createDataFrame(flat, "i int, b int, t array<long>").withColumn(
        "h", F.lower(F.substring(F.lpad(F.hex(F.xxhash64("t")), 16, "0"), 9, 8))).collect()}
    for r in rows:
        assert r["s"] == [hashed.get((r["id"], b), order_minhash.EMPTY) for b in range(order_minhash.BUCKETS)]
    assert rows[-1]["s"] == rows[-1]["bare"] and rows[7]["s"] != rows[7]["bare"]  # a long text needs no filling


def test_order_matters_in_short_texts(spark):
    draw, rows = random.Random(5), []
    for i in range(80):
        n = 15 + 5 * (i % 10)
        ws = [f"w{draw.randrange(10**6)}" for _ in range(n)]
        moved = [w for at in reversed(range(0, n, 5)) for w in ws[at:at + 5]]  # three k-mers of five stay
        rows += [(2 * i, " ".join(ws)), (2 * i + 1, " ".join(moved))]
    got = {r["doc_id"]: r["near_next"] for r in order_minhash.compare_with_edit(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    shortest, all_ = [got[2 * i] for i in range(80) if i % 10 < 4], [got[2 * i] for i in range(80)]
    assert sum(shortest) / len(shortest) < 0.25 and sum(all_) / len(all_) < 0.2  # as sets they are about 0.45 alike


def test_edge_rows(spark, edge_docs, no_docs):  # noqa: F811
    rows = order_minhash.compare_with_edit(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == order_minhash.EMPTY * order_minhash.BUCKETS
    assert by_id[1]["near_next"] == 1.0 and by_id[5]["near_next"] == 1.0
    assert order_minhash.compare_with_edit(no_docs).count() == 0
    one = order_minhash.compare_with_edit(edge_docs.where("doc_id = 10")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    unique = [(r["doc_id"], r["text"] or "") for r in edge_docs.where("doc_id <> 6").orderBy("doc_id").collect()]
    check(order_minhash.compare_with_edit(edge_docs.where("doc_id <> 6")).collect(), unique)
