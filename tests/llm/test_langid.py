import numpy as np

from llm_fixtures import SF_MID, SF_SMALL, edge_docs, no_docs  # noqa: F401
from marginflow.llm import langid, registry


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = registry.QUERIES["op9_language_id"](spark, SF_MID).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and len(held) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_filters_hold_what_was_put_in(spark):
    rng = np.random.default_rng(0)
    masks = np.zeros(1 << langid.SLOTS_LOG2, dtype=np.uint64)
    grams = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    for probe in range(langid.PROBES):
        np.bitwise_or.at(masks, langid.slots_of(grams, probe), np.uint64(2))
    model = langid.Model(["a", "b"], masks)
    found = masks[langid.slots_of(grams, 0)] & masks[langid.slots_of(grams, 1)]
    assert (found == 2).all() and model.by_chance[0] == 0 and 0 < model.by_chance[1] < 1e-3


def test_gram_hashes_against_plain_windows():
    texts = ["Ab c", "", "x", "É日本 z9z"]
    h, owner = langid.gram_hashes(texts)
    for i, t in enumerate(texts):
        flat = "".join(c.lower() if c.isalpha() else " " for c in t)
        padded = "  " + flat + "  "
        grams = [padded[j:j + 3] for j in range(len(padded) - 2)]
        grams = [g for g in grams if sum(c != " " for c in g) >= 2]
        assert (owner == i).sum() == len(grams)
        if grams:
            again, _ = langid.gram_hashes([t])
            assert (again == h[owner == i]).all() and len(set(again.tolist())) == len(set(grams))


def test_edge_rows(spark, edge_docs, no_docs):
    model = langid.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    rows = langid.predict(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 9)} == {"und"}
    assert all(r["lang_pred"] != "und" for r in rows if r["doc_id"] in (5, 7, 8, 10))
    kept = langid.keep_identified(edge_docs, model, 0.0)
    assert kept.columns == edge_docs.columns and {r["doc_id"] for r in kept.collect()} == {4, 5, 6, None, 7, 8, 10}
    assert langid.predict(no_docs, model).count() == 0
    untrained = langid.fit(no_docs)
    assert {r["lang_pred"] for r in langid.predict(edge_docs, untrained).collect()} == {"und"}


def test_more_languages_than_bits_in_a_word(spark):
    rng = np.random.default_rng(4)
    words = {f"l{i:03}": ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(6)] for i in range(150)}
    rows = [(i * 10 + j, " ".join(rng.choice(w, 12)), x) for i, (x, w) in enumerate(words.items()) for j in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.languages) == 150 and len(model.masks) == 3
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(df, model).collect()}
    assert np.mean([got[i] == x for i, _, x in rows]) > 0.95


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    rows = [(None, f"text number {chr(97 + i % 26)}{chr(97 + i // 26)} here", "en") for i in range(200)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=50)
    assert model.masks.any()
