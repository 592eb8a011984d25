import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from llm_fixtures import SF_SMALL, edge_docs, no_docs  # noqa: F401
from marginflow.llm import langid, line_dedup, quality, registry, simhash
from test_line_dedup import brute as brute_lines
from test_simhash import brute_components, brute_fingerprint


def pieces_of(texts):
    t = Tokenizer.from_str(registry.tokenizer_json())
    out = Counter()
    for i, text in texts:
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        for at in range(0, len(ids), 2048):
            cut = ids[at:at + 2048]
            out[(i, at // 2048, at, len(cut), zlib.crc32(cut.tobytes()))] += 1
    return out


def test_run_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    # the two models decide the first stages; the others are done again by hand
    found = langid.predict(docs, langid.fit(docs)).where(
        (F.col("lang_pred") != "und") & (F.col("score") >= corpus_pipeline.MIN_LANGUAGE_SCORE))
    kept = docs.join(found.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    good = quality.judge(kept, quality.fit(kept, labels)).where("kept")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in kept.join(good.select("doc_id"), "doc_id", "left_semi").collect()]
    cleaned = [(i, t) for i, t, _ in brute_lines(rows, line_dedup.MAX_SHARE, line_dedup.MIN_PAGES)]
    ids = [i for i, _ in cleaned]
    least = brute_components(ids, [brute_fingerprint(t) for _, t in cleaned])
    expected = pieces_of([(i, t) for (i, t), c in zip(cleaned, least) if i == c])
    got = __spark_entry__.queries()["pipeline"](spark, SF_SMALL).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    import numpy as np
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in got)
    assert 0 < len(ids) < docs.count() and len(set(least)) < len(ids)


def test_stages(spark, edge_docs, no_docs):  # noqa: F811
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality_rules", "line_dedup", "simhash_near_dedup", "best_fit_packing"]
    columns = [F.col(c) for c in corpus_pipeline.COLUMNS]
    for docs in (edge_docs.select(*columns), no_docs.select(*columns)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= docs.count()


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and "op7_line_dedup" in __spark_entry__.oracle_sql()
    assert simhash.BLOCKS and sum(simhash.BLOCKS) == 64
