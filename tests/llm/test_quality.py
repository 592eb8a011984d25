import re
from collections import defaultdict

import numpy as np
import pytest

from llm_fixtures import SF_MID, SF_SMALL, documents, edge_docs, no_docs  # noqa: F401
from marginflow.llm import quality, registry


def brute(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = defaultdict(list)
    for i in range(len(ws) - 7):
        at[tuple(ws[i:i + 8])].append(i)
    covered = {j for a in at.values() if len(a) > 1 for i in a for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)]


def test_counts_and_base_rule(spark, documents):
    rows = registry.QUERIES["op10_quality_rules"](spark, SF_SMALL).collect()
    assert len(rows) == len(documents)
    for r in rows:
        exact = brute(documents[r["doc_id"]]["text"])
        assert [r[c] for c in quality.COUNTS] == exact
        assert r["base_failed"] == (exact[0] < 20 or 100 * exact[4] > 30 * exact[0])
        assert not (r["kept"] and r["base_failed"])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = [(r["quality_score"] >= 0.5) == (r["quality"] == 1) for r in rows]
    assert len(rows) > 100 and np.mean(right) > 0.97


@pytest.mark.parametrize("text", [None, "", " \n ", "a b c d e f g h " * 3, "x\nx\n x\nx", "日本 <#> é x", "w " * 9])
def test_statistics_of_odd_texts(text):
    exact, values = quality.statistics(text)
    assert exact == brute(text)
    assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()


@pytest.mark.parametrize("sign", [1, -1])
def test_monotonic_constraint_holds(sign):
    rng = np.random.default_rng(1)
    x = rng.random((3000, 2))
    y = ((np.sin(9 * x[:, 0]) + x[:, 1] + rng.normal(0, 0.3, 3000)) > 0.7).astype(float)
    trees = quality.fit_trees(x, y, [sign, 0])
    grid = np.linspace(0, 1, 60)
    for other in (0.1, 0.5, 0.9):
        p = trees.probability(np.stack([grid, np.full(60, other)], axis=1))
        assert (np.diff(p) * sign >= -1e-12).all()
    free = quality.fit_trees(x, y, [0, 0])
    assert np.mean((free.probability(x) >= 0.5) == y) > np.mean((trees.probability(x) >= 0.5) == y)


def test_flat_trees_against_a_walk():
    rng = np.random.default_rng(2)
    x = rng.random((400, 3))
    trees = quality.fit_trees(x, (x[:, 0] > x[:, 1]).astype(float), [0, 0, 0], rounds=5)

    def walk(row):
        total = trees.prior
        for node in trees.roots:
            while trees.feature[node] >= 0:
                node = (trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right)[node]
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(trees.probability(x), [walk(r) for r in x])


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(5, 1), (6, 0), (None, 1), (7, None), (5, 0)], "doc_id long, quality int")
    model = quality.fit(edge_docs, labels)
    rows = quality.judge(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 20)
    kept = quality.keep_good(edge_docs, model)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r["kept"] for r in rows)
    assert quality.judge(no_docs, model).count() == 0
    assert quality.fit(no_docs, labels.where("false")).probability(np.zeros((1, len(quality.STATISTICS)))) == 0.5
