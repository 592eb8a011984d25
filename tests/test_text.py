"""Tokens, n-grams and TF-IDF against a brute-force Python implementation."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marginflow.functions.stopwords import ENGLISH
from marginflow.operators import text

NAMES = ["Café Chair Deluxe", "the and of", "Binder", "Ring ring Binder", "Large ring binder",
         "Chair 2000 café", "x y"]


@pytest.fixture(scope="module")
def tx(spark):
    rows = []
    for i, n in enumerate(NAMES):
        rows.append((n, 100.0 * (i + 1), 10.0 * i, 0.1, f"Cat{i % 2}", f"Sub{i}", i * 2))
        rows.append((n, 50.0, -5.0, 0.3, "Late", "Late", i * 2 + 1))
    rows.append(("Zero Sales", 0.0, 1.0, 0.0, "Cat", "Sub", 99))
    return spark.createDataFrame(rows, "`Product Name` string, Sales double, Profit double, "
                                       "Discount double, Category string, `Sub-Category` string, _row_order long")


def brute_terms(name, stop):
    toks = [t for t in re.findall(r"[^\W]{2,}", name.lower()) if t not in stop]
    return toks + [a + " " + b for a, b in zip(toks, toks[1:])]


def test_rollup_first_by_order_and_zero_sales(spark, tx):
    rows = {r["Product Name"]: r for r in text.product_rollup(tx).collect()}
    assert rows["Binder"].Category == "Cat0" and rows["Binder"].Sub_Category == "Sub2"
    assert rows["Binder"].Sales == 350.0 and rows["Binder"].Discount == pytest.approx(0.2)
    assert rows["Zero Sales"].Margin_Pct is None            # no division by zero


def test_tokens_and_ngrams(spark, tx):
    stop = set(ENGLISH)
    prod = text.product_rollup(tx)
    got = {r["Product Name"]: r.terms for r in text.product_terms(prod).collect()}
    for n in NAMES:
        assert got[n] == brute_terms(n, stop), n
    assert got["the and of"] == []                          # stop words only
    assert got["Ring ring Binder"] == ["ring", "ring", "binder", "ring ring", "ring binder"]
    assert got["Café Chair Deluxe"][0] == "café"           # non-ASCII letters are word characters


def test_tfidf_matches_brute_force(spark, tx):
    stop = set(ENGLISH)
    prod = text.product_rollup(tx)
    weights, vocab = text.tfidf(prod, max_features=6)
    docs = {r["Product Name"]: brute_terms(r["Product Name"], stop) for r in prod.collect()}
    ctf = Counter(t for ts in docs.values() for t in ts)
    voc = sorted(ctf, key=lambda t: (-ctf[t], t))[:6]
    dfc = Counter(t for ts in docs.values() for t in set(ts))
    n = len(docs)
    exp = {}
    for name, ts in docs.items():
        tf = Counter(t for t in ts if t in voc)
        raw = {t: c * (math.log((1 + n) / (1 + dfc[t])) + 1) for t, c in tf.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        exp.update({(name, t): v / norm for t, v in raw.items()})
    got = {(r["Product Name"], r.term): r.weight for r in weights.collect()}
    assert got.keys() == exp.keys()
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, rel=1e-12)
    assert sorted(r.idx for r in vocab.collect()) == list(range(6))


def test_seeded_clusters_and_summaries(spark, tx):
    prod = text.product_rollup(tx)
    weights, _ = text.tfidf(prod)
    cl = text.seeded_text_clusters(prod, weights, k=3)
    assert cl.count() == prod.count()
    summ = text.cluster_summary(prod, cl).collect()
    assert sum(r.n_products for r in summ) == prod.count()
    top = text.cluster_top_terms(weights, cl, top=2).collect()
    assert all(r.term_rank <= 2 for r in top)


def test_rollup_takes_the_first_value_that_is_not_null_and_sums_nothing_to_zero(spark):
    rows = [("a", 1.0, None, 0.1, None, "S", 1), ("a", 2.0, 3.0, None, "Cat", None, 2), ("a", None, 1.0, 0.3, "Late", "T", 3),
            ("b", None, None, None, None, None, 4)]
    tx = spark.createDataFrame(rows, "`Product Name` string, Sales double, Profit double, Discount double, "
                                     "Category string, `Sub-Category` string, _row_order long")
    got = {r["Product Name"]: r for r in text.product_rollup(tx).collect()}
    assert (got["a"].Category, got["a"].Sub_Category) == ("Cat", "S")
    assert (got["a"].Sales, got["a"].Profit, round(got["a"].Discount, 9)) == (3.0, 4.0, 0.2)
    assert (got["b"].Sales, got["b"].Profit, got["b"].Discount, got["b"].Category) == (0.0, 0.0, None, None)
