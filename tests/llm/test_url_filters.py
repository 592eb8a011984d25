import re
import time
from collections import Counter
from itertools import combinations

import pytest

from llm_fixtures import SF_SMALL
from marginflow.llm import registry, url_filters

RULES = [url_filters.parse_rule(r) for r in registry.URL_RULES]


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")


def rule_of(host, path):
    fits = [(len(r.name), r.name, r.verdict) for r in RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, default=None)


def tokens(url):
    host, path = parts(url)
    m = re.match(r"(?s).*?://[^?#]*\?([^#]*)", url or "")
    names = re.findall(r"(?:^|&)([^&=]+)", m[1]) if m else []
    return frozenset([f"h:{x}" for x in host.split(".") if x] + [f"p:{x}" for x in path.lower().split("/") if x]
                     + [f"q:{x}" for x in names])


def mined(urls, min_support, min_confidence):
    """Verdicts of the urls that no rule decides, from all subsets of all baskets."""
    labelled = [(tokens(u), rule_of(*parts(u))[2]) for u in urls if u is not None and rule_of(*parts(u))]
    sets, with_label = Counter(), Counter()
    for ts, label in labelled:
        for n in range(1, len(ts) + 1):
            for s in combinations(sorted(ts), n):
                sets[s] += 1
                with_label[s, label] += 1
    rules = {(s, v): n / sets[s] for (s, v), n in with_label.items()
             if n >= min_support * len(labelled) and n / sets[s] >= min_confidence}
    kept = {(s, v): c for (s, v), c in rules.items()
            if not any(rules.get((p, v), -1) >= c for n in range(1, len(s)) for p in combinations(s, n))}
    out = {}
    for u in urls:
        if u is not None and not rule_of(*parts(u)):
            ts = tokens(u)
            fits = [(c, len(s), with_label[s, v], list(s), v) for (s, v), c in kept.items() if set(s) <= ts]
            out[u] = max(fits)[4] if fits else "allow"
    return out


def test_query_against_brute_force(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = registry.QUERIES["op2_url_filters"](spark, SF_SMALL).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    verdicts = mined(set(pages.values()), url_filters.MIN_SUPPORT, url_filters.MIN_CONFIDENCE)
    for r in rows:
        url = pages[r["page_id"]]
        host, path = parts(url)
        fit = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, fit and fit[1])
        assert r["verdict"] == (fit[2] if fit else verdicts[url])


EDGE = [(1, None), (2, ""), (3, "no scheme/x"), (4, "http://"), (5, "HTTP://A.Example.ORG/es/x?q=1#f"), (6, "x://org"),
        (7, "x://org/"), (8, "a://b://c.com/fr/"), (9, "http://notexample.org/es/"), (9, "http://notexample.org/es/"),
        (10, "http://com/de/"), (11, "http://x.com/de"), (12, "ftp://É.net/" + "seg/" * 50)]


def test_edge_rows(spark):
    frame = spark.createDataFrame([(*r, "old", 1) for r in EDGE], "page_id long, url string, verdict string, n int")
    rows = url_filters.judge_urls(frame, RULES, min_support=0.2).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        host, path = parts(r["url"])
        fit = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, fit and fit[1])
        assert r["verdict"] == (fit[2] if fit else r["verdict"]) and r["verdict"] in ("allow", "block")
    empty = url_filters.judge_urls(frame.where("false"), RULES)
    assert empty.count() == 0 and set(empty.columns) == {"page_id", "url", "verdict", "n", "host", "path", "rule"}
    unlabelled = url_filters.judge_urls(frame, []).collect()
    assert {r["verdict"] for r in unlabelled} == {"allow"}


def test_rules_are_pruned(spark):
    rows = [(["p:ads", "p:x", f"h:{i}"], "block") for i in range(20)] + [(["p:x", f"h:{i}"], "allow") for i in range(20)]
    found = url_filters.mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.1, 0.9).collect()
    assert [(r["antecedent"], r["verdict"]) for r in found] == [(["p:ads"], "block")]  # not the longer {ads, x}


def test_unknown_verdict_is_an_error():
    with pytest.raises(ValueError):
        url_filters.parse_rule("maybe example.org/")


def shared_names(k, drop=0):
    """Urls of two sites; one site's urls share k query names (all but ``drop`` of them)."""
    out = []
    for i in range(300):
        names = "&".join(f"utm{j}=1" for j in range(k) if not (drop and (i * 7 + j) % k < drop))
        out.append(f"http://{'example.org/es' if i % 3 else 'x.org'}/p{i % 7}?{names}&n{i % 5}=2")
    return out + [f"http://other.net/p{i % 7}?utm{i % k}=1" for i in range(20)] + [f"http://other.net/q{i}?n{i}=1" for i in range(9)]


def judged(spark, urls, **kwargs):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(4)
    return {r["url"]: r["verdict"] for r in url_filters.judge_urls(frame, RULES, **kwargs).collect()}


@pytest.mark.parametrize("k,drop", [(3, 0), (4, 1), (5, 2)])
def test_tokens_that_go_together_against_brute_force(spark, k, drop):
    urls = shared_names(k, drop)
    for confidence in (0.6, 0.9):
        want = mined(set(urls), 0.05, confidence)
        got = judged(spark, urls, min_support=0.05, min_confidence=confidence)
        assert {u: got[u] for u in want} == want


@pytest.mark.parametrize("k,drop", [(16, 0), (11, 1)])
def test_many_shared_names(spark, k, drop):
    urls = shared_names(k, drop)
    began = time.time()
    got = judged(spark, urls)
    assert time.time() - began < 60 and got.keys() == set(urls)


def test_clashing_columns(spark):
    frame = spark.createDataFrame([("http://x.org/a", 1, "a", "b")], "url string, id int, class string, tokens string")
    row = url_filters.judge_urls(frame, RULES).first()
    assert (row["id"], row["class"], row["tokens"], row["verdict"]) == (1, "a", "b", "allow")
