import pytest

from llm_fixtures import SF_SMALL, edge_docs, no_docs  # noqa: F401
from harness import compare
from marginflow.llm import line_dedup, registry


def test_query_matches_oracle(spark):
    name = "op7_line_dedup"
    assert compare(spark, registry.QUERIES[name], registry.ORACLE[name], SF_SMALL) == []


def brute(rows, max_share, min_pages):
    pages = {}
    for _, text, host in rows:
        if host is not None and text is not None:
            pages.setdefault(host, set()).add(text)
    bare = lambda line: line.strip(line_dedup.EDGE)
    out = []
    for i, text, host in rows:
        if text is None:
            out.append((i, None, 0))
            continue
        gone = set()
        for line in map(bare, text.split("\n")):
            n = sum(line in map(bare, p.split("\n")) for p in pages.get(host, ()))
            if line and n >= min_pages and n > max_share * len(pages[host]):
                gone.add(line)
        lines = [x for x in text.split("\n") if bare(x) not in gone]
        dropped = len(text.split("\n")) - len(lines)
        whole = dropped == sum(bare(x) != "" for x in text.split("\n"))
        out.append((i, text, 0) if whole else (i, "\n".join(lines), dropped))
    return out


@pytest.mark.parametrize("share,least", [(0.3, 3), (0.05, 2), (0.9, 1)])
def test_against_brute_force(spark, share, least):
    rows = [(i, f"Menu \nown line {i}\n\nshared {i % 3}\n\tMenu", f"h{i % 2}") for i in range(12)]
    rows += [(12, "Menu", "h0"), (13, "Menu\nMenu", "h0"), (14, None, "h0"), (15, "Menu\nx", None), (16, "", "h1"),
             (17, "Menu\nalone", "h9"), (0, rows[0][1], "h0")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_dedup.clean_lines(frame, share, least).select("doc_id", "text", "n_dropped").collect()
    key = lambda r: (r[0], str(r[1]))
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, share, least), key=key)


def test_a_copied_page_is_not_boilerplate(spark):
    rows = [(i, "a page copied often\nwith two lines", "h") for i in range(50)]
    rows += [(50 + i, f"page {i}\nof its own", "h") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in line_dedup.clean_lines(frame).collect()}
    assert got[0]["text"] == rows[0][1] and got[0]["n_dropped"] == 0
    assert got[60]["text"] == "page 10" and got[60]["n_dropped"] == 1


def test_edge_rows(edge_docs, no_docs):
    got = line_dedup.clean_lines(edge_docs)
    assert got.count() == edge_docs.count() and set(edge_docs.columns) < set(got.columns)
    assert line_dedup.clean_lines(no_docs).count() == 0
