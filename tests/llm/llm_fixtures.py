"""Fixtures of these tests; imported by name, as the folder has no conftest of its own."""

import pytest

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: Rows that every operator on documents must take: null and empty texts, blanks, ties, repeats, a very long text.
EDGE_DOCS = [
    (1, None, "en", "s1"), (2, "", "en", "s1"), (3, " \t\n ", None, None), (4, "one", "fr", "s2"),
    (5, "the same text of a few words here", "en", "s1"), (6, "the same text of a few words here", "en", "s1"),
    (6, "the same text of a few words here", "en", "s1"), (None, "no id but a text of some words", "de", None),
    (7, "word " * 30_000, "en", "s1"), (8, "x" * 50_000, "en", "s2"), (9, "!!! ### 123 $$$", "en", "s1"),
    (10, "Ünïcode 日本語 😀 ΑΣ <|endoftext|> <|EndOfText|> it's ▁ here", None, "s2"),
]


@pytest.fixture()
def edge_docs(spark):
    """The edge rows with extra columns whose names clash with the operators' own."""
    rows = [(*r, len(r[1] or ""), "x", 7) for r in EDGE_DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score string, component_id int").repartition(3)


@pytest.fixture()
def no_docs(edge_docs):
    return edge_docs.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
