"""Tokenisation for product-name TF-IDF (JVM-side expressions only).

Token rule: lower-case, then maximal runs of 2+ letters, digits or "_"
(the default word pattern of common TF-IDF vectorizers); stop words removed
(duplicates kept); n-grams built from the remaining tokens.

The stop-word list is a parameter: any list of words may be passed. The default
is the plain constant ``stopwords.ENGLISH`` (the words Spark ML's
``StopWordsRemover`` loads), shared by the operators and the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginflow.constants import TOKEN_PATTERN
from marginflow.functions.stopwords import ENGLISH


def tokens(c: Column | str, stop_words: Sequence[str] | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    toks = F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 1)
    stop = list(ENGLISH if stop_words is None else stop_words)
    if not stop:
        return toks
    return F.filter(toks, lambda t: ~t.isin(stop))


def ngrams_1_2(toks: Column) -> Column:
    """Unigrams followed by space-joined bigrams of adjacent tokens."""
    bigrams = F.when(F.size(toks) > 1, F.transform(
        F.sequence(F.lit(0), F.size(toks) - 2),
        lambda i: F.concat(F.element_at(toks, i + 1), F.lit(" "), F.element_at(toks, i + 2)))
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(toks, bigrams)
