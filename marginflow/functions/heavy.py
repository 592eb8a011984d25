"""The most frequent terms, by mergeable counters and an exact second count.

Each task keeps a bounded number of counters: beyond it, the next largest count is
taken off all of them and the rest dropped, so a counter is too low by no more than
what was taken off. Added up over the tasks, a term's count lies between its counters' sum and that
sum plus all that was taken off; a term without a counter occurs no more often
than that. Terms that can be among the most frequent are then counted exactly. Where the
bound cannot tell the top terms from those without a counter, the counters
are doubled, so the result is exact for any input.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.session import written

COUNTERS = 1 << 14


def term_counters(docs: DataFrame, terms_col: str, counters: int) -> DataFrame:
    """(term, low): each task's counters; the row of a NULL term is what was taken off."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        off = 0
        for batch in batches:
            terms = batch.column(0).flatten()
            for pair in terms.value_counts().to_pylist():
                if pair["values"] is not None:
                    held[pair["values"]] += pair["counts"]
            if len(held) > 2 * counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = Counter({t: n - cut for t, n in held.items() if n > cut})
                off += cut
        yield pa.RecordBatch.from_pydict({"term": pa.array([None, *held], pa.string()),
                                          "low": pa.array([off, *held.values()], pa.int64())})

    return docs.select(F.coalesce(F.col(terms_col), F.array().cast("array<string>"))).mapInArrow(count, "term string, low long")


def top_candidates(docs: DataFrame, terms_col: str, top: int, counters: int = COUNTERS) -> DataFrame:
    """(term): a set that holds the ``top`` most frequent terms, ties included."""
    while True:
        sums = written(term_counters(docs, terms_col, counters).groupBy("term").agg(F.sum("low").alias("low")), "term-counters")
        off = sums.where("term IS NULL").agg(F.sum("low")).first()[0] or 0
        named = sums.where("term IS NOT NULL")
        # at least ``top`` terms occur this often
        best = named.orderBy(F.desc("low")).limit(top).agg(F.count(F.lit(1)), F.min("low")).first()
        least = best[1] if best[0] == top else 0
        if off == 0 or off < least:
            return named.where(F.col("low") + off >= least).select("term")
        counters *= 2
