"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.session import written

__all__ = ["SPACE", "written", "id_crc", "join_hot", "let", "text_slices", "words"]

#: Bytes of text (about) whose results a task hands on together.
HANDED_ON = 1 << 21

#: A key is hot if it has more than one in so many of all rows.
HOT_SHARE = 1000

#: Java regular expression of the white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"


def id_crc(c: Column) -> Column:
    """crc32 of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The white-space separated words of a text (null: none), JVM-side."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def join_hot(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """``rows JOIN lookup USING key`` for written ``rows`` and a ``lookup`` of one row a key
    (not null). The rows of hot keys, at most ``HOT_SHARE`` keys, are joined by a broadcast of these
    keys' rows, so that no task of the other rows' join gets more than a small share of them."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    hot = written(counts.where(F.col("__n") * HOT_SHARE > rows.count()).select(key), "hot-keys")
    hot_rows = written(lookup.join(F.broadcast(hot), key, "left_semi"), "hot-lookup")
    cold = rows.join(F.broadcast(hot), key, "left_anti")
    return rows.join(F.broadcast(hot_rows), key).unionByName(cold.join(lookup, key))


def text_slices(batches: Iterator[pa.RecordBatch], column: int, size: int = HANDED_ON) -> Iterator[pa.RecordBatch]:
    """The batches cut into rows with about ``size`` bytes of text in a column, one row at least, so
    that what is made of them is handed on before it has piled up."""
    for batch in batches:
        upto = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            begun = int(upto[at - 1]) if at else 0
            end = max(int(np.searchsorted(upto, begun + size)), at + 1)
            yield batch.slice(at, end - at)
            at = end
