"""Line deduplication by site-relative frequency, in DataFrame operations only.

A line is boilerplate of its host if the host's pages that hold it, divided by
all of the host's pages, exceed ``max_share``. Exact copies of a page count as
one page, so a copied page does not turn its own text into boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.llm.common import written

MAX_SHARE = 0.02
MIN_PAGES = 5
#: White space that does not tell two lines apart, at either end.
EDGE = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """64-bit hash of a line without white space at its ends; null for a blank line."""
    bare = F.btrim(line, F.lit(EDGE))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(docs: DataFrame, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES,
                host_col: str = "source", text_col: str = "text") -> DataFrame:
    """(host, drop): each host's boilerplate lines, as an array of their hashes.

    A page with k lines adds at most k / pages to the shares of its host's lines,
    so a host has at most (lines a page) / ``max_share`` of them. Lines on fewer
    than ``min_pages`` pages never count, which leaves hosts of a few pages alone."""
    pages = docs.where(F.col(host_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(host_col).alias("host"), F.xxhash64(text_col).alias("page"),
        F.array_distinct(F.array_compact(F.transform(_lines(F.col(text_col)), _key))).alias("keys"))
    held = (pages.select("host", "page", F.explode("keys").alias("key"))
            .groupBy("host", "key").agg(F.count_distinct("page").alias("pages")).where(F.col("pages") >= min_pages))
    totals = pages.groupBy("host").agg(F.count_distinct("page").alias("total"))
    return (held.join(totals, "host").where(F.col("pages") > max_share * F.col("total"))
            .groupBy("host").agg(F.array_sort(F.collect_list("key")).alias("drop")))


def clean_lines(docs: DataFrame, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES,
                host_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text_col``, and the columns
    ``n_lines`` (lines that are not blank) and ``n_dropped`` added.

    Blank lines stay. A page that has no other lines keeps its text: what is left
    of a page cannot be nothing. Null texts and texts of a null host are returned
    as they are; repeated rows each get a row and count as one page; an empty
    table gives no rows; all further columns are kept, but one named ``n_lines`` or
    ``n_dropped`` is replaced."""
    # written first, so that its size is known when the join is planned: a small table is
    # broadcast and no text is shuffled; beyond that AQE splits the pages of a hot host
    drops = written(boilerplate(docs, max_share, min_pages, host_col, text_col), "boilerplate").select(
        F.col("host").alias("__host"), F.col("drop").alias("__drop"))
    joined = docs.join(drops, F.col(host_col) == F.col("__host"), "left")
    text = F.col(text_col)
    gone = lambda line: F.coalesce(F.array_contains("__drop", _key(line)), F.lit(False))
    kept = F.filter(_lines(text), lambda line: ~gone(line))
    worded = F.size(F.filter(_lines(text), lambda line: F.btrim(line, F.lit(EDGE)) != ""))
    dropped = F.when(F.col("__drop").isNull(), 0).otherwise(F.size(F.filter(_lines(text), gone)))
    counted = joined.withColumn("n_lines", F.when(text.isNotNull(), worded).otherwise(0)).withColumn(
        "n_dropped", F.when(text.isNotNull(), dropped).otherwise(0))
    whole = F.col("n_dropped") == F.col("n_lines")
    return (counted.withColumn("n_dropped", F.when(whole, 0).otherwise(F.col("n_dropped")))
            .withColumn(text_col, F.when((F.col("n_dropped") > 0), F.array_join(kept, "\n")).otherwise(text))
            .drop("__host", "__drop"))
