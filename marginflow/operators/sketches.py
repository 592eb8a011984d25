"""Sketches that are stored once and merged later: quantiles (KLL) and distinct counts (HLL).

A sketch per partition, day or vendor is a few KB, whatever it has seen; sketches of
parts merge to the sketch of the whole, so a new day is added without reading the old
ones. Both are approximate, with a stated error, and are the caller's choice beside the exact
operators (``functions/quantiles.py``, ``reports.distinct_counts``), never a fallback.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Accuracy of a quantile sketch, and log2 of the registers of a distinct-count sketch.
KLL_K, HLL_LG_K = 800, 14


def rank_error(k: int = KLL_K) -> float:
    """By how much the rank of a returned quantile differs from the wanted one, as a share of all
    values, in 99 % of cases (the KLL sketch's published fit)."""
    return 2.296 / k ** 0.9021


def distinct_error(lg_k: int = HLL_LG_K) -> float:
    """One standard deviation of a distinct count's relative error, merged sketches included."""
    return 1.04 / math.sqrt(1 << lg_k)


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """(*by, metric, n, sketch): a sketch of each column in each group. NULL and NaN
    are left out; a group without other values of a column has no row for it."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("_x")) for c in columns]))
    rows = df.select(*by, values.alias("_v")).select(*by, "_v.*").where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    return rows.groupBy(*by, "metric").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_x", k).alias("sketch"))


def merge_quantiles(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of the parts in each group, as one."""
    return sketches.groupBy(*by, "metric").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, ps: Sequence[float]) -> DataFrame:
    """(..., metric, n, p, value) for each sketch and p."""
    keep = [c for c in sketches.columns if c != "sketch"]
    wanted = F.array(*[F.lit(float(p)) for p in ps])
    found = F.kll_sketch_get_quantile_double("sketch", wanted)
    return sketches.select(*keep, F.explode(F.arrays_zip(wanted.alias("p"), found.alias("value"))).alias("_q")).select(*keep, "_q.p", "_q.value")


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = HLL_LG_K) -> DataFrame:
    """(*by, metric, sketch): a sketch of each column's distinct values in each group; NULL is no value."""
    cols = [F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), F.lit(lg_k)).alias(f"_s{i}") for i, c in enumerate(columns)]
    wide = df.groupBy(*by).agg(*cols)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)]))
    return wide.select(*by, rows.alias("_r")).select(*by, "_r.*")


def merge_distinct(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The union of the parts' sketches in each group. Its registers are those of a sketch of all rows;
    the estimate from them may differ by the order of merging, within the stated error."""
    return sketches.groupBy(*by, "metric").agg(F.hll_union_agg("sketch").alias("sketch"))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """(..., metric, distinct): the estimate of each sketch."""
    return sketches.withColumn("distinct", F.hll_sketch_estimate("sketch")).drop("sketch")
