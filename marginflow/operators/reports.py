"""Ranking, gap and exploratory-summary reports over the summary tables.

Top-k reports use ``orderBy(..).limit(k)`` with a total order (tiebreak keys
NULLS LAST, as in the SQL oracle), which Spark plans as a distributed top-k
(each task keeps k rows). The per-vendor top
brand avoids a window partitioned by vendor (a vendor with a third of all
rows would be one task): the max per vendor is a partial aggregate, and the
rows that reach it are found by a join on (vendor, value), which spreads a
hot vendor's rows over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginflow.constants import CROP_QUANTILE, KPI_SUMMARY_COLUMNS, TOP_N, VALUE_COUNTS_N
from marginflow.functions.quantiles import exact_percentile_value, percentile_values, percentiles_of



def top_vendors_by(df: DataFrame, column: str, n: int = TOP_N, digits: int | None = 2) -> DataFrame:
    """``SELECT VendorName, ROUND(SUM(col), 2) .. GROUP BY VendorName ORDER BY 2 DESC LIMIT n``."""
    total = F.sum(column)
    total = F.round(total, digits) if digits is not None else total
    return (df.groupBy("VendorName").agg(total.alias(column))
              .orderBy(F.desc_nulls_last(column), F.asc_nulls_last("VendorName"))
              .limit(n))


def top_brand_per_vendor(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """RANK() = 1 per vendor by TotalSalesDollars DESC (ties all kept), top n overall."""
    best = df.groupBy(F.col("VendorName").alias("_bv")).agg(F.max("TotalSalesDollars").alias("_best"))
    tops = (df.join(best, (F.col("VendorName").eqNullSafe(F.col("_bv")))
                    & (F.col("TotalSalesDollars").eqNullSafe(F.col("_best"))))
              .select("VendorName", "Brand", "Description", "TotalSalesDollars",
                      F.lit(1).cast("int").alias("rnk")))
    return tops.orderBy(F.desc_nulls_last("TotalSalesDollars"), *[F.asc_nulls_last(c) for c in
                        ("VendorName", "Brand", "Description")]).limit(n)


def ranked_brands(df: DataFrame, max_rank: int | None = None) -> DataFrame:
    """RANK() of every brand within its vendor by TotalSalesDollars DESC (NULLs last),
    down to ``max_rank`` (None: all).

    With a limit Spark keeps the best rows of each vendor map-side (WindowGroupLimit)
    before the shuffle, so a vendor with many rows sends few."""
    w = Window.partitionBy("VendorName").orderBy(F.desc_nulls_last("TotalSalesDollars"))
    ranked = df.select("VendorName", "Brand", "Description", "TotalSalesDollars", F.rank().over(w).alias("rnk"))
    return ranked if max_rank is None else ranked.where(F.col("rnk") <= max_rank)


def unsold_gap(df: DataFrame, n: int = TOP_N) -> DataFrame:
    """Pairs bought more than sold (NULL sales drop), largest unsold units first."""
    gap = F.col("TotalPurchaseQuantity") - F.col("TotalSalesQuantity")
    return (df.where(F.col("TotalPurchaseQuantity") > F.col("TotalSalesQuantity"))
              .select("VendorName", "Brand", "TotalPurchaseQuantity", "TotalSalesQuantity",
                      gap.alias("UnsoldUnits"))
              .orderBy(F.desc("UnsoldUnits"), *[F.asc_nulls_last(c) for c in
                       ("VendorName", "Brand", "TotalPurchaseQuantity")])
              .limit(n))


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(f("VendorName").alias("unique_vendors"), f("Brand").alias("unique_brands"))


def value_counts(df: DataFrame, column: str, n: int = VALUE_COUNTS_N) -> DataFrame:
    """``value_counts().head(n)``: most frequent first, ties by value."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.desc("count"), F.asc(column)).limit(n))


def column_summary(df: DataFrame, columns: Sequence[str] = KPI_SUMMARY_COLUMNS) -> DataFrame:
    """mean / median / min / max per column, one row per metric.

    The three plain figures come from one wide aggregate, whose single row is
    turned into a row per metric; the medians from one selection over all columns."""
    x = {c: F.col(c).cast("double") for c in columns}
    medians = percentiles_of(df, {c: (v, [0.5]) for c, v in x.items()})
    wide = df.agg(*[f(v).alias(f"{n}_{i}") for i, v in enumerate(x.values())
                    for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))])
    return wide.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("metric"), F.col(f"mean_{i}").alias("mean"), F.lit(medians[c][0]).cast("double").alias("median"),
        F.col(f"min_{i}").alias("min"), F.col(f"max_{i}").alias("max")) for i, c in enumerate(columns)])).alias("c")).select("c.*")


def null_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and NULL cells of a frame, in one pass."""
    nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    return df.select(nulls.alias("_n")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("int").alias("columns"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_nulls"))


def quantiles(df: DataFrame, column: str, ps: Sequence[float]) -> DataFrame:
    """(metric, p, value) for each p; no rows where the column has no values."""
    found = [(column, float(p), v) for p, v in zip(ps, percentile_values(df, column, ps)) if v is not None]
    return df.sparkSession.createDataFrame(found, "metric string, p double, value double")


def quantile_crop(df: DataFrame, x: str, y: str, q: float = CROP_QUANTILE,
                  keys: Sequence[str] = ("VendorName", "Brand")) -> DataFrame:
    """Scatter points with x in [0, quantile_q(x)] (the chart's x-range)."""
    cap = exact_percentile_value(df, x, q)
    return (df.where(F.col(x).between(F.lit(0.0), cap))
              .select(*keys, x, y))


def first_row(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(1)
