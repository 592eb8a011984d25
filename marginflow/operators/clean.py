"""Cleaning and KPI engineering of the summary (a narrow plan: no shuffle).

* Volume text -> double (strict cast by default, NULL on bad text if lenient);
* every NULL filled with 0, string columns with "0" as the original does;
* VendorName / Description stripped of Unicode white space;
* GrossProfit, ProfitMargin, StockTurnover, UnsoldCapital; zero denominators
  give 0, never an error; negative values are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.functions.columns import safe_div, strip_ws

from marginflow.constants import STRING_FILL


def cast_volume(df: DataFrame, lenient: bool = False) -> DataFrame:
    v = F.col("Volume")
    return df.withColumn("Volume", v.try_cast("double") if lenient else v.cast("double"))


def fill_nulls(df: DataFrame) -> DataFrame:
    """fillna(0) over the whole frame; strings receive the text "0"."""
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, T.NumericType)]
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna(0, subset=numeric).fillna("0", subset=strings)


def add_kpis(df: DataFrame) -> DataFrame:
    gp = F.col("TotalSalesDollars") - F.col("TotalPurchaseDollars")
    return df.withColumns({
        "GrossProfit": gp,
        "ProfitMargin": F.coalesce(safe_div(gp, "TotalSalesDollars") * 100, F.lit(0.0)),
        "StockTurnover": F.coalesce(
            safe_div(F.col("TotalSalesQuantity").cast("double"), "TotalPurchaseQuantity"),
            F.lit(0.0)),
        "UnsoldCapital": (F.col("TotalPurchaseQuantity") - F.col("TotalSalesQuantity"))
                         * F.col("PurchasePrice"),
    })


def clean_summary(summary: DataFrame, lenient: bool = False) -> DataFrame:
    df = fill_nulls(cast_volume(summary, lenient))
    df = df.withColumns({c: strip_ws(c) for c in STRING_FILL})
    return add_kpis(df)


def reliable_predicate():
    return ((F.col("GrossProfit") > 0) & (F.col("ProfitMargin") > 0)
            & (F.col("TotalSalesQuantity") > 0))


def filter_reliable(clean: DataFrame) -> DataFrame:
    """Drop rows with non-positive profit or margin, or no units sold."""
    return clean.where(reliable_predicate())


def total_nulls(df: DataFrame):
    """Sum of NULL cells over every column, as one Column expression."""
    return sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))


def clean_metrics(summary: DataFrame, lenient: bool = False) -> DataFrame:
    """Pipeline log as data: rows loaded, NULLs filled, rows kept; one pass."""
    cast = cast_volume(summary, lenient)
    cleaned = clean_summary(cast.withColumn("_n", total_nulls(cast)), lenient)
    return cleaned.select("_n", reliable_predicate().alias("_ok")).agg(
        F.count(F.lit(1)).alias("rows_loaded"),
        F.sum("_n").alias("nulls_filled"),
        F.count_if(F.col("_ok")).alias("rows_reliable"))


def observed_clean(summary: DataFrame, lenient: bool = False):
    """The reliable frame plus an Observation filled when it is first written.

    Metrics ride along with the write's own pass (no extra job).
    """
    obs = Observation("clean_metrics")
    cast = cast_volume(summary, lenient)
    cleaned = (cast.withColumn("_n", total_nulls(cast)).transform(lambda d: clean_summary(d, lenient))
               .observe(obs, F.count(F.lit(1)).alias("rows_loaded"),
                        F.sum("_n").alias("nulls_filled"),
                        F.count_if(reliable_predicate()).alias("rows_reliable"))
               .drop("_n"))
    return filter_reliable(cleaned), obs
