"""Vendor-grain rollup of the reliable brand rows.

Grouped by VendorName (not the number) as the original does; margin and
turnover are unweighted means of brand rows. NULL names are dropped like
pandas does. Price means are exact decimal means (order-independent).

Sums and means are combined map-side and shuffle one row per vendor and task.
Brands are counted apart, over distinct (vendor, brand) rows of two columns, so
the measures never travel at the brand grain; the two vendor-size results are
joined. A vendor holding a third of all rows is combined map-side in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions.columns import exact_mean


def vendor_level_aggregate(df: DataFrame) -> DataFrame:
    def total(c):
        return F.coalesce(F.sum(c), F.lit(0.0)).alias(c)

    named = df.where(F.col("VendorName").isNotNull())
    sums = (named.groupBy("VendorName")
                 .agg(total("TotalPurchaseDollars"), total("TotalSalesDollars"),
                      total("GrossProfit"), total("FreightCost"),
                      F.avg("StockTurnover").alias("StockTurnover"),
                      F.avg("ProfitMargin").alias("ProfitMargin"),
                      total("UnsoldCapital"),
                      exact_mean("PurchasePrice").alias("AvgPurchasePrice"),
                      exact_mean("ActualPrice").alias("AvgActualPrice")))
    brands = (named.select("VendorName", "Brand").distinct()
                   .groupBy("VendorName").agg(F.count("Brand").alias("BrandCount")))
    return sums.join(brands, "VendorName").select(
        "VendorName", "TotalPurchaseDollars", "TotalSalesDollars", "GrossProfit", "FreightCost", "StockTurnover",
        "ProfitMargin", "UnsoldCapital", "BrandCount", "AvgPurchasePrice", "AvgActualPrice")
