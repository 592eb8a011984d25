"""The vendor-brand summary: freight, purchase and sales summaries, and the
aggregate-before-join build that combines them.

Shape of the flagship plan (``vendor_sales_summary``):

* purchases are filtered (``PurchasePrice > 0``, pushed into the scan) and
  summed per (vendor, name, brand, description) with map-side partial
  aggregation, so hot keys are combined before the shuffle;
* the price list is reduced to distinct rows with their multiplicity ``m`` and
  joined on Brand *after* the purchase sums (rewrite R5), which multiplies the
  sums by ``m``: identical to joining first for any price table, including
  duplicated price rows, but it joins one row per pair instead of one per line;
* sales are summed per (vendor, brand);
* freight is summed per vendor and left-joined onto every brand row.

No side is force-broadcast: the freight and price sides grow with the number
of vendors and brands, so Spark's size-checked broadcast (static statistics
and AQE's runtime statistics) decides, and falls back to a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.sources.schemas import SUMMARY_COLUMNS


def freight_summary(vendor_invoice: DataFrame) -> DataFrame:
    """Total freight per vendor (the true vendor total; compare L4)."""
    return (vendor_invoice.groupBy("VendorNumber")
            .agg(F.sum("Freight").alias("FreightCost")))


def valid_purchases(purchases: DataFrame) -> DataFrame:
    """Rows with a positive purchase price; NULL, NaN and zero prices drop."""
    return purchases.where((F.col("PurchasePrice") > 0) & ~F.isnan("PurchasePrice"))


def sales_summary(sales: DataFrame) -> DataFrame:
    return (sales.groupBy("VendorNo", "Brand")
            .agg(F.sum("SalesDollars").alias("TotalSalesDollars"),
                 F.sum("SalesPrice").alias("TotalSalesPrice"),
                 F.sum("SalesQuantity").alias("TotalSalesQuantity"),
                 F.sum("ExciseTax").alias("TotalExciseTax")))


def sales_summary_report(sales: DataFrame) -> DataFrame:
    """The standalone sales summary, ordered by sales dollars as published."""
    return sales_summary(sales).orderBy("TotalSalesDollars", "VendorNo", "Brand")


def price_multiplicity(purchase_prices: DataFrame) -> DataFrame:
    """Distinct price rows per brand with how often each occurs."""
    return (purchase_prices.groupBy("Brand", "Volume", "Price", "PurchasePrice")
            .agg(F.count(F.lit(1)).alias("_m")))


def _times(m: Column, c: str) -> Column:
    return (F.col(c) * m).alias(c)


def purchase_sums(purchases: DataFrame) -> DataFrame:
    """Quantity and dollars of valid purchases per (vendor, name, brand, description)."""
    return (valid_purchases(purchases)
            .groupBy("VendorNumber", "VendorName", "Brand", "Description")
            .agg(F.sum("Quantity").alias("TotalPurchaseQuantity"),
                 F.sum("Dollars").alias("TotalPurchaseDollars")))


def purchase_summary(purchases: DataFrame, purchase_prices: DataFrame) -> DataFrame:
    """Purchase sums per (vendor, name, brand, description, volume, prices).

    Same rows and totals as ``purchases JOIN purchase_prices USING (Brand)``
    grouped by those seven columns, computed by aggregating purchases first.
    """
    return priced(purchase_sums(purchases), price_multiplicity(purchase_prices))


def priced(sums: DataFrame, prices: DataFrame) -> DataFrame:
    """Purchase sums with each price row of their brand, times its multiplicity;
    further columns of the sums stay."""
    m = F.col("_m")
    own = ["VendorNumber", "VendorName", "Brand", "Description", "TotalPurchaseQuantity", "TotalPurchaseDollars"]
    return (sums.join(prices, "Brand")
             .select("VendorNumber", "VendorName", "Brand", "Description", "Volume",
                     F.col("Price").alias("ActualPrice"), "PurchasePrice",
                     _times(m, "TotalPurchaseQuantity"), _times(m, "TotalPurchaseDollars"),
                     *[c for c in sums.columns if c not in own]))


def purchase_summary_standalone(purchases: DataFrame, purchase_prices: DataFrame) -> DataFrame:
    """Three-key purchase summary with the ungrouped price columns.

    The original takes an arbitrary row's Volume and Price per group; we take
    ``min`` so the result is deterministic. Ordered by purchase dollars.
    """
    p = (valid_purchases(purchases)
         .groupBy("VendorNumber", "VendorName", "Brand")
         .agg(F.sum("Quantity").alias("q"), F.sum("Dollars").alias("d")))
    pp = (purchase_prices.groupBy("Brand")
          .agg(F.count(F.lit(1)).alias("_m"), F.min("Volume").alias("Volume"),
               F.min("Price").alias("ActualPrice")))
    return (p.join(pp, "Brand")
             .select("VendorNumber", "VendorName", "Brand", "Volume", "ActualPrice",
                     (F.col("q") * F.col("_m")).alias("TotalPurchaseQuantity"),
                     (F.col("d") * F.col("_m")).alias("TotalPurchaseDollars"))
             .orderBy("TotalPurchaseDollars", "VendorNumber", "VendorName", "Brand"))


def vendor_sales_summary(purchases: DataFrame, purchase_prices: DataFrame,
                         vendor_invoice: DataFrame, sales: DataFrame) -> DataFrame:
    """One row per purchased (vendor, brand, ...) with sales and freight attached."""
    return combine(purchase_sums(purchases), price_multiplicity(purchase_prices),
                   freight_summary(vendor_invoice), sales_summary(sales))


def with_sales(sums: DataFrame, sold: DataFrame) -> DataFrame:
    """Purchase sums with the sales sums of their (vendor, brand), NULL where there are none.

    A left join, written as a window over the rows of both sides: rows that are
    clustered by Brand alone stay where they are, which a join on both keys would shuffle
    again. ``sold`` has a row for each pair; its NULL keys match nothing."""
    measures = [c for c in sold.columns if c not in ("VendorNo", "Brand")]
    bought = sums.withColumn("_bought", F.lit(True))
    seen = sold.where(F.col("VendorNo").isNotNull() & F.col("Brand").isNotNull()).withColumnRenamed("VendorNo", "VendorNumber")
    pair = Window.partitionBy("VendorNumber", "Brand")
    rows = bought.unionByName(seen, allowMissingColumns=True)
    rows = rows.withColumns({c: F.max(c).over(pair) for c in measures})     # of the pair's one row
    return rows.where("_bought").drop("_bought")


def combine(sums: DataFrame, prices: DataFrame, freight: DataFrame, sold: DataFrame) -> DataFrame:
    """The summary from the four aggregates that it is made of."""
    ps = priced(with_sales(sums, sold), prices)
    fs = freight.withColumnRenamed("VendorNumber", "_fv")
    return ps.join(fs, F.col("VendorNumber") == F.col("_fv"), "left").select(*SUMMARY_COLUMNS)


def never_sold(purchases: DataFrame, sales: DataFrame) -> DataFrame:
    """Valid purchased (vendor, brand) pairs with no sales row at all.

    Both sides are reduced to distinct pairs first (partial aggregation), so a
    pair holding a third of all sales rows reaches the anti join as one row.
    """
    p = valid_purchases(purchases).select("VendorNumber", "Brand").distinct()
    s = sales.select(F.col("VendorNo").alias("VendorNumber"), "Brand").distinct()
    return p.join(s, ["VendorNumber", "Brand"], "left_anti")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """COUNT(*) per raw table, as (table_name, row_count) rows."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """``SELECT * .. LIMIT n`` made deterministic: ordered by every column."""
    return df.orderBy(*df.columns).limit(n)
