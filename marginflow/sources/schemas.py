"""Explicit schemas of every table the library reads or writes.

The raw tables' DDL is not published; types follow from how the queries use
the columns (sums are numeric, Volume needs a cast so it is text).
"""

from pyspark.sql import types as T

L, D, S = T.LongType(), T.DoubleType(), T.StringType()


def _struct(*fields, nullable=True):
    return T.StructType([T.StructField(n, t, nullable) for n, t in fields])


PURCHASES = _struct(("VendorNumber", L), ("VendorName", S), ("Brand", L), ("Description", S),
                    ("PurchasePrice", D), ("Quantity", L), ("Dollars", D))
PURCHASE_PRICES = _struct(("Brand", L), ("Volume", S), ("Price", D), ("PurchasePrice", D))
VENDOR_INVOICE = _struct(("VendorNumber", L), ("Freight", D))
SALES = _struct(("VendorNo", L), ("Brand", L), ("SalesDollars", D), ("SalesPrice", D),
                ("SalesQuantity", L), ("ExciseTax", D))

SUMMARY_COLUMNS = ["VendorNumber", "VendorName", "Brand", "Description", "Volume",
                   "PurchasePrice", "ActualPrice", "TotalPurchaseQuantity", "TotalPurchaseDollars",
                   "TotalSalesQuantity", "TotalSalesDollars", "TotalSalesPrice", "TotalExciseTax",
                   "FreightCost"]
SUMMARY = _struct(("VendorNumber", L), ("VendorName", S), ("Brand", L), ("Description", S),
                  ("Volume", S), ("PurchasePrice", D), ("ActualPrice", D),
                  ("TotalPurchaseQuantity", L), ("TotalPurchaseDollars", D),
                  ("TotalSalesQuantity", L), ("TotalSalesDollars", D), ("TotalSalesPrice", D),
                  ("TotalExciseTax", D), ("FreightCost", D))

from marginflow.constants import KPI_COLUMNS  # noqa: E402
CLEAN_SUMMARY = _struct(*[(f.name, D if f.name == "Volume" else f.dataType) for f in SUMMARY.fields],
                        *[(c, D) for c in KPI_COLUMNS])

VENDOR = _struct(("VendorName", S), ("TotalPurchaseDollars", D), ("TotalSalesDollars", D),
                 ("GrossProfit", D), ("FreightCost", D), ("StockTurnover", D), ("ProfitMargin", D),
                 ("UnsoldCapital", D), ("BrandCount", L), ("AvgPurchasePrice", D),
                 ("AvgActualPrice", D))

TIER_REFERENCE = _struct(("VendorName", S), ("PerformanceTier", S))

PRODUCTS = _struct(("Product Name", S), ("Sales", D), ("Profit", D), ("Discount", D),
                   ("Category", S), ("Sub-Category", S))
