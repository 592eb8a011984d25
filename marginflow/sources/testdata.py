"""Adapter: the four raw tables (and the product table) derived from the
TPC-H-ish test data as lazy views.

Padding, zero purchase prices and partial sell-through are deliberate: they
exercise whitespace stripping, the valid-purchase filter and the left-join gap.
Everything is a projection/join of the parquet scans, so Catalyst prunes
columns and pushes filters into the readers. Purchases and sales meet the part table by a
merge join, last: line items are shuffled by part as narrow rows, and what is then
grouped or joined by Brand stays where it is. A part table that is small enough to be broadcast
would leave nearly all rows to map-side aggregates, whose groups are about as many as the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ("lineitem", "part", "supplier", "embeddings")


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = base(spark, sf_dir, "lineitem")
    part = base(spark, sf_dir, "part")
    sup = base(spark, sf_dir, "supplier")
    price = F.when(F.col("l_linenumber") == 7, F.lit(0.0)).otherwise(F.col("p_retailprice") * 0.6)
    qty = F.col("l_quantity").cast("bigint")
    return (li.join(sup, li.l_suppkey == sup.s_suppkey)
              .join(part.hint("merge"), li.l_partkey == part.p_partkey)
              .select(F.col("l_suppkey").alias("VendorNumber"),
                      F.concat(F.col("s_name"), F.lit("   ")).alias("VendorName"),
                      F.col("l_partkey").alias("Brand"),
                      F.concat(F.lit(" "), F.col("p_name")).alias("Description"),
                      price.alias("PurchasePrice"),
                      qty.alias("Quantity"),
                      (qty * price).alias("Dollars")))


def purchase_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = base(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("Brand"),
                       F.col("p_size").cast("string").alias("Volume"),
                       F.col("p_retailprice").alias("Price"),
                       (F.col("p_retailprice") * 0.6).alias("PurchasePrice"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = base(spark, sf_dir, "lineitem").where(F.col("l_returnflag") != "R")
    part = base(spark, sf_dir, "part")
    qty = F.floor(F.col("l_quantity") * (F.lit(0.7) + F.lit(4) * F.col("l_discount"))).cast("bigint")
    price = F.col("p_retailprice") * (F.lit(1) - F.col("l_discount"))
    return (li.join(part.hint("merge"), li.l_partkey == part.p_partkey)
              .select(F.col("l_suppkey").alias("VendorNo"),
                      F.col("l_partkey").alias("Brand"),
                      (qty * price).alias("SalesDollars"),
                      price.alias("SalesPrice"),
                      qty.alias("SalesQuantity"),
                      (F.col("l_quantity") * F.col("l_tax")).alias("ExciseTax")))


def vendor_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = base(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_suppkey").alias("VendorNumber"), "l_orderkey")
              .agg((F.sum("l_extendedprice") * 0.03).alias("Freight"))
              .select("VendorNumber", "Freight"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-commerce transactions: one row per line item."""
    li = base(spark, sf_dir, "lineitem")
    part = base(spark, sf_dir, "part")
    return (li.join(part, li.l_partkey == part.p_partkey)
              .select(F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")).alias("Product Name"),
                      F.col("l_extendedprice").alias("Sales"),
                      (F.col("l_extendedprice") * (F.lit(0.4) - F.lit(6) * F.col("l_discount"))).alias("Profit"),
                      F.col("l_discount").alias("Discount"),
                      F.col("p_type").alias("Category"),
                      F.col("p_brand").alias("Sub-Category"),
                      # unique row order, as one number: used only to define "first"
                      F.expr("(CAST(l_orderkey AS DECIMAL(38, 0)) * 10 + l_linenumber) * CAST(1e21 AS DECIMAL(38, 0))"
                             " + CAST(l_partkey AS DECIMAL(38, 0)) * 10000000000 + l_suppkey").cast("decimal(38,0)")
                      .alias("_row_order")))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base(spark, sf_dir, "embeddings")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"purchases": purchases(spark, sf_dir),
            "purchase_prices": purchase_prices(spark, sf_dir),
            "vendor_invoice": vendor_invoice(spark, sf_dir),
            "sales": sales(spark, sf_dir)}
