"""Summary build on hand-built edge rows (FIXTURES.md section 1)."""

import pytest
from pyspark.sql import functions as F

from marginflow.operators import summary
from marginflow.sources import schemas

NBSP = " "


@pytest.fixture(scope="module")
def raw(spark):
    purchases = spark.createDataFrame([
        (1, "Acme  ", 10, " Gin", 5.0, 2, 10.0),
        (1, "Acme  ", 10, " Gin", 5.0, 3, 15.0),
        (1, "Acme  ", 11, "Rum\t", 0.0, 4, 0.0),          # zero price: dropped
        (1, "Acme  ", 12, "Vodka", None, 4, 0.0),         # null price: dropped
        (2, "\tBeta" + NBSP, 20, "Wine", 7.0, 1, 7.0),    # vendor without invoice
        (2, "\tBeta" + NBSP, 21, "Port", 3.0, 5, 15.0),   # bought, never sold
        (3, None, 30, None, 2.0, 1, 2.0),                  # null name
    ], schemas.PURCHASES)
    prices = spark.createDataFrame([
        (10, "750", 9.0, 5.0), (10, "750", 9.0, 5.0),     # identical duplicate
        (20, "1000", 11.0, 7.0), (20, "1500", 12.0, 7.0),  # differing duplicate
        (21, "Unknown", 4.0, 3.0), (30, "375", 3.0, 2.0), (11, "750", 1.0, 0.0),
    ], schemas.PURCHASE_PRICES)
    invoice = spark.createDataFrame([(1, 4.0), (1, 6.0), (3, 1.5)], schemas.VENDOR_INVOICE)
    sales = spark.createDataFrame([
        (1, 10, 40.0, 8.0, 5, 0.5), (1, 10, 16.0, 8.0, 2, 0.2),
        (2, 20, 30.0, 10.0, 3, 0.1), (3, 30, 5.0, 5.0, 1, 0.0), (9, 99, 1.0, 1.0, 1, 0.0),
    ], schemas.SALES)
    for name, df in [("purchases", purchases), ("purchase_prices", prices),
                     ("vendor_invoice", invoice), ("sales", sales)]:
        df.createOrReplaceTempView(name)
    return purchases, prices, invoice, sales


def joined_first(purchases, prices, invoice, sales):
    """The summary by loops over the raw rows: every purchase row meets every price row
    of its brand before anything is summed."""
    sold, bought, freight = {}, {}, {}
    for r in sales.collect():
        s = sold.setdefault((r.VendorNo, r.Brand), [0, 0.0, 0.0, 0.0])
        for i, v in enumerate((r.SalesQuantity, r.SalesDollars, r.SalesPrice, r.ExciseTax)):
            s[i] += v
    for r in invoice.collect():
        freight[r.VendorNumber] = freight.get(r.VendorNumber, 0.0) + r.Freight
    listed = prices.collect()
    for r in purchases.collect():
        for p in listed:
            if p.Brand == r.Brand and r.PurchasePrice is not None and r.PurchasePrice > 0:
                key = (r.VendorNumber, r.VendorName, r.Brand, r.Description, p.Volume, p.PurchasePrice, p.Price)
                b = bought.setdefault(key, [0, 0.0])
                b[0] += r.Quantity
                b[1] += r.Dollars
    nothing = (None,) * 4
    return sorted((*k, *b, *sold.get((k[0], k[2]), nothing), freight.get(k[0])) for k, b in bought.items())


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_aggregate_first_equals_join_first(spark, raw):
    ours = summary.vendor_sales_summary(*raw)
    assert ours.columns == schemas.SUMMARY_COLUMNS
    assert _rows(ours) == joined_first(*raw)


def test_duplicate_prices_fan_out(spark, raw):
    rows = {(r.Brand, r.Volume): r for r in summary.vendor_sales_summary(*raw).collect()}
    # identical duplicate price rows double the sums (one group), as joining first does
    assert rows[(10, "750")].TotalPurchaseQuantity == 10
    # differing rows give two groups, each with the purchase sums once
    assert rows[(20, "1000")].TotalPurchaseQuantity == 1 and rows[(20, "1500")].TotalPurchaseQuantity == 1


def test_filters_and_left_joins(spark, raw):
    rows = summary.vendor_sales_summary(*raw).collect()
    brands = {r.Brand for r in rows}
    assert 11 not in brands and 12 not in brands          # zero / NULL price
    never = [r for r in rows if r.Brand == 21][0]
    assert never.TotalSalesDollars is None                 # bought, never sold
    assert all(r.FreightCost is None for r in rows if r.VendorNumber == 2)
    assert [r.FreightCost for r in rows if r.VendorNumber == 1][0] == 10.0


def test_standalone_takes_min_of_ungrouped_columns(spark, raw):
    rows = {r.Brand: r for r in summary.purchase_summary_standalone(raw[0], raw[1]).collect()}
    assert rows[20].Volume == "1000" and rows[20].ActualPrice == 11.0
    assert rows[20].TotalPurchaseQuantity == 2              # two price rows
    assert rows[10].TotalPurchaseQuantity == 10


def test_never_sold_and_counts(spark, raw):
    assert {(r.VendorNumber, r.Brand) for r in summary.never_sold(raw[0], raw[3]).collect()} == {(2, 21)}
    counts = {r.table_name: r.row_count for r in summary.row_counts(
        {"purchases": raw[0], "sales": raw[3]}).collect()}
    assert counts == {"purchases": 7, "sales": 5}


def test_freight_summary_true_vendor_total(spark, raw):
    assert {r.VendorNumber: r.FreightCost for r in summary.freight_summary(raw[2]).collect()} == {1: 10.0, 3: 1.5}


def explain(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_flagship_plan_prunes_columns_and_combines_map_side(spark):
    from marginflow.plans.stages import Workspace
    plan = explain(Workspace(spark, "/root/testdata/sf0.001").summary_plan())
    # only the needed lineitem columns are read
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double>" in plan
    # aggregates are split into partial (map-side) and final halves around the shuffle
    assert "partial_sum" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_valid_purchase_filter_reaches_the_scan(spark, tmpdir_path, raw):
    path = tmpdir_path + "/purchases"
    raw[0].write.parquet(path)
    p = spark.read.parquet(path)
    plan = explain(summary.purchase_summary(p, raw[1]))
    assert "PushedFilters: [IsNotNull(PurchasePrice), GreaterThan(PurchasePrice,0.0)" in plan


def test_sums_clustered_by_brand_are_combined_where_they_are(spark, raw):
    """Prices and sales meet purchase sums that are dealt by Brand without moving them again."""
    from test_plans import plan_of
    purchases, prices, invoice, sales = raw
    bought, sold = summary.purchase_sums(purchases.repartition("Brand")), summary.sales_summary(sales.repartition("Brand"))
    joined = summary.with_sales(bought, sold)
    plan = plan_of(joined)
    assert plan.count("Arguments: hashpartitioning") == 2 and "hashpartitioning(VendorNumber" not in plan
    left = bought.join(sold.withColumnRenamed("VendorNo", "VendorNumber"), ["VendorNumber", "Brand"], "left").select(joined.columns)
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, left.collect()))


def test_null_keys_meet_no_sales(spark):
    sums = spark.createDataFrame([(None, "a", 1, "x", 2, 3.0), (1, "a", None, "x", 2, 3.0), (1, "b", 1, None, 2, 3.0), (1, "c", 1, None, 2, 3.0)],
                                 "VendorNumber long, VendorName string, Brand long, Description string, TotalPurchaseQuantity long, TotalPurchaseDollars double")
    sold = spark.createDataFrame([(None, 1, 9.0, 9.0, 9, 9.0), (1, None, 9.0, 9.0, 9, 9.0), (1, 1, 4.0, None, 5, float("nan"))],
                                 "VendorNo long, Brand long, TotalSalesDollars double, TotalSalesPrice double, TotalSalesQuantity long, TotalExciseTax double")
    got = sorted((str(r.VendorNumber), r.VendorName, r.TotalSalesDollars, r.TotalSalesPrice, r.TotalSalesQuantity, str(r.TotalExciseTax))
                 for r in summary.with_sales(sums, sold).collect())
    assert got == [("1", "a", None, None, None, "None"), ("1", "b", 4.0, None, 5, "nan"), ("1", "c", 4.0, None, 5, "nan"),
                   ("None", "a", None, None, None, "None")]
