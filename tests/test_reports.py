"""Report operators on summary edge rows (FIXTURES.md section 2)."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from marginflow.operators import reports, summary
from marginflow.sources import schemas


def summ(spark, rows):
    full = []
    for r in rows:
        d = dict(VendorNumber=1, VendorName="A", Brand=1, Description="d", Volume="1", PurchasePrice=1.0,
                 ActualPrice=2.0, TotalPurchaseQuantity=10, TotalPurchaseDollars=10.0, TotalSalesQuantity=5,
                 TotalSalesDollars=10.0, TotalSalesPrice=2.0, TotalExciseTax=0.0, FreightCost=1.0)
        d.update(r)
        full.append(tuple(d[c] for c in schemas.SUMMARY_COLUMNS))
    return spark.createDataFrame(full, schemas.SUMMARY)


def test_top_brand_ties_nulls_and_negatives(spark):
    df = summ(spark, [
        dict(VendorName="A", Brand=1, TotalSalesDollars=50.0), dict(VendorName="A", Brand=2, TotalSalesDollars=50.0),
        dict(VendorName="A", Brand=3, TotalSalesDollars=10.0),
        dict(VendorName="B", Brand=4, TotalSalesDollars=None), dict(VendorName="B", Brand=5, TotalSalesDollars=-3.0),
        dict(VendorName="C", Brand=6, TotalSalesDollars=None), dict(VendorName="C", Brand=7, TotalSalesDollars=None),
        dict(VendorName=None, Brand=8, TotalSalesDollars=7.0)])
    got = {(r.VendorName, r.Brand) for r in reports.top_brand_per_vendor(df, 100).collect()}
    # ties share rank 1; DESC puts NULLs last; an all-NULL vendor ties on NULL; NULL name is a group
    assert got == {("A", 1), ("A", 2), ("B", 5), ("C", 6), ("C", 7), (None, 8)}
    order = [r.Brand for r in reports.top_brand_per_vendor(df, 100).collect()]
    assert order[:2] == [1, 2] and order[-2:] == [6, 7]


def test_unsold_gap_drops_null_sales(spark):
    df = summ(spark, [dict(Brand=1, TotalPurchaseQuantity=10, TotalSalesQuantity=None),
                      dict(Brand=2, TotalPurchaseQuantity=10, TotalSalesQuantity=4),
                      dict(Brand=3, TotalPurchaseQuantity=0, TotalSalesQuantity=2)])
    assert [(r.Brand, r.UnsoldUnits) for r in reports.unsold_gap(df).collect()] == [(2, 6)]


def test_top_vendors_round_and_nulls_last(spark):
    df = summ(spark, [dict(VendorName="A", FreightCost=1.005), dict(VendorName="A", FreightCost=1.0),
                      dict(VendorName="B", FreightCost=None), dict(VendorName="C", FreightCost=5.0)])
    rows = reports.top_vendors_by(df, "FreightCost", 10).collect()
    assert [r.VendorName for r in rows] == ["C", "A", "B"] and rows[-1].FreightCost is None


def test_value_counts_null_profile_distinct(spark):
    df = summ(spark, [dict(VendorName="A", Brand=1), dict(VendorName="A", Brand=2), dict(VendorName="B", Brand=2),
                      dict(VendorName=None, Brand=None, FreightCost=None)])
    assert [(r.VendorName, r["count"]) for r in reports.value_counts(df, "VendorName").collect()] == [("A", 2), ("B", 1)]
    p = reports.null_profile(df).first()
    assert (p.rows, p.columns, p.total_nulls) == (4, 14, 3)
    d = reports.distinct_counts(df).first()
    assert (d.unique_vendors, d.unique_brands) == (2, 2)


def test_column_summary_median(spark):
    df = summ(spark, [dict(Brand=i, TotalSalesDollars=float(v)) for i, v in enumerate([1, 2, 4, 10])])
    r = {x.metric: x for x in reports.column_summary(df, ["TotalSalesDollars"]).collect()}["TotalSalesDollars"]
    assert (r.mean, r.median, r.min, r.max) == (4.25, 3.0, 1.0, 10.0)


prices = st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["750", "1000"]), st.sampled_from([9.0, 11.0])),
                  min_size=1, max_size=10)
buys = st.lists(st.tuples(st.integers(1, 3), st.integers(1, 5), st.integers(0, 6), st.integers(1, 9)),
                min_size=1, max_size=15)


@settings(max_examples=8, deadline=None)
@given(prices, buys)
def test_aggregate_first_equals_join_first_property(spark, price_rows, buy_rows):
    p = spark.createDataFrame([(v, f"V{v}", b, f"d{b}", float(pp), q, float(pp * q)) for v, b, pp, q in buy_rows],
                              schemas.PURCHASES)
    pp = spark.createDataFrame([(b, vol, price, price / 2) for b, vol, price in price_rows], schemas.PURCHASE_PRICES)
    ours = summary.purchase_summary(p, pp)
    ref = (p.where(F.col("PurchasePrice") > 0).alias("p").join(pp.alias("pp"), F.col("p.Brand") == F.col("pp.Brand"))
             .groupBy("p.VendorNumber", "p.VendorName", "p.Brand", "p.Description", "pp.Volume",
                      F.col("pp.Price").alias("ActualPrice"), "pp.PurchasePrice")
             .agg(F.sum("p.Quantity").alias("TotalPurchaseQuantity"), F.sum("p.Dollars").alias("TotalPurchaseDollars")))
    key = lambda r: tuple(r[c] for c in ours.columns)
    assert sorted(map(key, ours.collect())) == sorted(map(key, ref.select(*ours.columns).collect()))
