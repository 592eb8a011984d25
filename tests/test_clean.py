"""Cleaning and KPI engineering edge cases."""

import pytest
from pyspark.sql import functions as F

from marginflow.operators import clean
from marginflow.sources import schemas

NBSP = " "


def summary_rows(spark, rows):
    return spark.createDataFrame(rows, schemas.SUMMARY)


def base(**kw):
    row = dict(VendorNumber=1, VendorName="  Acme\t" + NBSP, Brand=10, Description=" Gin ",
               Volume="750", PurchasePrice=5.0, ActualPrice=9.0, TotalPurchaseQuantity=10,
               TotalPurchaseDollars=50.0, TotalSalesQuantity=8, TotalSalesDollars=72.0,
               TotalSalesPrice=18.0, TotalExciseTax=1.0, FreightCost=3.0)
    row.update(kw)
    return tuple(row[c] for c in schemas.SUMMARY_COLUMNS)


def test_strip_fill_and_kpis(spark):
    df = summary_rows(spark, [base(), base(Brand=11, VendorName=None, TotalSalesQuantity=None,
                                          TotalSalesDollars=None, FreightCost=None),
                              base(Brand=12, TotalPurchaseQuantity=0, TotalSalesDollars=0.0)])
    rows = {r.Brand: r for r in clean.clean_summary(df).collect()}
    assert rows[10].VendorName == "Acme" and rows[10].Description == "Gin"
    assert rows[10].GrossProfit == 22.0
    assert rows[10].ProfitMargin == pytest.approx(22.0 / 72.0 * 100)
    assert rows[10].StockTurnover == 0.8 and rows[10].UnsoldCapital == 10.0
    assert rows[11].VendorName == "0"                      # null name becomes the text "0"
    assert rows[11].TotalSalesQuantity == 0 and rows[11].FreightCost == 0.0
    assert rows[11].ProfitMargin == 0.0 and rows[11].StockTurnover == 0.0
    assert rows[12].StockTurnover == 0.0                   # zero purchase quantity
    assert rows[12].ProfitMargin == 0.0                    # zero sales dollars
    assert rows[12].GrossProfit == -50.0                   # negatives kept
    assert rows[10].Volume == 750.0


def test_volume_cast_strict_and_lenient(spark):
    df = summary_rows(spark, [base(Volume="Unknown")])
    with pytest.raises(Exception):
        clean.clean_summary(df).collect()
    assert clean.clean_summary(df, lenient=True).first().Volume == 0.0


def test_reliable_filter_and_idempotence(spark):
    df = summary_rows(spark, [base(), base(Brand=11, TotalSalesDollars=40.0),
                              base(Brand=12, TotalSalesQuantity=0)])
    once = clean.filter_reliable(clean.clean_summary(df))
    assert [r.Brand for r in once.collect()] == [10]
    again = clean.filter_reliable(clean.clean_summary(once.select(
        *[F.col(c).cast("string").alias(c) if c == "Volume" else F.col(c)
          for c in schemas.SUMMARY_COLUMNS])))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_clean_metrics_one_pass(spark):
    df = summary_rows(spark, [base(), base(Brand=11, VendorName=None, FreightCost=None)])
    m = clean.clean_metrics(df).first()
    assert (m.rows_loaded, m.nulls_filled, m.rows_reliable) == (2, 2, 2)
    reliable, obs = clean.observed_clean(df)
    assert reliable.count() == 2
    assert obs.get["nulls_filled"] == 2


def test_strip_matches_python_str_strip(spark):
    from marginflow.functions.columns import strip_ws
    samples = [" a\t ", " b ", "\x1fc\x1c", "　d e ", "  ", "x"]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in samples], "s string")
           .select(strip_ws("s")).collect()]
    assert got == [s.strip() for s in samples]
