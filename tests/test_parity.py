"""Parity with the published analysis numbers, recomputed from the shipped vendor
frame. Point PARITY_VENDOR_CSV at that CSV to run; skipped when unset."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marginflow.operators import segment, stats
from marginflow.operators.kmeans import kmeans

CSV = os.environ.get("PARITY_VENDOR_CSV", "")
pytestmark = pytest.mark.skipif(not (CSV and os.path.exists(CSV)), reason="PARITY_VENDOR_CSV not set")


@pytest.fixture(scope="module")
def vendor(spark):
    d = T.DoubleType()
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("VendorName", T.StringType()), ("TotalPurchaseDollars", d), ("TotalSalesDollars", d),
        ("GrossProfit", d), ("FreightCost", d), ("StockTurnover", d), ("ProfitMargin", d),
        ("UnsoldCapital", d), ("BrandCount", T.LongType()), ("AvgPurchasePrice", d),
        ("AvgActualPrice", d), ("Cluster", T.IntegerType()), ("PerformanceTier", T.StringType())]])
    return spark.read.schema(schema).option("header", True).csv(CSV)


def test_welch(vendor):
    r = stats.welch_ttest(vendor).first()
    assert (r.top_n, r.bottom_n) == (60, 59)
    assert round(r.top_mean_margin, 2) == 21.11 and round(r.bottom_mean_margin, 2) == 20.6
    assert round(r.t_statistic, 3) == 1.709 and round(r.p_value, 5) == 0.09034


def test_correlation(vendor):
    got = {(r.metric_x, r.metric_y): r.corr for r in stats.correlation_matrix(vendor).collect()}
    assert got[("ProfitMargin", "StockTurnover")] == 0.734


def test_silhouette_of_published_labels(vendor):
    scaled = segment.standardize(segment.cluster_features(vendor)).join(
        vendor.select("VendorName", "Cluster"), "VendorName")
    assert round(segment.silhouette(scaled).first().silhouette, 3) == 0.448


def test_tier_counts(vendor):
    counts = {r.PerformanceTier: r["count"] for r in vendor.groupBy("PerformanceTier").count().collect()}
    assert counts == {"Mid Performer": 72, "Low Performer": 39, "High Performer": 8}


def test_kmeans_tiers_reproduce_published_tiers(vendor):
    from marginflow.operators import segment
    base = vendor.drop("Cluster", "PerformanceTier")
    tiers = segment.kmeans_tiers(base, k=3, n_init=10, seed=42)
    counts = {r.PerformanceTier: r["count"] for r in tiers.groupBy("PerformanceTier").count().collect()}
    assert counts == {"Mid Performer": 72, "Low Performer": 39, "High Performer": 8}
    agree = (tiers.join(vendor.select("VendorName", F.col("PerformanceTier").alias("published")), "VendorName")
                  .where(F.col("PerformanceTier") == F.col("published")).count())
    assert agree >= 115
    scaled = segment.standardize(segment.cluster_features(base))
    found = kmeans(scaled, F.array(*segment.FEATURES), 3, 10, 42, key="VendorName")
    assert found.inertia <= 1.01 * 149.256
