"""Degenerate inputs: empty frames, constant columns, single rows."""

import numpy as np
import pytest

from marginflow.functions.quantiles import exact_percentiles, percentile_values
from marginflow.operators import explore, stats


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_percentiles_empty_and_constant(spark):
    assert percentile_values(frame(spark, []), "x", [0.5]) == [None]
    assert exact_percentiles(frame(spark, [None, None]), "x", [0.5]).count() == 0
    assert percentile_values(frame(spark, [3.0] * 7), "x", [0.0, 0.5, 1.0]) == [3.0, 3.0, 3.0]
    assert percentile_values(frame(spark, [2.0]), "x", [0.25, 0.75]) == [2.0, 2.0]


def test_histogram_empty(spark):
    rows = explore.histogram(frame(spark, []), "x").collect()
    assert len(rows) == 40 and all(r["count"] == 0 for r in rows)


def test_kde_constant_is_null(spark):
    rows = explore.kde(frame(spark, [1.0, 1.0, 1.0]), "x").collect()
    assert len(rows) == 200 and all(r.density is None for r in rows)


def test_box_single_value_and_empty(spark):
    r = explore.box_stats(frame(spark, [5.0]), "x").first()
    assert (r.n, r.q1, r.q3, r.whisker_low, r.whisker_high, r.outliers) == (1, 5.0, 5.0, 5.0, 5.0, 0)
    e = explore.box_stats(frame(spark, []), "x").first()
    assert e.n == 0 and e.q1 is None


def test_welch_single_vendor(spark):
    df = spark.createDataFrame([("a", 10.0, 20.0)], "VendorName string, TotalSalesDollars double, ProfitMargin double")
    r = stats.welch_ttest(df).first()
    assert (r.top_n, r.bottom_n) == (1, 0) and r.p_value is None


def test_histogram_matches_numpy_on_ties_at_edges(spark):
    x = np.array([0.0, 0.025, 0.05, 1.0, 1.0, 0.5])
    counts, _ = np.histogram(x, bins=40)
    got = [r["count"] for r in explore.histogram(frame(spark, list(map(float, x))), "x").orderBy("bin").collect()]
    assert got == list(counts)
