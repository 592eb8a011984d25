"""Histogram, density and box statistics against NumPy."""

import math

import numpy as np
import pytest

from marginflow.operators import explore


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(20, 5, 300), [80.0, -30.0]])
    return spark.createDataFrame([(float(v),) for v in x], "x double"), x


def test_histogram_matches_numpy(spark, data):
    df, x = data
    got = explore.histogram(df, "x", 40).orderBy("bin").collect()
    counts, edges = np.histogram(x, bins=40)
    assert [r["count"] for r in got] == list(counts)
    assert got[0].bin_start == pytest.approx(edges[0]) and got[-1].bin_end == pytest.approx(edges[-1])


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    counts, _ = np.histogram([5.0, 5.0], bins=40)
    assert [r["count"] for r in explore.histogram(df, "x").orderBy("bin").collect()] == list(counts)


def test_kde_scott(spark, data):
    df, x = data
    got = explore.kde(df, "x", gridsize=200).orderBy("point").collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert np.allclose([r.density for r in got], dens, rtol=1e-9)
    assert np.allclose([r.x for r in got], grid)


def test_box_stats(spark, data):
    df, x = data
    r = explore.box_stats(df, "x").first()
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    iqr = q3 - q1
    inside = x[(x >= q1 - 1.5 * iqr) & (x <= q3 + 1.5 * iqr)]
    assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
    assert r.whisker_low == inside.min() and r.whisker_high == inside.max()
    assert r.outliers == int(((x < inside.min()) | (x > inside.max())).sum())
