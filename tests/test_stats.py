"""Welch's t-test, the Student-t tail and correlations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.functions.tdist import two_sided_p
from marginflow.operators import stats


@pytest.mark.parametrize("t,nu,p", [(1.70886, 108.387, 0.090338), (12.7062, 1.0, 0.05),
                                    (2.0, 3.5, 0.12614), (1.959964, 1e7, 0.05), (0.0, 10.0, 1.0)])
def test_t_tail(spark, t, nu, p):
    got = spark.range(1).select(two_sided_p(F.lit(t), F.lit(nu))).first()[0]
    assert got == pytest.approx(p, abs=2e-5)


def vendor_frame(spark, sales, margin):
    return spark.createDataFrame([(f"v{i}", float(s), float(m)) for i, (s, m) in enumerate(zip(sales, margin))],
                                 "VendorName string, TotalSalesDollars double, ProfitMargin double")


def test_welch_matches_formula(spark):
    rng = np.random.default_rng(3)
    sales = rng.lognormal(10, 1, 41)
    margin = rng.normal(20, 5, 41)
    r = stats.welch_ttest(vendor_frame(spark, sales, margin)).first()
    med = np.median(sales)
    top, bot = margin[sales >= med], margin[sales < med]
    assert (r.top_n, r.bottom_n) == (21, 20)                  # the median vendor is on top
    v1, v2 = top.var(ddof=1) / len(top), bot.var(ddof=1) / len(bot)
    t = (top.mean() - bot.mean()) / math.sqrt(v1 + v2)
    df = (v1 + v2) ** 2 / (v1 ** 2 / (len(top) - 1) + v2 ** 2 / (len(bot) - 1))
    assert r.t_statistic == pytest.approx(t) and r.df == pytest.approx(df)
    assert 0 <= r.p_value <= 1 and r.significant_at_0_05 == (r.p_value < 0.05)


def test_welch_degenerate_is_null(spark):
    r = stats.welch_ttest(vendor_frame(spark, [1, 2, 3], [5, 5, 5])).first()
    assert r.t_statistic is None and r.p_value is None


def test_correlation_matches_numpy_and_constant_is_null(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(30, 3))
    x[:, 1] += x[:, 0]
    df = spark.createDataFrame([tuple(map(float, r)) + (1.0,) for r in x], "a double, b double, c double, k double")
    got = {(r.metric_x, r.metric_y): r.corr for r in stats.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    exp = np.corrcoef(x.T)
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            assert got[(a, b)] == pytest.approx(round(exp[i, j], 3), abs=1e-3)
    assert got[("a", "k")] is None and got[("k", "k")] is None


def test_correlation_uses_each_pairs_complete_rows(spark):
    nan = float("nan")
    rows = [(1.0, 2.0, 1.0), (2.0, 1.0, None), (3.0, 5.0, 2.0), (100.0, None, 7.0), (None, -50.0, nan), (4.0, 4.0, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.metric_x, r.metric_y): r.corr for r in stats.correlation_matrix(df, ["a", "b", "c"], None).collect()}
    exp = df.toPandas().corr()                               # pandas: pairwise complete rows
    for a in "abc":
        for b in "abc":
            assert got[(a, b)] == pytest.approx(exp.loc[a, b])
    assert got[("a", "b")] == pytest.approx(0.707, abs=1e-3)


def test_correlation_of_many_columns_is_the_same_answer(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(20, 34))
    cols = [f"c{i}" for i in range(34)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols))
    wide = {(r.metric_x, r.metric_y): r.corr for r in stats.correlation_matrix(df, cols).collect()}
    few = {(r.metric_x, r.metric_y): r.corr for r in stats.correlation_matrix(df, cols[:3]).collect()}
    assert all(wide[k] == r for k, r in few.items()) and len(wide) == 34 * 34
