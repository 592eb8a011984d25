"""OLS against a NumPy least-squares solve; single-driver fits."""

import numpy as np
import pytest

from marginflow.operators import regress


def frame(spark, n=60, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)) * np.array([1e6, 0.2, 30, 50, 80]) + np.array([1e7, 1, 100, 500, 900])
    y = 20 + x @ np.array([1e-7, 8.0, -0.01, -0.02, 0.015]) + rng.normal(0, 0.5, n)
    rows = [(f"v{i}", float(y[i]), *map(float, x[i])) for i in range(n)]
    cols = "VendorName string, ProfitMargin double, " + ", ".join(f"{c} double" for c in regress.DRIVERS)
    return spark.createDataFrame(rows, cols), x, y


def test_ols_matches_numpy(spark):
    df, x, y = frame(spark)
    model = regress.fit_ols(df)
    a = np.column_stack([np.ones(len(x)), x])
    beta, *_ = np.linalg.lstsq(a, y, rcond=None)
    assert model.intercept == pytest.approx(beta[0], rel=1e-6, abs=1e-6)
    assert np.allclose(model.coefficients, beta[1:], rtol=1e-5, atol=1e-9)
    pred = a @ beta
    r2 = 1 - ((y - pred) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert model.r2 == pytest.approx(r2, rel=1e-9)
    assert regress.r2_score(regress.margin_predictions(df)).first().r2 == pytest.approx(r2, rel=1e-9)
    table = regress.margin_drivers(df).collect()
    assert [r.coefficient for r in table] == sorted(r.coefficient for r in table)
    assert {r.direction for r in table} <= {"increases", "decreases", "negligible effect on"}


def test_collinear_drivers_get_the_solution_of_least_norm(spark):
    rng = np.random.default_rng(3)
    z = rng.normal(size=(80, 3)) * np.array([1e6, 0.3, 40.0])
    x = np.column_stack([z[:, 0], z[:, 1], 2 * z[:, 2], z[:, 2] * 0.6 + 5, 1e-3 * z[:, 0] - 4 * z[:, 1] + 7])
    y = 3 + x @ np.array([1e-6, 2.0, 0.1, 0.05, 0.0]) + rng.normal(0, 0.1, 80)
    cols = "VendorName string, ProfitMargin double, " + ", ".join(f"{c} double" for c in regress.DRIVERS)
    df = spark.createDataFrame([(f"v{i}", float(y[i]), *map(float, x[i])) for i in range(80)], cols).repartition(3)
    fit = regress.fit_ols(df)
    assert fit.rank == 3 and len(fit.basis) == 3
    centred = x - x.mean(0)
    want = np.linalg.pinv(centred, rcond=1e-11) @ (y - y.mean())
    assert np.allclose(fit.coefficients, want, rtol=1e-6, atol=1e-9)
    assert fit.intercept == pytest.approx(y.mean() - want @ x.mean(0), rel=1e-6)
    got = {r.VendorName: r.predicted for r in regress.margin_predictions(df).collect()}
    assert all(got[f"v{i}"] == pytest.approx(y.mean() + centred[i] @ want, rel=1e-7) for i in range(80))


def test_constant_and_missing_drivers(spark):
    cols = "VendorName string, ProfitMargin double, " + ", ".join(f"{c} double" for c in regress.DRIVERS)
    rows = [(f"v{i}", float(i), 0.1, float(i) if i % 2 else None, 7.0, float("nan") if i == 4 else 1.0, 0.0)
            for i in range(6)] + [("none", None, 1.0, 1.0, 1.0, 1.0, 1.0)]
    fit = regress.fit_ols(spark.createDataFrame(rows, cols))
    x = np.array([[0.1, i if i % 2 else 0, 7.0, 0.0 if i == 4 else 1.0, 0.0] for i in range(6)])
    want = np.linalg.pinv(x - x.mean(0)) @ (np.arange(6) - 2.5)
    assert np.allclose(fit.coefficients, want, atol=1e-9) and fit.rank == 2 and fit.n == 6
    empty = regress.margin_drivers(spark.createDataFrame(rows, cols).where("false")).collect()
    assert len(empty) == 5 and all(r.coefficient is None and r["rank"] == 0 for r in empty)
    flat = regress.fit_ols(spark.createDataFrame([("a", 1.0, *[2.0] * 5), ("b", 1.0, *[3.0] * 5)], cols))
    assert flat.r2 is None and flat.rank == 1 and flat.intercept == pytest.approx(1.0)


def test_pivots_take_the_most_unexplained_first():
    gram = np.array([[1.0, 0.5, 0.0], [0.5, 1.0, 0.0], [0.0, 0.0, 0.0]])
    assert regress.pivoted_cholesky(gram) in ([0, 1], [1, 0])
    assert regress.pivoted_cholesky(np.zeros((2, 2))) == []


def test_single_driver_fit(spark):
    df, x, y = frame(spark)
    rows = {r.feature: r for r in regress.single_driver_fits(df).collect()}
    slope, icpt = np.polyfit(x[:, 1], y, 1)
    assert rows["StockTurnover"].slope == pytest.approx(slope, rel=1e-9)
    assert rows["StockTurnover"].intercept == pytest.approx(icpt, rel=1e-9)
