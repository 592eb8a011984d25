"""Drivers of vendor profit margin: multiple OLS and single-driver fits.

One distributed pass gives the means and the d x d covariance (Gram) matrix of the
drivers, and their covariances with the target. A Cholesky factorisation with
pivoting of that matrix, scaled to unit variances, finds the rank: it stops at the
first driver of which the ones before leave nothing unexplained. Collinear drivers
do not have unique coefficients; of all least-squares solutions the one of least
norm is returned. The cost on the driver depends on d alone. The single-driver fits
are plain ``regr_*`` aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.constants import DRIVERS, TARGET

#: A driver of whose variance the drivers before leave this share, or less, adds nothing to the rank.
RANK_TOLERANCE = 1e-10


def _filled(feature: str) -> Column:
    """A feature's value; NULL and NaN count as 0."""
    return F.coalesce(F.nanvl(F.col(feature).cast("double"), F.lit(0.0)), F.lit(0.0))


@dataclass(frozen=True)
class OlsFit:
    """``basis``: the features that were found independent, in pivot order; ``r2`` is
    None where the target does not vary, and all numbers where there are no rows."""
    features: tuple[str, ...]
    coefficients: tuple[float | None, ...]
    intercept: float | None
    r2: float | None
    rank: int
    basis: tuple[str, ...]
    n: int

    def predict(self) -> Column:
        """The prediction for a row of the features."""
        terms = [_filled(f) * F.lit(c).cast("double") for f, c in zip(self.features, self.coefficients)]
        return sum(terms, F.lit(self.intercept).cast("double"))


def pivoted_cholesky(gram: np.ndarray, tolerance: float = RANK_TOLERANCE) -> list[int]:
    """The indexes of independent columns, most unexplained variance first; ``gram`` has
    ones (or zeros, for constants) on its diagonal."""
    left, factors, pivots = np.diag(gram).copy(), [], []
    for _ in range(len(gram)):
        p = int(np.argmax(left))
        if left[p] <= tolerance:
            break
        row = (gram[p] - sum((f[p] * f for f in factors), np.zeros(len(gram)))) / np.sqrt(left[p])
        factors.append(row)
        pivots.append(p)
        left = np.maximum(left - row ** 2, 0)
        left[pivots] = 0
    return pivots


def least_norm(gram: np.ndarray, moments: np.ndarray, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, list[int]]:
    """(coefficients, independent columns): of all solutions of gram b = moments that of least norm."""
    scale = np.sqrt(np.diag(gram))
    unit = np.where(scale > 0, scale, 1.0)
    basis = pivoted_cholesky(gram / np.outer(unit, unit), tolerance)
    b = np.zeros(len(gram))
    if basis:
        s = unit[basis]
        inner = gram[np.ix_(basis, basis)] / np.outer(s, s)
        # every column as a combination of the basis; what the basis does not explain is rounding
        combine = np.linalg.solve(inner, gram[basis] / s[:, None]) / s[:, None]
        combine[:, basis] = np.eye(len(basis))
        combine[:, scale == 0] = 0
        fitted = np.linalg.solve(inner, moments[basis] / s) / s
        b = combine.T @ np.linalg.solve(combine @ combine.T, fitted)
    return b, basis


def _design(vendor: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    x = [_filled(f).alias(f"_x{i}") for i, f in enumerate(features)]
    y = F.col(target).cast("double")
    return vendor.where(y.isNotNull()).select(*x, y.alias("_y"))


def fit_ols(vendor: DataFrame, features: Sequence[str] = DRIVERS, target: str = TARGET,
            tolerance: float = RANK_TOLERANCE) -> OlsFit:
    """Least squares of ``target`` on ``features`` with an intercept. NULL and NaN
    features count as 0, rows without a target are left out."""
    d = len(features)
    names = [*(f"_x{i}" for i in range(d)), "_y"]
    pairs = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]
    row = _design(vendor, features, target).agg(
        F.count(F.lit(1)), *[F.avg(c) for c in names], *[F.covar_pop(names[i], names[j]) for i, j in pairs]).first()
    n, means = row[0], row[1:d + 2]
    if not n:
        return OlsFit(tuple(features), (None,) * d, None, None, 0, (), 0)
    gram = np.zeros((d + 1, d + 1))
    for (i, j), value in zip(pairs, row[d + 2:]):
        gram[i, j] = gram[j, i] = value
    # a constant's variance may be left with rounding: relative to its mean square that is nothing
    for i in range(d):
        if gram[i, i] <= 1e-24 * (means[i] ** 2 + gram[i, i]):
            gram[i, :] = gram[:, i] = 0.0
    b, basis = least_norm(gram[:d, :d], gram[:d, d], tolerance)
    intercept = means[d] - float(b @ np.array(means[:d]))
    r2 = float(b @ gram[:d, d]) / gram[d, d] if gram[d, d] > 0 else None
    return OlsFit(tuple(features), tuple(map(float, b)), intercept, r2, len(basis),
                  tuple(features[i] for i in basis), n)


def margin_drivers(vendor: DataFrame, features: Sequence[str] = DRIVERS,
                   target: str = TARGET) -> DataFrame:
    """Coefficient table sorted ascending, with the sign reading, R^2 and the drivers' rank."""
    fit = fit_ols(vendor, features, target)
    rows = list(zip(fit.features, fit.coefficients))
    coef = vendor.sparkSession.createDataFrame(rows, "feature string, coefficient double")
    direction = (F.when(F.round("coefficient", 4) > 0, "increases")
                  .when(F.round("coefficient", 4) < 0, "decreases").otherwise("negligible effect on"))
    return (coef.select("feature", F.round("coefficient", 4).alias("coefficient"),
                        direction.alias("direction"),
                        F.lit(fit.intercept).cast("double").alias("intercept"),
                        F.lit(fit.r2).cast("double").alias("r2"), F.lit(fit.rank).alias("rank"))
                .orderBy("coefficient", "feature"))


def margin_predictions(vendor: DataFrame, features: Sequence[str] = DRIVERS,
                       target: str = TARGET) -> DataFrame:
    """In-sample actual vs predicted margin per vendor."""
    fit = fit_ols(vendor, features, target)
    actual = F.col(target).cast("double")
    return vendor.where(actual.isNotNull()).select("VendorName", actual.alias("actual"),
                                                   fit.predict().alias("predicted"))


def r2_score(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """1 - SSE/SST in two aggregate passes (mean as a scalar subquery)."""
    mean = pred.agg(F.avg(actual)).scalar()
    return pred.agg((F.lit(1.0) - F.sum((F.col(actual) - F.col(predicted)) ** 2)
                     / F.nullif(F.sum((F.col(actual) - mean) ** 2), F.lit(0.0))).alias("r2"))


def single_driver_fits(vendor: DataFrame, features: Sequence[str] = DRIVERS,
                       target: str = TARGET) -> DataFrame:
    """Per driver: slope, intercept and R^2 of target ~ driver (one pass)."""
    v = vendor.fillna(0, subset=list(features))
    y = F.col(target)
    aggs = []
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        aggs += [F.regr_slope(y, x).alias(f"s{i}"), F.regr_intercept(y, x).alias(f"i{i}"),
                 F.regr_r2(y, x).alias(f"r{i}")]
    m = v.agg(*aggs)
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f"s{i}").alias("slope"),
                      F.col(f"i{i}").alias("intercept"), F.col(f"r{i}").alias("r2"))
             for i, f in enumerate(features)]
    return m.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
