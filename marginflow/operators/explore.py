"""Exploratory summaries: the data behind histograms, density curves and box plots.

* range statistics (min, max, n, std) come back as literals from one pass;
* histogram: 40 equal bins on [min, max] (NumPy's rule: the last bin is
  closed), empty bins included by a left join from a bins-row range;
* density: Gaussian KDE, Scott bandwidth (sample std * n^-1/5), evaluated on
  ``gridsize`` points over [min, max] (seaborn's histogram overlay) by the fast Gauss
  transform: Hermite moments of cells, one aggregate over the rows, which then serve
  the grid points near them, with a stated error;
* box: quartiles (exact, linear), 1.5 IQR fences, whiskers at the most
  extreme values inside the fences, outlier count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.constants import BOX_WHIS, HIST_BINS, KDE_GRIDSIZE
from marginflow.functions.quantiles import percentile_values
from marginflow.session import written


def _values(df: DataFrame, x: str | Column) -> DataFrame:
    c = (F.col(x) if isinstance(x, str) else x).cast("double")
    return df.select(c.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))


def _range_stats(vals: DataFrame):
    """min, max, n, sample std in one pass; four numbers come back as literals."""
    return vals.agg(F.min("_x"), F.max("_x"), F.count("_x"), F.stddev_samp("_x")).first()


def histogram(df: DataFrame, x: str | Column, bins: int = HIST_BINS) -> DataFrame:
    vals = _values(df, x)
    a, b, n, _ = _range_stats(vals)
    spark = df.sparkSession
    grid = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if n == 0:
        return grid.select("bin", F.lit(None).cast("double").alias("bin_start"),
                           F.lit(None).cast("double").alias("bin_end"), F.lit(0).cast("long").alias("count"))
    lo, hi = (a - 0.5, b + 0.5) if a == b else (a, b)
    idx = F.least(F.floor((F.col("_x") - F.lit(lo)) * F.lit(float(bins) / (hi - lo))).cast("int") + 1,
                  F.lit(bins))
    counts = vals.select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / bins
    return (grid.join(F.broadcast(counts), "bin", "left")          # <= bins rows
                .select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_start"),
                        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_end"),
                        F.coalesce("count", F.lit(0)).cast("long").alias("count")))


#: Width of a moment cell in bandwidths, and the distance beyond which a kernel counts as nothing.
CELL, REACH = 1.0, 9.0


def hermite_terms(error: float, cell: float = CELL) -> int:
    """Terms of the Hermite expansion around a cell's middle that keep each kernel value
    (at most 1) within ``error``; kernels beyond ``REACH`` are below 1e-17.

    By Cramer's inequality the p-th Hermite function is at most 1.09 2^(p/2) sqrt(p!),
    so the p-th term is at most 1.09 (sqrt(2) r)^p / sqrt(p!), r being half a cell."""
    r = cell / (2 * math.sqrt(2)) * math.sqrt(2)
    p = 1
    while 1.09 * r ** p / math.sqrt(math.factorial(p)) / (1 - r) > error:
        p += 1
    return p


def density_moments(vals: DataFrame, origin: float, bandwidth: float, error: float = 1e-12, cell: float = CELL) -> DataFrame:
    """(cell, a0, a1, ...): the sums of t^p / p! of the values ``_x`` in each cell, t being
    the distance from the cell's middle in units of sqrt(2) bandwidths. Sums of moments
    are the moments of a union, so tables of the same origin, bandwidth and cell can be added up."""
    width = cell * bandwidth
    at = F.floor((F.col("_x") - F.lit(origin)) / F.lit(width)).cast("long")
    middle = F.lit(origin) + (F.col("cell").cast("double") + 0.5) * F.lit(width)
    t = ((F.col("_x") - middle) / F.lit(math.sqrt(2) * bandwidth)).alias("t")
    rows = vals.select("_x", at.alias("cell")).select("cell", t)
    power, sums = F.lit(1.0), []
    for p in range(hermite_terms(error, cell)):
        sums.append((F.sum(power) / F.lit(float(math.factorial(p)))).alias(f"a{p}"))
        power = power * F.col("t")
    return rows.groupBy("cell").agg(*sums)


def _grid(vals: DataFrame, gridsize: int):
    """(min, step, n, Scott's bandwidth) of the density's grid; None without spread."""
    a, b, n, sd = _range_stats(vals)
    h = sd * float(n) ** -0.2 if (sd is not None and n) else None
    return (a, (b - a) / (gridsize - 1), n, h) if h else None


def _no_density(df: DataFrame, gridsize: int) -> DataFrame:
    return df.sparkSession.range(gridsize).select(
        F.col("id").cast("int").alias("point"), F.lit(None).cast("double").alias("x"),
        F.lit(None).cast("double").alias("density"), F.lit(None).cast("double").alias("count_scale"))


def _scaled_density(sums: DataFrame, a: float, step: float, n: int, h: float, gridsize: int, bins: int) -> DataFrame:
    density = F.col("ksum") / F.lit(n * h * math.sqrt(2 * math.pi))
    return sums.select(F.col("point").cast("int").alias("point"),
                       (F.lit(a) + F.col("point") * F.lit(step)).alias("x"), density.alias("density"),
                       (density * F.lit(n * (step * (gridsize - 1) / bins))).alias("count_scale"))


def kde(df: DataFrame, x: str | Column, gridsize: int = KDE_GRIDSIZE, bins: int = HIST_BINS,
        error: float = 1e-12) -> DataFrame:
    """Gaussian density on a grid by the fast Gauss transform, every kernel value within
    ``error`` of its own (so the density is within error / (h sqrt(2 pi))).

    One pass over the rows adds them up to the moments of cells of a bandwidth; a cell then
    serves the grid points within ``REACH`` bandwidths. The cost is rows + cells x points
    instead of rows x points; there are at most range / bandwidth cells."""
    vals = _values(df, x)
    grid = _grid(vals, gridsize)
    if grid is None:
        return _no_density(df, gridsize)
    a, step, n, h = grid
    terms = hermite_terms(error)
    cells = written(density_moments(vals, a, h, error), "density-moments")
    width = CELL * h
    middle = F.lit(a) + (F.col("cell").cast("double") + 0.5) * F.lit(width)
    reach = REACH * h + width
    low = F.greatest(F.ceil((middle - F.lit(a + reach)) / F.lit(step)), F.lit(0))
    high = F.least(F.floor((middle - F.lit(a - reach)) / F.lit(step)), F.lit(gridsize - 1))
    near = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    pairs = cells.select("cell", F.array(*[f"a{p}" for p in range(terms)]).alias("m"), F.explode(near).alias("point"))
    u = ((F.lit(a) + F.col("point") * F.lit(step) - middle) / F.lit(math.sqrt(2) * h))
    pairs = pairs.select("point", "m", u.alias("u"))
    # the Hermite functions by their recurrence, from exp(-u^2) upwards
    start = F.struct(F.lit(0.0).alias("before"), F.exp(-F.col("u") * F.col("u")).alias("now"), F.lit(0.0).alias("sum"), F.lit(0).alias("p"))
    kernel = F.aggregate("m", start, lambda s, m: F.struct(
        s["now"].alias("before"),
        (F.lit(2.0) * F.col("u") * s["now"] - F.lit(2.0) * s["p"] * s["before"]).alias("now"),
        (s["sum"] + m * s["now"]).alias("sum"), (s["p"] + 1).alias("p")), lambda s: s["sum"])
    points = df.sparkSession.range(gridsize).select(F.col("id").alias("point"), F.lit(0.0).alias("k"))
    sums = (pairs.select("point", kernel.alias("k")).unionByName(points)          # a point that no cell reaches is 0
            .groupBy("point").agg(F.sum("k").alias("ksum")))
    return _scaled_density(sums, a, step, n, h, gridsize, bins)


def kde_exact(df: DataFrame, x: str | Column, gridsize: int = KDE_GRIDSIZE, bins: int = HIST_BINS) -> DataFrame:
    """The same density with every kernel of every row at every grid point."""
    vals = _values(df, x)
    grid = _grid(vals, gridsize)
    if grid is None:
        return _no_density(df, gridsize)
    a, step, n, h = grid
    z = (F.lit(a) + F.col("point") * F.lit(step) - F.col("_x")) / F.lit(h)
    sums = (vals.select("_x", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("point"))
                .groupBy("point").agg(F.sum(F.exp(F.lit(-0.5) * F.pow(z, 2))).alias("ksum")))
    return _scaled_density(sums, a, step, n, h, gridsize, bins)


def box_stats(df: DataFrame, x: str, whis: float = BOX_WHIS) -> DataFrame:
    """Quartiles, fences, whiskers and outlier count (matplotlib's box rule).

    Quartiles come back as literals; then one pass: a value is an outlier
    exactly when it lies outside the fences, because the whiskers are the most
    extreme values inside them.
    """
    q1, med, q3 = percentile_values(df, x, [0.25, 0.5, 0.75])
    v = F.col(x).cast("double")
    vals = df.where(v.isNotNull() & ~F.isnan(v))
    if q1 is None:
        return vals.agg(F.count(F.lit(1)).alias("n"), *[F.lit(None).cast("double").alias(c) for c in
                        ("q1", "median", "q3", "iqr", "whisker_low", "whisker_high")],
                        F.lit(0).cast("long").alias("outliers"))
    iqr = q3 - q1
    lo_f, hi_f = q1 - whis * iqr, q3 + whis * iqr
    return vals.agg(
        F.count(F.lit(1)).alias("n"), F.lit(q1).alias("q1"), F.lit(med).alias("median"),
        F.lit(q3).alias("q3"), F.lit(iqr).alias("iqr"),
        F.coalesce(F.min(F.when(v >= lo_f, v)), F.lit(q1)).alias("whisker_low"),
        F.coalesce(F.max(F.when(v <= hi_f, v)), F.lit(q3)).alias("whisker_high"),
        F.count_if((v < lo_f) | (v > hi_f)).alias("outliers"))
