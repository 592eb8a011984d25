"""Joint KMeans against a plain NumPy version of the same draws and steps."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.operators import kmeans as km


def frame(spark, x, parts=3):
    d = x.shape[1]
    rows = [(f"p{i}", [float(v) for v in r]) for i, r in enumerate(x)]
    assert d
    return spark.createDataFrame(rows, "id string, x array<double>").repartition(parts)


def squares(x, c, unit=1.0):
    return np.round(((x[:, None, :] - c[None, :, :]) ** 2).sum(2) / unit, km.PLACES) * unit


def plain_seeds(keys, x, k, seed, restart):
    h = np.array([int(hashlib.md5(s.encode()).hexdigest()[:7], 16) + 1 for s in keys])
    chosen = []
    for j in range(k):
        u = (h * km.draw_multiplier(seed, restart, j) % km.PRIME) / km.PRIME
        w = squares(x, np.array(chosen)).min(1) if chosen else np.ones(len(x))
        time = np.where(w > 0, -np.log(u) / np.where(w > 0, w, 1), np.inf)
        if not np.isfinite(time).any():
            break
        chosen.append(x[min(range(len(x)), key=lambda i: (time[i], keys[i]))])
    return np.array(chosen)


def plain_lloyd(x, c):
    for _ in range(300):
        near = squares(x, c).argmin(1)
        new = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        if np.abs(new - c).max() < 1e-12:
            break
        c = new
    return c, squares(x, c).min(1).sum()


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    return np.vstack([rng.normal(c, 0.6, size=(70, 3)) for c in (0, 3, 5, 9)])


@pytest.mark.parametrize("rows", [5, 64, 1000])
def test_fit_equals_plain_version(spark, points, rows):
    blocks = km.point_blocks(frame(spark, points), "x", "id", rows).cache()
    got = km.fit(blocks, 4, 4, seed=42)
    keys = [f"p{i}" for i in range(len(points))]
    ends = [plain_lloyd(points, plain_seeds(keys, points, 4, 42, r)) for r in range(4)]
    assert got.inertia == pytest.approx(min(e[1] for e in ends), rel=1e-9)
    assert np.allclose(got.centres, ends[got.restart][0], atol=1e-9)
    seeds = km.seed_centres(blocks, 4, [0, 1, 2, 3], 42)
    assert all(np.array_equal(s, plain_seeds(keys, points, 4, 42, r)) for r, s in enumerate(seeds))


def test_partitioning_does_not_matter(spark, points):
    a, b = (km.kmeans(frame(spark, points, n), "x", 3, 3, 7, key="id") for n in (1, 5))
    assert a.restart == b.restart and np.allclose(a.centres, b.centres, atol=1e-9)


def test_rows_are_at_their_nearest_mean(spark, points):
    df = frame(spark, points)
    fit = km.kmeans(df, "x", 4, 3, 1, key="id")
    got = {r["id"]: r["c"] for r in km.nearest_centre(df, fit.centres, "x", "c").collect()}
    label = np.array([got[f"p{i}"] for i in range(len(points))])
    means = np.array([points[label == c].mean(0) for c in range(4)])
    assert np.array_equal(squares(points, means).argmin(1), label)
    assert fit.inertia == pytest.approx(squares(points, means).min(1).sum(), rel=1e-9)


def test_bounds_skip_blocks_without_changing_sums(spark, points):
    centres = np.array([[[0.0] * 3, [9.0] * 3], [[0.0] * 3, [0.5] * 3]])
    small, large = (km.lloyd_pass(km.point_blocks(frame(spark, points), "x", "id", n), centres) for n in (4, 1000))
    assert np.allclose(small, large, rtol=1e-9)
    assert np.allclose(small[:, :, 3].sum(1), len(points))


def test_few_distinct_rows_missing_features_and_no_rows(spark):
    rows = [("a", [1.0, 1.0]), ("b", [1.0, 1.0]), ("c", [2.0, 2.0]), ("d", None), ("e", [float("nan"), 0.0]),
            ("f", [None, 1.0]), (None, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "id string, x array<double>")
    fit = km.kmeans(df, "x", 5, 2, 0, key="id")
    assert sorted(map(tuple, fit.centres.tolist())) == [(1.0, 1.0), (2.0, 2.0)] and fit.inertia == 0
    got = km.renumbered(km.nearest_centre(df, fit.centres, "x", "c"), "c", "id").collect()
    assert sorted((r["id"] or "", r["c"]) for r in got if r["c"] is not None) == [("", 1), ("a", 0), ("b", 0), ("c", 1)]
    assert sum(r["c"] is None for r in got) == 3
    assert km.kmeans(df.where("false"), "x", 3, 2, 0, key="id") is None


def test_keys_default_to_the_features(spark, points):
    df = frame(spark, points).select("x", F.lit(1).alias("more"))
    assert km.kmeans(df, "x", 2, 2, 0).inertia > 0


@pytest.mark.parametrize("scale", [1e-7, 1e9])
def test_the_scale_of_features_does_not_matter(spark, points, scale):
    plain = km.kmeans(frame(spark, points), "x", 4, 3, 1, key="id")
    scaled = km.kmeans(frame(spark, points * scale + 5 * scale), "x", 4, 3, 1, key="id")
    assert scaled.restart == plain.restart
    assert np.allclose(scaled.centres / scale - 5, plain.centres, rtol=1e-6, atol=1e-6)
