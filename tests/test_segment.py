"""Segmentation: scaling, nearest centroid, tier labels, exact silhouette, KMeans restarts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginflow.operators import segment
from marginflow.operators.kmeans import kmeans
from marginflow.operators.silhouette_tree import silhouette_tree

COLS = ["f0", "f1"]


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) if c != labels[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


@pytest.mark.parametrize("block_size", [7, 4096])
def test_silhouette_exact_over_many_blocks(spark, block_size):
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(c, 0.7, size=(n, 2)) for c, n in [(0, 20), (3, 15), (6, 1)]])
    labels = np.array([0] * 20 + [1] * 15 + [2])            # includes a singleton cluster
    df = spark.createDataFrame([(f"p{i}", int(l), float(a), float(b)) for i, (l, (a, b)) in
                                enumerate(zip(labels, x))], "VendorName string, Cluster int, f0 double, f1 double")
    got = segment.silhouette(df, COLS, block_size=block_size).first()
    assert got.n == 36
    assert got.silhouette == pytest.approx(brute_silhouette(x, labels), abs=1e-9)


def test_silhouette_single_cluster_is_null(spark):
    df = spark.createDataFrame([("a", 0, 1.0, 2.0), ("b", 0, 2.0, 2.0)], "VendorName string, Cluster int, f0 double, f1 double")
    assert segment.silhouette(df, COLS).first().silhouette is None


def test_standardize_population_std_and_constant(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0)], "VendorName string, f0 double, f1 double")
    rows = {r.VendorName: r for r in segment.standardize(df, COLS).collect()}
    assert rows["a"].f0 == -1.0 and rows["b"].f0 == 1.0     # population std = 1
    assert rows["a"].f1 == 0.0                              # std 0 -> divide by 1


def test_nearest_centroid_ties_go_to_lower_id(spark):
    pts = spark.createDataFrame([("a", 0.0, 0.0), ("b", 2.0, 0.0), ("c", 1.0, 0.0)], "VendorName string, f0 double, f1 double")
    cents = spark.createDataFrame([(0, 0.0, 0.0), (1, 2.0, 0.0)], "Cluster int, f0 double, f1 double")
    got = {r.VendorName: r.Cluster for r in segment.assign_nearest(pts, cents, COLS).collect()}
    assert got == {"a": 0, "b": 1, "c": 0}


def test_tier_labels_rank_and_single_cluster(spark):
    vendor = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("c", 9.0), ("d", 2.0)], "VendorName string, GrossProfit double")
    assigned = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1), ("d", 2)], "VendorName string, Cluster int")
    got = {r.Cluster: r.PerformanceTier for r in segment.rank_labels(assigned, vendor).collect()}
    assert got == {2: segment.LOW, 0: segment.MID, 1: segment.HIGH}
    one = spark.createDataFrame([("a", 0), ("b", 0)], "VendorName string, Cluster int")
    assert segment.rank_labels(one, vendor).first().PerformanceTier == segment.HIGH


def test_tier_agreement(spark):
    p = spark.createDataFrame([("a", "Low Performer"), ("b", "High Performer"), ("z", "Mid Performer")],
                              "VendorName string, PerformanceTier string")
    r = spark.createDataFrame([("a", "Low Performer"), ("b", "Mid Performer")], "VendorName string, PerformanceTier string")
    row = segment.tier_agreement(p, r).first()
    assert (row.vendors_compared, row.vendors_agreeing, row.match_rate) == (2, 1, 0.5)
    assert [x.status for x in segment.tier_mismatches(p, r).collect()] == ["match", "MISMATCH"]


def test_more_restarts_never_raise_inertia(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 1.0, size=(40, 2)) for c in (0, 4, 8)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "f0 double, f1 double")
    one = kmeans(df, F.array(*COLS), 3, n_init=1, seed=42).inertia
    ten = kmeans(df, F.array(*COLS), 3, n_init=5, seed=42).inertia
    assert ten <= one + 1e-9


@pytest.mark.parametrize("relative,leaf", [(0.0, 16), (0.02, 8), (0.1, 64)])
def test_silhouette_tree_is_within_its_error(spark, relative, leaf):
    rng = np.random.default_rng(12)
    x = np.vstack([rng.normal(c, 0.8, size=(n, 2)) for c, n in [(0, 150), (4, 120), (9, 60), (30, 1)]])
    labels = np.array([0] * 150 + [1] * 120 + [2] * 60 + [3])
    rows = [(int(l), float(a), float(b)) for l, (a, b) in zip(labels, x)]
    df = spark.createDataFrame(rows + [(None, 0.0, 0.0), (1, None, 0.0), (1, float("nan"), 0.0)],
                               "Cluster int, f0 double, f1 double").repartition(3)
    got = silhouette_tree(df, COLS, relative=relative, leaf=leaf, fan=3).first()
    assert got.n == 331 and got.error <= 2.5 * relative + 1e-9
    assert abs(got.silhouette - brute_silhouette(x, labels)) <= got.error + 1e-9
    one = silhouette_tree(df.where("Cluster = 1"), COLS).first()
    assert one.silhouette is None and one.error is None


def test_silhouette_holds_strips_of_distances_only(spark):
    """A pair of blocks is added up strip by strip: not all its distances are there at once."""
    import tracemalloc
    from unittest import mock
    seen = {}

    def kernel(self, func, schema):
        seen["block"] = func
        return self_of(self, func, schema)

    from pyspark.sql.pandas.group_ops import PandasCogroupedOps
    self_of = PandasCogroupedOps.applyInPandas
    df = spark.createDataFrame([("a", 0, 1.0, 2.0), ("b", 1, 2.0, 2.0), ("c", 1, 2.0, 5.0)], "VendorName string, Cluster int, f0 double, f1 double")
    with mock.patch.object(PandasCogroupedOps, "applyInPandas", kernel):
        segment.silhouette(df, COLS)
    import pandas as pd
    rng, n = np.random.default_rng(3), 4000
    side = lambda a, b: pd.DataFrame({"pid": [f"{a}{i}" for i in range(n)], "cl": rng.integers(0, 3, n), "x": list(rng.normal(size=(n, 2))),
                                      "a": 0, "b": 1})
    left, right = side("l", 0), side("r", 1)
    tracemalloc.start()
    out = seen["block"](left, right)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 2 * 3 * n and peak < n * n * 8 / 2
    x, y = np.stack(left["x"].to_numpy()), np.stack(right["x"].to_numpy())
    d = np.sqrt(((x[:50, None] - y[None]) ** 2).sum(2))
    got = out[out.pid.isin(left.pid[:50])].pivot(index="pid", columns="ref", values="dsum").loc[left.pid[:50]].to_numpy()
    assert np.allclose(got, np.stack([d[:, right["cl"] == c].sum(1) for c in range(3)], axis=1))
