"""Vendor segmentation: features, scaling, KMeans tiers, silhouette, agreement.

* features: log1p of clipped dollars, margin, turnover capped at its exact
  95th percentile (a literal from the distributed percentile; no join);
* scaling: (x - mean) / population std, std 0 -> 1, from one aggregate row
  whose moments come back as literals;
* KMeans: ``n_init`` restarts fitted together (``operators/kmeans.py``); the lowest
  inertia wins;
* nearest centroid: the k centroids come back as literals and each row takes
  ``array_min`` of k unrolled (distance, cluster) structs: O(n k), no join,
  ties go to the lower cluster id;
* tiers: clusters ranked by mean GrossProfit over k rows (lowest = Low, highest
  = High, the rest Mid; with k = 1 the single cluster is High);
* silhouette: exact Euclidean mean silhouette, blocked (see ``silhouette``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginflow.constants import (FEATURES, HIGH, LOW, MID, N_INIT, PROFILE_COLUMNS, SEED, TOP_N,
                                  TURNOVER_CAP_QUANTILE, VENDOR_K)
from marginflow.functions.columns import clip_lower, clip_upper
from marginflow.functions.quantiles import exact_percentile_value, percentile_values
from marginflow.operators.kmeans import kmeans


def cluster_features(vendor: DataFrame, cap_quantile: float = TURNOVER_CAP_QUANTILE) -> DataFrame:
    cap = exact_percentile_value(vendor, "StockTurnover", cap_quantile)
    return vendor.select(
        "VendorName",
        F.log1p(clip_lower("TotalSalesDollars", 0.0)).alias("LogSales"),
        F.log1p(clip_lower("GrossProfit", 0.0)).alias("LogGrossProfit"),
        "ProfitMargin",
        clip_upper("StockTurnover", cap).alias("StockTurnoverCapped"))


def standardize(df: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """(x - mean) / std_pop like scikit-learn's StandardScaler (std 0 -> 1)."""
    st = df.agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
    out = []
    for i, c in enumerate(cols):
        m, s = st[i], st[len(cols) + i]
        out.append(((F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)).alias(c))
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *out)


def _sqdist(cols: Sequence[str], centre: Sequence[float | None]) -> Column:
    return sum(((F.col(x) - F.lit(c).cast("double")) ** 2 for x, c in zip(cols, centre)), F.lit(0.0))


def assign_nearest(df: DataFrame, centroids: DataFrame, cols: Sequence[str] = FEATURES,
                   out: str = "Cluster") -> DataFrame:
    """Append the id of the nearest centroid. ``centroids``: (Cluster, *cols), k rows.

    The k centroids come back as literals and the k distances are unrolled into
    one codegen'd expression: O(n k), no join; ties go to the lower cluster id.
    """
    rows = centroids.select("Cluster", *cols).collect()      # k rows, the caller's k
    if not rows:
        return df.withColumn(out, F.lit(None).cast("int"))
    best = F.array_min(F.array(*[F.struct(_sqdist(cols, r[1:]).alias("d"), F.lit(int(r[0])).alias("id"))
                                 for r in rows]))
    return df.withColumn(out, best.getField("id").cast("int"))


def band_centroids(bands: DataFrame, cols: Sequence[str] = FEATURES) -> DataFrame:
    """Deterministic seed centroids: feature means of the quantile bands."""
    return (bands.withColumnRenamed("Band", "Cluster")
                 .groupBy("Cluster").agg(*[F.avg(c).alias(c) for c in cols]))


def seeded_bands(scaled: DataFrame, by: str = "LogSales", k: int = VENDOR_K) -> DataFrame:
    cuts = percentile_values(scaled, by, [i / k for i in range(1, k)])
    band = sum((F.when(F.col(by) >= F.lit(c).cast("double"), 1).otherwise(0) for c in cuts), F.lit(0))
    return scaled.withColumn("Band", band.cast("int"))


def band_tiers(bands: DataFrame, k: int = VENDOR_K) -> DataFrame:
    """A rule-based tier per vendor (lowest band Low, highest High, rest Mid)."""
    tier = F.when(F.col("Band") == k - 1, HIGH).when(F.col("Band") == 0, LOW).otherwise(MID)
    return bands.select("VendorName", tier.alias("PerformanceTier"))


def rank_labels(assigned: DataFrame, vendor: DataFrame, cluster: str = "Cluster") -> DataFrame:
    """k rows: (Cluster, MeanGrossProfit, TierRank, PerformanceTier)."""
    means = (assigned.select("VendorName", cluster)
             .join(vendor.select("VendorName", "GrossProfit"), "VendorName")
             .groupBy(cluster).agg(F.avg("GrossProfit").alias("MeanGrossProfit")))
    w = Window.orderBy("MeanGrossProfit", cluster)          # k rows only
    ranked = (means.withColumn("TierRank", F.row_number().over(w))
                   .withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))))
    tier = (F.when(F.col("TierRank") == F.col("_k"), HIGH)
             .when(F.col("TierRank") == 1, LOW).otherwise(MID))
    return ranked.select(cluster, "MeanGrossProfit", "TierRank", tier.alias("PerformanceTier"))


def attach_tiers(assigned: DataFrame, labels: DataFrame, cluster: str = "Cluster") -> DataFrame:
    """Map cluster -> tier (k-row lookup, broadcast); unknown cluster -> NULL."""
    return assigned.join(F.broadcast(labels.select(cluster, "PerformanceTier")), cluster, "left")


def tier_profile(tiers: DataFrame, vendor: DataFrame) -> DataFrame:
    """Vendor count and mean KPIs per tier, means rounded to 2 (half-even like pandas)."""
    v = tiers.select("VendorName", "PerformanceTier").join(vendor, "VendorName")
    return v.groupBy("PerformanceTier").agg(
        F.count(F.lit(1)).alias("vendor_count"),
        *[F.bround(F.avg(c), 2).alias(c) for c in PROFILE_COLUMNS])


def tier_agreement(pipeline: DataFrame, reference: DataFrame) -> DataFrame:
    """Inner join on VendorName; share of vendors whose tiers agree."""
    check = _check(pipeline, reference)
    eq = F.col("PerformanceTier_pipeline") == F.col("PerformanceTier_reference")
    return check.agg(F.count(F.lit(1)).alias("vendors_compared"),
                     F.count_if(eq).alias("vendors_agreeing"),
                     F.avg(eq.cast("double")).alias("match_rate"))


def _check(pipeline: DataFrame, reference: DataFrame) -> DataFrame:
    p = pipeline.select("VendorName", F.col("PerformanceTier").alias("PerformanceTier_pipeline"))
    r = reference.select("VendorName", F.col("PerformanceTier").alias("PerformanceTier_reference"))
    return p.join(r, "VendorName")


def tier_mismatches(pipeline: DataFrame, reference: DataFrame, n: int = TOP_N) -> DataFrame:
    eq = F.col("PerformanceTier_pipeline") == F.col("PerformanceTier_reference")
    return (_check(pipeline, reference)
            .withColumn("status", F.when(eq, "match").otherwise("MISMATCH"))
            .orderBy("VendorName").limit(n))


# --- KMeans --------------------------------------------------------------------------------

def centroids_frame(spark, centres: np.ndarray, cols: Sequence[str] = FEATURES) -> DataFrame:
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(centres)]
    return spark.createDataFrame(rows, ["Cluster", *cols])


def kmeans_tiers(vendor: DataFrame, k: int = VENDOR_K, n_init: int = N_INIT, seed: int = SEED,
                 features: DataFrame | None = None, scaled: DataFrame | None = None) -> DataFrame:
    """Full tiering: features -> scaled -> best-of-n KMeans -> ranked tiers.

    Cluster ids are renumbered by tier rank (0 = lowest mean GrossProfit), so
    output is stable across restarts that find the same partition.
    """
    feats = features if features is not None else cluster_features(vendor)
    scaled = scaled if scaled is not None else standardize(feats)
    found = kmeans(scaled, F.array(*FEATURES), k, n_init, seed, key="VendorName")
    cents = centroids_frame(vendor.sparkSession, found.centres if found else np.zeros((0, len(FEATURES))))
    assigned = assign_nearest(scaled, cents)
    labels = rank_labels(assigned, vendor).select("Cluster", "TierRank", "PerformanceTier")
    out = assigned.join(F.broadcast(labels), "Cluster")      # k rows
    raw = feats.select("VendorName", F.col("LogSales").alias("_ls"), F.col("ProfitMargin").alias("_pm"))
    return (out.join(raw, "VendorName")
               .select("VendorName", F.col("_ls").alias("LogSales"), F.col("_pm").alias("ProfitMargin"),
                       (F.col("TierRank") - 1).cast("int").alias("Cluster"), "PerformanceTier"))


# --- silhouette ---------------------------------------------------------------------------

def silhouette_squared(df: DataFrame, cols: Sequence[str] = FEATURES, cluster: str = "Cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance: O(n k), another metric than
    ``silhouette``, for the caller to choose.

    A point's mean squared distance to a cluster follows from the cluster's count,
    coordinate sums and sum of squared norms, so one aggregate to k rows and one
    pass over the points suffice. Singletons score 0; fewer than two clusters give NULL.
    """
    x = [F.col(c).cast("double") for c in cols]
    square = sum((v * v for v in x), F.lit(0.0))
    rows = (df.groupBy(F.col(cluster).alias("id"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(square).alias("q"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(x)])
              .collect())                                    # k rows
    if len(rows) < 2:
        return df.agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("silhouette"))

    def spread(r):  # the summed squared distances from a point to a cluster's members
        dot = sum((v * F.lit(r[f"s{i}"]) for i, v in enumerate(x)), F.lit(0.0))
        return F.lit(float(r["n"])) * square + F.lit(r["q"]) - F.lit(2.0) * dot

    own = F.coalesce(*[F.when(F.col(cluster) == r["id"], spread(r) / (r["n"] - 1) if r["n"] > 1 else F.lit(None).cast("double"))
                       for r in rows])
    other = F.array_min(F.array(*[F.when(F.col(cluster) != r["id"], spread(r) / r["n"]) for r in rows]))
    score = F.coalesce((F.col("_b") - F.col("_a")) / F.nullif(F.greatest("_a", "_b"), F.lit(0.0)), F.lit(0.0))
    points = df.select(own.alias("_a"), other.alias("_b"))
    return points.agg(F.count(F.lit(1)).alias("n"),
                      F.avg(F.when(F.col("_a").isNull(), F.lit(0.0)).otherwise(score)).alias("silhouette"))


def silhouette(df: DataFrame, cols: Sequence[str] = FEATURES, cluster: str = "Cluster",
               key: str = "VendorName", block_size: int = 2048) -> DataFrame:
    """Exact mean silhouette with Euclidean distance (scikit-learn's definition).

    O(n^2) distances are unavoidable for the exact value; they are computed in
    numpy per pair of blocks and never emitted as rows. Points are hashed into
    B = ceil(n / block_size) blocks. Only pairs a <= b are formed (distance is
    symmetric): the cogroup task for (a, b) gets block a's points on the left
    and block b's on the right, and from one distance matrix emits, per point
    and per cluster, the distance sums of the left points to the right clusters
    (row sums) and, when a != b, of the right points to the left clusters
    (column sums). Each point is shipped about B + 1 times and memory per task
    is bounded by ``block_size`` whatever n is. Singletons score 0; fewer than
    two clusters gives NULL. ``key`` must identify points uniquely.
    """
    pts = df.select(F.col(key).cast("string").alias("pid"), F.col(cluster).cast("int").alias("cl"),
                    F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    nblocks = max(1, -(-pts.count() // block_size))
    blk = F.pmod(F.xxhash64("pid"), F.lit(nblocks)).cast("int")
    base = pts.select(F.col("pid").alias("pid"), F.col("cl").alias("cl"), F.col("x").alias("x"),
                      blk.alias("blk"))
    # left copy of block a goes to pairs (a, b >= a); right copy of block b to pairs (a <= b, b)
    left = base.select("pid", "cl", "x", F.col("blk").alias("a"),
                       F.explode(F.sequence(F.col("blk"), F.lit(nblocks - 1))).alias("b"))
    right = base.select(F.col("pid").alias("pid"), F.col("cl").alias("cl"), F.col("x").alias("x"),
                        F.explode(F.sequence(F.lit(0), F.col("blk"))).alias("a"), F.col("blk").alias("b"))

    def by_label(pdf: pd.DataFrame):
        """Ids and points in the order of their clusters, the clusters, and where each one's points are."""
        labels = pdf["cl"].to_numpy()
        order = np.argsort(labels, kind="stable")
        labels, labs = labels[order], np.unique(labels)
        spans = [(np.searchsorted(labels, lab), np.searchsorted(labels, lab, "right")) if lab == lab else (0, 0) for lab in labs]
        x = np.stack(pdf["x"].to_numpy()).astype(float)
        return pdf["pid"].to_numpy()[order], x[order], labs, spans

    def sums(ids, dsum, labs, spans):
        return pd.DataFrame({"pid": np.repeat(ids, len(labs)),
                             "ref": np.tile(labs, len(ids)).astype("int32"),
                             "dsum": dsum.reshape(-1),
                             "cnt": np.tile([end - start for start, end in spans], len(ids)).astype("int64")})

    def block(lpdf: pd.DataFrame, rpdf: pd.DataFrame) -> pd.DataFrame:
        if lpdf.empty or rpdf.empty:
            return pd.DataFrame({"pid": [], "ref": [], "dsum": [], "cnt": []})
        lids, xl, llabs, lspans = by_label(lpdf)
        rids, xr, rlabs, rspans = by_label(rpdf)
        rows, columns = np.zeros((len(xl), len(rlabs))), np.zeros((len(xr), len(llabs)))
        cuts = sorted({0, len(xl), *(int(at) for span in lspans for at in span)})
        for start, end in zip(cuts, cuts[1:]):
            own = [i for i, span in enumerate(lspans) if span == (start, end)]
            for s0 in range(start, end, 256):   # a strip of one cluster's points is added up at once, dimension by dimension
                strip = slice(s0, min(s0 + 256, end))
                d = np.zeros((strip.stop - s0, len(xr)))
                for dim in range(xl.shape[1]):
                    off = np.subtract.outer(xl[strip, dim], xr[:, dim])
                    d += np.multiply(off, off, out=off)
                np.sqrt(d, out=d)
                for i, (r0, r1) in enumerate(rspans):
                    rows[strip, i] = d[:, r0:r1].sum(1)
                for i in own:
                    columns[:, i] += d.sum(0)
        parts = [sums(lids, rows, rlabs, rspans)]
        if lpdf["a"].iloc[0] != lpdf["b"].iloc[0]:
            parts.append(sums(rids, columns, llabs, lspans))
        return pd.concat(parts, ignore_index=True)

    partial = (left.groupBy("a", "b").cogroup(right.groupBy("a", "b"))
                   .applyInPandas(block, "pid string, ref int, dsum double, cnt long"))
    per = (partial.groupBy("pid", "ref").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
                  .join(pts.select(F.col("pid").alias("pid"), F.col("cl").alias("cl")), "pid"))
    own = F.col("ref") == F.col("cl")
    s = per.groupBy("pid").agg(
        F.max(F.when(own, F.col("cnt"))).alias("n_own"),
        F.max(F.when(own, F.col("dsum") / F.nullif(F.col("cnt") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~own, F.col("dsum") / F.col("cnt"))).alias("b"))
    score = F.when((F.col("n_own") <= 1) | F.col("b").isNull(), F.lit(0.0)).otherwise(
        F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0)))
    k = df.agg(F.count_distinct(cluster)).first()[0]
    return s.agg(F.count(F.lit(1)).alias("n"),
                 (F.avg(score) if k >= 2 else F.lit(None).cast("double")).alias("silhouette"))
