"""The nested analysis report (statistics, clustering, regression) as one row.

Each part is a small aggregate; they are combined as scalar subqueries into a
single-row DataFrame with nested structs and maps, ready for ``to_json`` or a
JSON sink. Rounding follows the original report (half-even: ``bround``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.constants import CLUSTER_ALGORITHM, TARGET_LABEL, VENDOR_K
from marginflow.operators import regress, segment, stats


def analysis_report(vendor: DataFrame, tiers: DataFrame, scaled: DataFrame, k: int = VENDOR_K,
                    silhouette: Callable[[DataFrame], DataFrame] = segment.silhouette) -> DataFrame:
    """The report. ``silhouette`` scores the clusters: the exact one (quadratic in the vendors),
    ``silhouette_tree.silhouette_tree`` (to a stated error), or another of the caller's."""
    spark = vendor.sparkSession
    t = stats.welch_ttest(vendor)
    ttest = t.select(F.struct(
        F.col("top_n").cast("long").alias("top_n"), F.col("bottom_n").cast("long").alias("bottom_n"),
        F.bround("top_mean_margin", 2).alias("top_mean_margin"),
        F.bround("bottom_mean_margin", 2).alias("bottom_mean_margin"),
        F.bround("t_statistic", 3).alias("t_statistic"), F.bround("p_value", 5).alias("p_value"),
        F.col("significant_at_0_05").alias("significant_at_0.05"))).scalar()

    corr = stats.correlation_matrix(vendor)
    corr_map = (corr.groupBy("metric_y")
                    .agg(F.map_from_entries(F.collect_list(F.struct("metric_x", "corr"))).alias("m"))
                    .agg(F.map_from_entries(F.collect_list(F.struct("metric_y", "m")))).scalar())

    profile = segment.tier_profile(tiers, vendor)
    prof_map = profile.agg(F.map_from_entries(F.collect_list(F.struct(
        "PerformanceTier", F.struct("TotalSalesDollars", "GrossProfit", "ProfitMargin",
                                    "StockTurnover"))))).scalar()
    count_map = profile.agg(F.map_from_entries(F.collect_list(
        F.struct("PerformanceTier", "vendor_count")))).scalar()
    sil = silhouette(scaled.join(tiers.select("VendorName", "Cluster"), "VendorName"))
    sil_v = sil.select(F.bround("silhouette", 3)).scalar()

    drivers = regress.margin_drivers(vendor)
    coef_map = drivers.agg(F.map_from_entries(F.collect_list(
        F.struct("feature", "coefficient")))).scalar()
    reg = drivers.agg(F.bround(F.first("r2"), 3).alias("r2"),
                      F.bround(F.first("intercept"), 2).alias("i")).select(F.struct("r2", "i")).scalar()

    return spark.range(1, numPartitions=1).select(
        F.struct(F.struct(ttest.alias("ttest_top_vs_bottom_sales_tier"),
                          corr_map.alias("correlation_matrix")).alias("statistics"),
                 F.struct(F.lit(CLUSTER_ALGORITHM.format(k=k)).alias("algorithm"),
                          F.array(*[F.lit(c) for c in segment.FEATURES]).alias("features_used"),
                          sil_v.alias("silhouette_score"),
                          prof_map.alias("cluster_profile_means"),
                          count_map.alias("vendor_counts")).alias("clustering"),
                 F.struct(F.lit(TARGET_LABEL).alias("target"),
                          F.array(*[F.lit(c) for c in regress.DRIVERS]).alias("features"),
                          reg.getField("r2").alias("r2_score"),
                          reg.getField("i").alias("intercept"),
                          coef_map.alias("coefficients")).alias("regression")).alias("report"))


def report_fields(report: DataFrame) -> DataFrame:
    """(part, name, value): every number of the report as a row of its own."""
    r = F.col("report")
    test = r["statistics"]["ttest_top_vs_bottom_sales_tier"]
    clusters, fit = r["clustering"], r["regression"]

    def row(part, name, value):
        return F.struct(F.lit(part).alias("part") if isinstance(part, str) else part.alias("part"),
                        (F.lit(name) if isinstance(name, str) else name).alias("name"),
                        value.cast("double").alias("value"))

    def rows(entries, part, name, value):
        return F.transform(F.map_entries(entries), lambda e: row(part, name(e), value(e)))

    numbers = ("top_n", "bottom_n", "top_mean_margin", "bottom_mean_margin", "t_statistic", "p_value")
    profile = clusters["cluster_profile_means"]
    lists = [F.array(*[row("ttest", c, test[c]) for c in numbers], row("silhouette", "all", clusters["silhouette_score"]),
                     row("regression", "r2", fit["r2_score"]), row("regression", "intercept", fit["intercept"])),
             F.flatten(F.transform(F.map_entries(r["statistics"]["correlation_matrix"]), lambda y: F.transform(
                 F.map_entries(y["value"]), lambda x: row("correlation", F.concat_ws(" ", x["key"], y["key"]), x["value"])))),
             rows(clusters["vendor_counts"], "vendors", lambda e: e["key"], lambda e: e["value"]),
             rows(fit["coefficients"], "coefficient", lambda e: e["key"], lambda e: e["value"])]
    for c in ("TotalSalesDollars", "GrossProfit", "ProfitMargin", "StockTurnover"):
        def of(e, c=c):
            return e["value"][c]
        lists.append(rows(profile, c, lambda e: e["key"], of))
    return report.select(F.explode(F.concat(*lists)).alias("f")).select("f.*")


def report_json(report: DataFrame) -> DataFrame:
    return report.select(F.to_json("report").alias("json"))
