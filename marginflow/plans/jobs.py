"""End-to-end jobs: the three runs of the original pipeline as Spark jobs.

* ``build_summary_job``: raw tables -> catalog table ``vendor_sales_summary``
  (CTAS, optionally bucketed on (VendorNumber, Brand));
* ``refresh_summary_job``: a batch of new raw rows -> the same table, from stored partial sums;
* ``clean_job``: summary -> catalog table ``vendor_sales_summary_clean`` + CSV
  export, with row/NULL metrics observed during the write;
* ``stats_ml_job``: clean table -> vendor frame with tiers (CSV) + nested JSON
  report, and an agreement check against a stored tier file when given;
* ``text_job``: transactions -> product clusters, cluster summary and themes.

Outputs go under ``out_dir`` (a shared folder on a cluster). Each job reads
its inputs from written tables, so a failed job restarts from the previous
job's output, not from the raw data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from marginflow.operators import clean, refresh, report, rollup, segment, summary, text
from marginflow.sources import files, schemas, sinks


def build_summary_job(raw: dict[str, DataFrame], out_dir: str, buckets: int | None = None) -> DataFrame:
    spark = raw["purchases"].sparkSession
    df = summary.vendor_sales_summary(raw["purchases"], raw["purchase_prices"],
                                      raw["vendor_invoice"], raw["sales"])
    path = f"{out_dir}/vendor_sales_summary"
    keys = ["VendorNumber", "Brand"] if buckets else None
    sinks.write_table(df, "vendor_sales_summary", path=path, bucket_by=keys, num_buckets=buckets or 0, sort_by=keys)
    return spark.table("vendor_sales_summary")


def refresh_summary_job(spark: SparkSession, batch: str, raw: dict[str, DataFrame], out_dir: str,
                        buckets: int | None = None, compact_after: int = 20) -> DataFrame:
    """New raw rows -> stored partial sums -> the same catalog table, without reading old raw
    rows. A batch that counts already is not added again; after ``compact_after`` batches
    the stored sums are put together."""
    state = refresh.SummaryState(spark, f"{out_dir}/summary_state")
    if state.apply(batch, raw) and len(state.batches()) % compact_after == 0:
        state.compact()
    keys = ["VendorNumber", "Brand"] if buckets else None
    sinks.write_table(state.summary(), "vendor_sales_summary", path=f"{out_dir}/vendor_sales_summary",
                      bucket_by=keys, num_buckets=buckets or 0, sort_by=keys)
    return spark.table("vendor_sales_summary")


def clean_job(summary_df: DataFrame, out_dir: str, lenient: bool = False) -> tuple[DataFrame, dict]:
    spark = summary_df.sparkSession
    reliable, obs = clean.observed_clean(summary_df, lenient)
    path = f"{out_dir}/vendor_sales_summary_clean"
    sinks.write_table(reliable, "vendor_sales_summary_clean", path=path)   # metrics ride along with this pass
    metrics = dict(obs.get)
    table = spark.table("vendor_sales_summary_clean")
    sinks.write_csv(table, f"{out_dir}/vendor_sales_summary_clean_csv")
    return table, metrics


def stats_ml_job(clean_df: DataFrame, out_dir: str, tier_reference: str | None = None,
                 k: int = 3, n_init: int = 10, seed: int = 42) -> dict[str, DataFrame]:
    spark = clean_df.sparkSession
    vendor_path = f"{out_dir}/vendor_frame"
    sinks.write_parquet(rollup.vendor_level_aggregate(clean_df), vendor_path)
    vendor = spark.read.parquet(vendor_path)
    feats = segment.cluster_features(vendor)
    scaled = segment.standardize(feats)
    tiers = segment.kmeans_tiers(vendor, k, n_init, seed, features=feats, scaled=scaled)
    tiers_path = f"{out_dir}/vendor_tiers"
    sinks.write_parquet(tiers, tiers_path)
    tiers = spark.read.parquet(tiers_path)
    clusters = vendor.join(tiers.select("VendorName", "Cluster", "PerformanceTier"), "VendorName")
    sinks.write_csv(clusters, f"{out_dir}/vendor_performance_clusters_csv")
    rep = report.analysis_report(vendor, tiers, scaled, k)
    sinks.write_json(rep.select("report.*"), f"{out_dir}/analysis_results_json")
    out = {"vendor": vendor, "tiers": tiers, "clusters": clusters, "report": rep}
    if tier_reference:
        ref = files.read_tier_reference(spark, tier_reference)
        out["agreement"] = segment.tier_agreement(tiers, ref)
        out["mismatches"] = segment.tier_mismatches(tiers, ref)
    return out


def text_job(transactions: DataFrame, out_dir: str, k: int = 8, n_init: int = 10, seed: int = 42,
             stop_words: Sequence[str] | None = None) -> dict[str, DataFrame]:
    spark = transactions.sparkSession
    prod_path = f"{out_dir}/product_rollup"
    sinks.write_parquet(text.product_rollup(transactions), prod_path)
    prod = spark.read.parquet(prod_path)
    weights, vocab = text.tfidf(prod, stop_words=stop_words)
    weights_path = f"{out_dir}/product_tfidf"
    sinks.write_parquet(weights, weights_path)
    weights = spark.read.parquet(weights_path)
    clusters = text.kmeans_text_clusters(prod, k, n_init, seed, stop_words=stop_words, vocab=vocab)
    out = {"products": prod}
    for name, df in (("clusters", clusters), ("summary", None), ("themes", None)):
        if name == "summary":
            df = text.cluster_summary(prod, out["clusters"])
        elif name == "themes":
            df = text.cluster_top_terms(weights, out["clusters"])
        path = f"{out_dir}/text_{name}"
        sinks.write_parquet(df, path)
        out[name] = spark.read.parquet(path)
    return out


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    """The e-commerce transactions CSV (ISO-8859-1), with a unique row order for "first":
    by file name, place in the file, then row (Spark itself reads splits by size)."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = (files.read_csv(spark, path, schemas.PRODUCTS, encoding="ISO-8859-1")
            .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                    F.monotonically_increasing_id().alias("_id")))
    # one row a split: the single-task numbering is bounded by the number of splits
    splits = (rows.select("_file", "_start").distinct()
              .withColumn("_split", F.row_number().over(Window.orderBy("_file", "_start"))))
    in_split = F.col("_id") % F.lit(1 << 33)
    order = F.col("_split").cast("decimal(38,0)") * F.lit(1 << 33).cast("decimal(38,0)") + in_split
    return (rows.join(splits, ["_file", "_start"])
            .withColumn("_row_order", order.cast("decimal(38,0)")).drop("_file", "_start", "_id", "_split"))
