"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the test tables (or stage tables Spark derived from them) in
full. Doubles are rounded to 4 places so that results compare stably with the
SQL oracle across summation orders.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.constants import KPI_COLUMNS
from marginflow.functions.columns import clip_upper, round_doubles
from marginflow.functions.quantiles import exact_percentile_value
from marginflow.operators import (clean, explore, refresh, regress, report, reports, segment, silhouette_tree, sketches,
                                  stats, summary, text)
from marginflow.plans.stages import workspace
from marginflow.session import scratch_path
from marginflow.sources import files, schemas, sinks, testdata

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}        # rounded outputs: what the SQL oracle compares
OPERATORS: dict[str, QueryFn] = {}      # the same queries, unrounded: what users get


def query(name: str, digits: int | None = 4):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(workspace(spark, sf_dir))
            return round_doubles(df, digits) if digits is not None else df

        def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(workspace(spark, sf_dir))
        run.__name__ = raw.__name__ = name
        run.__doc__ = raw.__doc__ = fn.__doc__
        QUERIES[name] = run
        OPERATORS[name] = raw
        return fn
    return deco


# --- summary build ---------------------------------------------------------------

@query("vendor_sales_summary")
def _vss(ws):
    """Flagship: the aggregate-before-join summary from the four raw tables,
    created as a table (CTAS) in the shared folder and returned from there, so
    every later stage reads the same written rows."""
    return ws.summary()


@query("incremental_summary")
def _incremental(ws):
    """The same summary from stored partial sums of three batches of the raw rows, the
    last of them added after the first two were put together."""
    state = refresh.SummaryState(ws.spark, scratch_path(ws.spark, ws._tag, f"summary-state-{uuid.uuid4().hex[:8]}"))
    raw = ws.raw()
    raw["vendor_invoice"] = ws.materialize("raw_vendor_invoice", lambda: raw["vendor_invoice"])     # sums of their own: made once
    # dealt by columns that the line items have, so that a batch joins its own rows only
    dealt_by = {"purchases": ["VendorNumber", "Quantity"], "sales": ["VendorNo", "SalesQuantity"]}
    for batch in range(3):
        if batch == 2:
            state.compact()
        state.apply(f"batch-{batch}", {name: df.where(F.pmod(F.xxhash64(*dealt_by.get(name, df.columns)), F.lit(3)) == batch)
                                       for name, df in raw.items()})
    return state.summary()


@query("freight_summary")
def _freight(ws):
    return summary.freight_summary(ws.raw()["vendor_invoice"])


@query("sales_summary")
def _sales(ws):
    return summary.sales_summary_report(ws.raw()["sales"])


@query("purchase_summary")
def _purchase(ws):
    r = ws.raw()
    return summary.purchase_summary(r["purchases"], r["purchase_prices"])


@query("purchase_summary_standalone")
def _purchase_sa(ws):
    r = ws.raw()
    return summary.purchase_summary_standalone(r["purchases"], r["purchase_prices"])


@query("never_sold")
def _never_sold(ws):
    r = ws.raw()
    return summary.never_sold(r["purchases"], r["sales"])


@query("row_counts")
def _row_counts(ws):
    return summary.row_counts(ws.raw())


@query("preview_purchases")
def _preview(ws):
    return summary.preview(ws.raw()["purchases"], 5)


@query("preview_purchase_prices")
def _preview_prices(ws):
    return summary.preview(ws.raw()["purchase_prices"], 5)


@query("preview_vendor_invoice")
def _preview_invoice(ws):
    return summary.preview(ws.raw()["vendor_invoice"], 5)


@query("preview_sales")
def _preview_sales(ws):
    return summary.preview(ws.raw()["sales"], 5)


# --- cleaning ----------------------------------------------------------------------

@query("clean_summary")
def _clean(ws):
    return ws.clean()


@query("vendor_kpis")
def _kpis(ws):
    return ws.clean().select("VendorNumber", "Brand", "VendorName", "Description",
                             *KPI_COLUMNS)


@query("filter_reliable")
def _reliable(ws):
    return ws.reliable()


@query("clean_metrics")
def _clean_metrics(ws):
    return clean.clean_metrics(ws.summary())


# --- relational reports --------------------------------------------------------------

@query("top10_purchase")
def _top10_purchase(ws):
    return reports.top_vendors_by(ws.summary(), "TotalPurchaseDollars")


@query("top10_freight")
def _top10_freight(ws):
    """Freight summed over brand rows (the vendor's freight repeats per brand)."""
    return reports.top_vendors_by(ws.summary(), "FreightCost")


@query("top_brand_per_vendor")
def _top_brand(ws):
    return reports.top_brand_per_vendor(ws.summary())


@query("top3_brands_per_vendor")
def _top3_brands(ws):
    """The ranked brands of every vendor, down to rank 3."""
    return reports.ranked_brands(ws.summary(), 3)


@query("unsold_gap_top10")
def _unsold(ws):
    return reports.unsold_gap(ws.summary())


@query("vendor_rollup")
def _vendor_rollup(ws):
    return ws.vendors()


@query("distinct_vendors_brands")
def _distinct(ws):
    return reports.distinct_counts(ws.reliable())


@query("distinct_sketches")
def _distinct_sketches(ws):
    """Stored distinct-count sketches of four parts of the rows: whether their union agrees with that
    of another split, and with the exact count, within four standard deviations."""
    rows, names = ws.reliable(), ["VendorName", "Brand"]

    def union(parts):
        dealt = rows.withColumn("part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
        stored = ws.materialize(f"distinct_sketches_{parts}", lambda: sketches.distinct_sketches(dealt, names, ["part"]))
        return sketches.distinct_estimates(sketches.merge_distinct(stored))

    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in names]).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("exact")) for c in names])).alias("e")).select("e.*")
    other = union(7).withColumnRenamed("distinct", "other")
    most = 4 * sketches.distinct_error() * F.col("exact")
    return union(4).join(other, "metric").join(exact, "metric").select(
        "metric", "exact", (F.abs(F.col("distinct") - F.col("other")) <= most).alias("splits_agree"),
        (F.abs(F.col("distinct") - F.col("exact")) <= most).alias("within_error"))


@query("quantile_sketches")
def _quantile_sketches(ws):
    """Stored quantile sketches of four parts of the rows, merged: whether the rank of each
    quantile is within twice the stated error of the wanted one."""
    rows, names, ps = ws.reliable(), ["StockTurnover", "GrossProfit"], [0.05, 0.5, 0.95, 0.98]
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(4)).alias("part")
    stored = ws.materialize("quantile_sketches", lambda: sketches.quantile_sketches(rows.withColumn("part", part), names, ["part"]))
    merged = sketches.sketch_quantiles(sketches.merge_quantiles(stored), ps).collect()     # a row for each metric and p
    error = 2 * sketches.rank_error()

    def kept(r):
        x = F.col(r["metric"])
        below, upto = F.avg((x < r["value"]).cast("double")), F.avg((x <= r["value"]).cast("double"))
        return F.struct(F.lit(r["metric"]).alias("metric"), F.lit(r["p"]).alias("p"), F.lit(r["n"]).alias("n"),
                        ((below - error <= r["p"]) & (upto + error >= r["p"])).alias("within_error"))

    return rows.agg(F.array(*[kept(r) for r in merged]).alias("q")).select(F.explode("q").alias("q")).select("q.*")


@query("vendor_row_counts_top5")
def _value_counts(ws):
    return reports.value_counts(ws.reliable(), "VendorName", 5)


@query("kpi_summary")
def _kpi_summary(ws):
    return reports.column_summary(ws.reliable())


@query("null_profile")
def _null_profile(ws):
    return reports.null_profile(ws.summary())


@query("turnover_quantiles")
def _turnover_q(ws):
    return reports.quantiles(ws.reliable(), "StockTurnover", [0.95, 0.98])


@query("top10_sales")
def _top10_sales(ws):
    return reports.top_vendors_by(ws.reliable(), "TotalSalesDollars", 10, digits=None)


@query("sample_vendor")
def _sample_vendor(ws):
    return reports.first_row(ws.vendors(), ["VendorName"])


@query("turnover_margin_crop")
def _crop(ws):
    return reports.quantile_crop(ws.reliable(), "StockTurnover", "ProfitMargin", 0.98)


# --- statistics ------------------------------------------------------------------------

@query("sales_tier_split")
def _tier_split(ws):
    return stats.sales_tier_split(ws.vendors()).select(
        "VendorName", "TotalSalesDollars", "ProfitMargin", "SalesTier")


@query("welch_ttest")
def _welch(ws):
    return stats.welch_ttest(ws.vendors())


@query("kpi_correlation")
def _corr(ws):
    return stats.correlation_matrix(ws.vendors())


# --- segmentation ----------------------------------------------------------------------

def _seeded(ws):
    """One nearest-centroid step from quantile-band centroids: deterministic, so
    its labels, profile and silhouette can be checked against SQL."""
    vendor = ws.vendors()
    scaled = ws.scaled()
    bands = ws.materialize("seed_bands", lambda: segment.seeded_bands(scaled))
    assigned = ws.materialize("seed_assigned", lambda: segment.assign_nearest(
        bands.drop("Band"), segment.band_centroids(bands)))
    labels = segment.rank_labels(assigned, vendor)
    tiers = segment.attach_tiers(assigned, labels)
    return vendor, scaled, bands, assigned, labels, tiers


@query("cluster_features")
def _features(ws):
    return segment.cluster_features(ws.vendors())


@query("scaled_features")
def _scaled(ws):
    return ws.scaled()


@query("assign_centroids")
def _assign(ws):
    return _seeded(ws)[3].select("VendorName", "Cluster")


@query("tier_labels", digits=2)     # means of money: a 5th digit may sit on a tie
def _tier_labels(ws):
    return _seeded(ws)[4]


@query("tier_profile")
def _tier_profile(ws):
    vendor, *_, tiers = _seeded(ws)
    return segment.tier_profile(tiers, vendor)


@query("silhouette_euclidean")
def _silhouette(ws):
    return segment.silhouette(_seeded(ws)[3])


@query("silhouette_tree")
def _silhouette_tree(ws):
    """The Euclidean silhouette from the tree of balls: whether the exact one is within its error, and the
    error within twice the relative error of the mean distances."""
    points = _seeded(ws)[3]
    found, exact = silhouette_tree.silhouette_tree(points, relative=0.01), segment.silhouette(points)
    off = F.abs(F.col("silhouette") - exact.select("silhouette").scalar())
    return found.select("n", (off <= F.col("error") + 1e-9).alias("within_error"),
                        (F.col("error") <= 0.02).alias("error_kept"))


@query("silhouette_squared")
def _silhouette_squared(ws):
    """The O(n k) silhouette with squared distances, on the same clusters."""
    return segment.silhouette_squared(_seeded(ws)[3])


@query("tier_agreement")
def _agreement(ws):
    _, _, bands, _, _, tiers = _seeded(ws)
    return segment.tier_agreement(tiers, segment.band_tiers(bands))


@query("tier_mismatches")
def _mismatches(ws):
    _, _, bands, _, _, tiers = _seeded(ws)
    return segment.tier_mismatches(tiers, segment.band_tiers(bands))


@query("vendor_tiers")
def _vendor_tiers(ws):
    """KMeans k=3, best of 10 restarts."""
    return ws.tiers()


# --- regression -------------------------------------------------------------------------

@query("margin_drivers")
def _drivers(ws):
    """OLS of ProfitMargin on five operational drivers, two of them collinear: least norm."""
    return regress.margin_drivers(ws.vendors())


@query("margin_predictions")
def _predictions(ws):
    return regress.margin_predictions(ws.vendors())


@query("driver_simple_regression")
def _simple(ws):
    return regress.single_driver_fits(ws.vendors())


# --- exploratory summaries -----------------------------------------------------------------

@query("hist_margin")
def _hist_margin(ws):
    return explore.histogram(ws.reliable(), "ProfitMargin")


@query("hist_log_sales")
def _hist_log_sales(ws):
    return explore.histogram(ws.reliable(), F.log1p("TotalSalesDollars"))


@query("hist_turnover")
def _hist_turnover(ws):
    rel = ws.reliable()
    cap = exact_percentile_value(rel, "StockTurnover", 0.95)
    return explore.histogram(rel, clip_upper("StockTurnover", cap))


@query("kde_margin")
def _kde_margin(ws):
    return explore.kde(ws.reliable(), "ProfitMargin")


@query("kde_log_sales")
def _kde_log_sales(ws):
    return explore.kde(ws.reliable(), F.log1p("TotalSalesDollars"))


@query("kde_turnover")
def _kde_turnover(ws):
    rel = ws.reliable()
    cap = exact_percentile_value(rel, "StockTurnover", 0.95)
    return explore.kde(rel, clip_upper("StockTurnover", cap))


@query("box_gross_profit")
def _box(ws):
    return explore.box_stats(ws.reliable(), "GrossProfit")


# --- product text ---------------------------------------------------------------------------

@query("product_rollup")
def _product_rollup(ws):
    return ws.products()


@query("product_tokens")
def _product_tokens(ws):
    t = text.product_tokens(ws.products())
    return t.select(F.col(f"`{text.NAME}`"), F.array_join("tokens", " ").alias("tokens"),
                    F.size("tokens").alias("n_tokens"))


@query("product_ngrams")
def _product_ngrams(ws):
    t = text.product_terms(ws.products())
    return t.select(F.col(f"`{text.NAME}`"), F.array_join("terms", "|").alias("terms"),
                    F.size("terms").alias("n_terms"))


@query("product_tfidf")
def _product_tfidf(ws):
    return ws.tfidf()[0].select(F.col(f"`{text.NAME}`"), "term", "weight")


def _seeded_text(ws):
    weights, _ = ws.tfidf()
    prod = ws.products()
    return prod, weights, ws.materialize("seeded_text_clusters",
                                         lambda: text.seeded_text_clusters(prod, weights))


@query("text_cluster_summary")
def _text_summary(ws):
    prod, _, clusters = _seeded_text(ws)
    return text.cluster_summary(prod, clusters)


@query("text_cluster_top_terms")
def _text_terms(ws):
    _, weights, clusters = _seeded_text(ws)
    return text.cluster_top_terms(weights, clusters)


@query("text_clusters")
def _text_clusters(ws):
    """TF-IDF + KMeans k=8, best of 10 restarts."""
    return text.kmeans_text_clusters(ws.products(), vocab=ws.tfidf()[1])


@query("embedding_clusters")
def _embedding_clusters(ws):
    """KMeans k=8 on the stored 64-d embeddings, best of 10 restarts."""
    return text.embedding_clusters(testdata.embeddings(ws.spark, ws.sf_dir))



# --- sources, sinks and the report ------------------------------------------------------------

@query("csv_roundtrip")
def _csv_roundtrip(ws):
    """The reliable clean table exported as CSV and read back with its schema."""
    path = scratch_path(ws.spark, ws._tag, "export", f"vendor_sales_summary_clean_csv-{uuid.uuid4().hex[:8]}")
    sinks.write_csv(ws.reliable(), path)
    return files.read_csv(ws.spark, path, schemas.CLEAN_SUMMARY)


@query("csv_latin1_roundtrip")
def _csv_latin1(ws):
    """The product table written and read as an ISO-8859-1 CSV."""
    path = scratch_path(ws.spark, ws._tag, "export", f"products_latin1_csv-{uuid.uuid4().hex[:8]}")
    prod = ws.products().select(F.col(f"`{text.NAME}`"), "Sales", "Profit", "Discount", "Category",
                                F.col("Sub_Category").alias("Sub-Category"))
    sinks.write_csv(prod, path, encoding="ISO-8859-1")
    return files.read_csv(ws.spark, path, schemas.PRODUCTS, encoding="ISO-8859-1")


@query("analysis_report", digits=None)
def _analysis_report(ws):
    """Nested statistics / clustering / regression document (its numbers are checked by report_fields)."""
    return report.analysis_report(ws.vendors(), ws.tiers(), ws.scaled())


@query("report_fields", digits=None)
def _report_fields(ws):
    """Every number of the report as a row; means of money to whole units, as a cent may sit on a tie."""
    fields = report.report_fields(report.analysis_report(ws.vendors(), ws.tiers(), ws.scaled()))
    money = F.col("part").isin("TotalSalesDollars", "GrossProfit")
    return fields.withColumn("value", F.when(money, F.round("value", 0)).otherwise(F.col("value")))
