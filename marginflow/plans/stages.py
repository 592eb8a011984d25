"""Materialize-once workspace over one data directory.

The summary is the base of every later stage, so it is built once and written
as Parquet into the session's shared checkpoint folder (the CTAS of the
original); the reliable clean frame and the vendor rollup are written the same
way. Later stages read these tables, which keeps column pruning and filter
pushdown (a ``checkpoint()`` RDD would lose both) and cuts the lineage, so a
lost executor only re-runs the current stage.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from marginflow.operators import clean, rollup, segment, summary, text
from marginflow.session import scratch_path
from marginflow.sources import testdata

_WORKSPACES: dict[tuple, "Workspace"] = {}
_LOCK = threading.Lock()


def workspace(spark: SparkSession, sf_dir: str) -> "Workspace":
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), _state(spark, sf_dir))
    with _LOCK:
        ws = _WORKSPACES.get(key)
        if ws is None:
            ws = _WORKSPACES[key] = Workspace(spark, sf_dir)
    return ws


def _state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input files: rewritten data get a workspace of their own."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = root.getFileSystem(sc._jsc.hadoopConfiguration())
    seen = []
    for table in testdata.BASE_TABLES:
        path = sc._jvm.org.apache.hadoop.fs.Path(root, f"{table}.parquet")
        if files.exists(path):
            seen += [f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in files.listStatus(path)]
    return hashlib.sha1("\n".join(seen).encode()).hexdigest()


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tag = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:10]
        self._written: dict[str, str] = {}
        self._lock = threading.Lock()
        self._stages: dict[str, threading.RLock] = {}

    # -- raw inputs (lazy views) -------------------------------------------
    def raw(self) -> dict[str, DataFrame]:
        return testdata.raw_tables(self.spark, self.sf_dir)

    # -- stages --------------------------------------------------------------
    def summary_plan(self) -> DataFrame:
        r = self.raw()
        return summary.vendor_sales_summary(r["purchases"], r["purchase_prices"],
                                            r["vendor_invoice"], r["sales"])

    def materialize(self, name: str, build) -> DataFrame:
        """The stage's table, written by the first caller; others wait for that stage only."""
        with self._lock:
            stage = self._stages.setdefault(name, threading.RLock())
        with stage:
            path = self._written.get(name)
            if path is None:
                path = scratch_path(self.spark, self._tag, uuid.uuid4().hex[:8], name)
                build().write.parquet(path)
                self._written[name] = path
        return self.spark.read.parquet(path)

    def summary(self) -> DataFrame:
        return self.materialize("vendor_sales_summary", self.summary_plan)

    def clean(self) -> DataFrame:
        """All cleaned rows with KPIs (narrow over the written summary)."""
        return clean.clean_summary(self.summary())

    def reliable(self) -> DataFrame:
        return self.materialize("vendor_sales_summary_clean",
                                lambda: clean.filter_reliable(self.clean()))

    def vendors(self) -> DataFrame:
        return self.materialize("vendor_frame",
                                lambda: rollup.vendor_level_aggregate(self.reliable()))

    def features(self) -> DataFrame:
        return self.materialize("cluster_features",
                                lambda: segment.cluster_features(self.vendors()))

    def scaled(self) -> DataFrame:
        return self.materialize("scaled_features",
                                lambda: segment.standardize(self.features()))

    def products(self) -> DataFrame:
        """Per-product rollup of the transaction table (the text stage's documents)."""
        return self.materialize("product_rollup", lambda: text.product_rollup(
            testdata.products(self.spark, self.sf_dir)))

    def tfidf(self) -> tuple[DataFrame, DataFrame]:
        """TF-IDF weights over the written vocabulary (computed once, then reused)."""
        vocab = self.materialize("product_vocab", lambda: text.vocabulary(self.products()))
        weights = self.materialize("product_tfidf",
                                   lambda: text.tfidf_weights(self.products(), vocab))
        return weights, vocab

    def tiers(self) -> DataFrame:
        """KMeans tiers (best of 10 restarts), written once: the fits are the cost."""
        return self.materialize("vendor_tiers", lambda: segment.kmeans_tiers(
            self.vendors(), features=self.features(), scaled=self.scaled()))
