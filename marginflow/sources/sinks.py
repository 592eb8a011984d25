"""Sinks: replace-writes of tables, clustered (bucketed) layout, CSV and JSON exports.

All writes are distributed (one file per task); nothing is gathered on the
driver. ``write_table`` is the CTAS / ``to_sql(if_exists="replace")`` of the
original; ``bucketBy`` on (VendorNumber, Brand) replaces its index, so later
joins and aggregations on those keys read co-partitioned buckets with no
shuffle.

A replace-write never begins by deleting: the new rows are written apart and take the
old ones' place when they are complete, so a job that fails midway leaves the old
rows. A catalog table is moved to its new folder by its location, in one step; a plain
folder by two renames. Readers that cannot bear the moment between these use
``versions``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.readwriter import DataFrameWriter

from marginflow.sources.versions import drop_older

#: Folders of a catalog table that are kept: the current one and the one before, for readers that have begun.
KEEP = 2


def _hadoop(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def write_table(df: DataFrame, name: str, path: str | None = None,
                bucket_by: Sequence[str] | None = None, num_buckets: int = 64,
                sort_by: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Writes the catalog table ``name``, under ``path`` if given (else the warehouse's)."""
    spark = df.sparkSession

    def write(table: str, folder: str | None, how: str) -> None:
        w = df.write.mode(how).format("parquet")
        if folder:
            w = w.option("path", folder)
        if bucket_by:
            w = w.bucketBy(num_buckets, *bucket_by)
            if sort_by:
                w = w.sortBy(*sort_by)
        w.saveAsTable(table)

    if mode != "overwrite":
        return write(name, path, mode)
    staged = f"{name}_staged_{uuid.uuid4().hex[:12]}"
    version = f"v{time.time_ns():020d}"
    folder = f"{path}/{version}" if path else None
    write(staged, folder, "errorifexists")
    if folder and spark.catalog.tableExists(name) and _layout(spark, name) == _layout(spark, staged):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"DROP TABLE {staged}")                        # external: its files stay
        spark.catalog.refreshTable(name)
    else:                                                        # new, or of other columns or buckets
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    if folder:
        drop_older(spark, path, version, KEEP)


def _layout(spark: SparkSession, name: str) -> tuple:
    """A table's columns and buckets, by which a folder of one table fits another."""
    keep = ("Num Buckets", "Bucket Columns", "Sort Columns", "Provider")
    spec = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    return spark.table(name).schema.simpleString(), tuple(spec.get(k) for k in keep)


def _replace(df: DataFrame, path: str, mode: str, write: Callable[[DataFrameWriter, str], None]) -> None:
    if mode != "overwrite":
        return write(df.write.mode(mode), path)
    apart, before = (f"{path.rstrip('/')}-{what}-{uuid.uuid4().hex[:12]}" for what in ("new", "old"))
    write(df.write, apart)
    fs, target = _hadoop(df.sparkSession, path)
    new, old = (_hadoop(df.sparkSession, p)[1] for p in (apart, before))
    if fs.exists(target):
        fs.rename(target, old)
    if not fs.rename(new, target):
        raise OSError(f"{apart} is complete, but could not be renamed to {path}")
    if fs.exists(old):
        fs.delete(old, True)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    _replace(df, path, mode, lambda w, p: w.parquet(p))


def write_csv(df: DataFrame, path: str, encoding: str | None = None, mode: str = "overwrite") -> None:
    options = {"header": True} | ({"encoding": encoding} if encoding else {})
    _replace(df, path, mode, lambda w, p: w.options(**options).csv(p))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    _replace(df, path, mode, lambda w, p: w.json(p))
