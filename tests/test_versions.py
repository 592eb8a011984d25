"""Replace-writes: what a failed job leaves, and what readers see."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from marginflow.sources import sinks, versions


def failing(spark):
    return spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_versions_swap_and_survive_a_failed_write(spark, tmpdir_path):
    path = tmpdir_path + "/t"
    with pytest.raises(FileNotFoundError):
        versions.read_table(spark, path)
    versions.replace_table(spark.range(3), path)
    began = versions.read_table(spark, path)
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(failing(spark), path)
    assert ids(versions.read_table(spark, path)) == [0, 1, 2]
    versions.replace_table(versions.read_table(spark, path).select((F.col("id") + 10).alias("id")), path)   # from itself
    assert ids(versions.read_table(spark, path)) == [10, 11, 12]
    assert ids(began) == [0, 1, 2]                                # a reader that had begun
    for i in range(4):
        versions.replace_table(spark.range(i), path)
    assert ids(versions.read_table(spark, path)) == [0, 1, 2] and len(glob.glob(path + "/v*")) == versions.KEEP


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_folders_are_replaced_when_complete(spark, tmpdir_path, kind):
    write = {"parquet": sinks.write_parquet, "csv": sinks.write_csv, "json": sinks.write_json}[kind]
    read = {"parquet": spark.read.parquet, "csv": lambda p: spark.read.schema("id long").option("header", True).csv(p),
            "json": lambda p: spark.read.schema("id long").json(p)}[kind]
    path = tmpdir_path + "/x"
    write(spark.range(3), path)
    with pytest.raises(Exception, match="lost"):
        write(failing(spark), path)
    assert ids(read(path)) == [0, 1, 2]
    write(spark.range(5, 7), path)
    assert ids(read(path)) == [5, 6]
    assert not glob.glob(path + "-old-*")
    write(spark.range(1), path, mode="append")
    assert ids(read(path)) == [0, 5, 6]


@pytest.mark.parametrize("buckets", [None, ["id"]])
def test_catalog_tables_are_moved_when_complete(spark, tmpdir_path, buckets):
    name, path = "mf_versions", tmpdir_path + "/t"
    kw = {"path": path, "bucket_by": buckets, "num_buckets": 4}
    try:
        sinks.write_table(spark.range(3), name, **kw)
        with pytest.raises(Exception, match="lost"):
            sinks.write_table(failing(spark), name, **kw)
        assert ids(spark.table(name)) == [0, 1, 2]
        sinks.write_table(spark.table(name).select((F.col("id") + 1).alias("id")), name, **kw)
        assert ids(spark.table(name)) == [1, 2, 3]
        assert len(os.listdir(path)) <= sinks.KEEP
        sinks.write_table(spark.range(2).selectExpr("id", "'a' AS more"), name, **kw)             # other columns
        assert spark.table(name).columns == ["id", "more"] and ids(spark.table(name)) == [0, 1]
        sinks.write_table(spark.range(5), name + "_managed")
        sinks.write_table(spark.range(6), name + "_managed")
        assert spark.table(name + "_managed").count() == 6
    finally:
        for t in spark.catalog.listTables():
            if t.name.startswith(name):
                spark.sql(f"DROP TABLE {t.name}")
