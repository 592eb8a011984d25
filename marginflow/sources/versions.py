"""Tables that are replaced without ever being absent.

A table is a folder of versions and a pointer file that names the current one. A
replace-write goes to a new version folder; only when that is complete is the pointer
swapped, by one rename over the old pointer. A job that fails midway leaves the old
version current and a folder that nothing points to; a reader that has begun keeps the
files of its version, of which the last few are kept.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

POINTER = "_CURRENT"
#: Versions that stay readable, the current one included.
KEEP = 2


def _files(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, where = _files(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file apart and renames it over the old one, in one step."""
    sc = spark.sparkContext
    jvm = sc._jvm
    apart = f"{path}-{uuid.uuid4().hex}"
    fs, where = _files(spark, apart)
    stream = fs.create(where, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(path)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), sc._jsc.hadoopConfiguration()).rename(where, target, how)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version; None if the table was never written."""
    name = read_text(spark, f"{path}/{POINTER}")
    return None if name is None else f"{path}/{name}"


def replace_table(df: DataFrame, path: str, keep: int = KEEP) -> str:
    """Writes ``df`` as the table's next version and makes it current. Returns its folder.

    ``df`` may read the table itself. Versions beyond the last ``keep`` are deleted, with what failed
    writes left before them."""
    spark = df.sparkSession
    name = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{name}")
    replace_text(spark, f"{path}/{POINTER}", name)
    drop_older(spark, path, name, keep)
    return f"{path}/{name}"


def drop_older(spark: SparkSession, path: str, current: str, keep: int = KEEP) -> None:
    """Deletes the folders before ``current`` but the last ``keep`` - 1 complete ones."""
    fs, where = _files(spark, path)
    older = sorted(f.getPath().getName() for f in fs.listStatus(where) if f.isDirectory() and f.getPath().getName() < current)
    complete = [v for v in older if fs.exists(_files(spark, f"{path}/{v}/_SUCCESS")[1])]
    for version in set(older) - set(complete[len(complete) - (keep - 1):]):
        fs.delete(_files(spark, f"{path}/{version}")[1], True)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The current version of a table."""
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(folder)
