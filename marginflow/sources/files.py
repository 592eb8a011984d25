"""File sources: CSV (with header, optional latin-1), Parquet, stored tier reference.

Schemas are always explicit; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marginflow.session import written
from marginflow.sources.schemas import TIER_REFERENCE


def read_csv(spark: SparkSession, path: str, schema: StructType,
             encoding: str | None = None) -> DataFrame:
    r = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    if encoding:
        r = r.option("encoding", encoding)
    return r.csv(path)


#: What decoding puts in the place of bytes that the encoding does not know.
_UNREADABLE = "\ufffd"


def read_csv_quarantined(spark: SparkSession, path: str, schema: StructType,
                         encoding: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad): the rows that fit the schema, and apart those that do not, as
    (file, line, reason).

    The files are parsed once and the outcome is written to the shared folder, so both
    parts are of one reading and their counts add up to the rows of the files. A row is bad
    if it has more or fewer fields than the schema, a value that its column's type does
    not take, or text that the encoding cannot be (``reason`` names the first such column)."""
    raw = "_corrupt_record"
    r = (spark.read.schema(StructType([*schema.fields, StructField(raw, StringType())])).option("header", True)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", raw))
    if encoding:
        r = r.option("encoding", encoding)
    columns = [F.col(f"`{f.name}`") for f in schema.fields]
    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]
    unreadable = F.coalesce(*[F.when(F.contains(F.col(f"`{c}`"), F.lit(_UNREADABLE)), F.lit(f"{c}: not in the encoding")) for c in texts],
                            F.lit(None).cast("string"))
    rows = written(r.csv(path).select(*columns, raw, unreadable.alias("_unreadable"),
                                      F.col("_metadata.file_path").alias("_file")), "csv-rows")

    good = rows.where(F.col(raw).isNull() & F.col("_unreadable").isNull()).select(*columns)
    # a bad line is read again as text, one column too many, to tell what is wrong with it
    wide = ", ".join(f"f{i} STRING" for i in range(len(schema.fields) + 1))
    parsed = F.from_csv(F.col(raw), F.lit(wide), {"mode": "PERMISSIVE"})
    n = len(schema.fields)
    checks = [F.when(F.col(f"_t.f{n}").isNotNull(), F.lit("too many fields"))]
    for i, f in enumerate(schema.fields):
        text = F.col(f"_t.f{i}")
        checks.append(F.when(text.isNotNull() & text.try_cast(f.dataType).isNull(),
                             F.concat(F.lit(f"{f.name}: not {f.dataType.simpleString()}: "), text)))
    checks.append(F.when(F.col(f"_t.f{n - 1}").isNull(), F.lit("too few fields")))
    checks.append(F.lit("not readable as a row"))
    line = F.coalesce(F.col(raw), F.concat_ws(",", *[c.cast("string") for c in columns]))
    bad = (rows.where(F.col(raw).isNotNull() | F.col("_unreadable").isNotNull())
           .select(F.col("_file").alias("file"), line.alias("line"), raw, "_unreadable", parsed.alias("_t"))
           .select("file", "line", F.coalesce(F.when(F.col(raw).isNull(), F.col("_unreadable")), *checks).alias("reason")))
    return good, bad


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_tier_reference(spark: SparkSession, path: str) -> DataFrame:
    """Stored (VendorName, PerformanceTier) file to cross-check tiers against."""
    return read_csv(spark, path, TIER_REFERENCE)
