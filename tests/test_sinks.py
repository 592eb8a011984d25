"""Sources and sinks: CSV round trips, replace-writes, bucketed layout, JSON report."""

import contextlib
import io
import json

from pyspark.sql import functions as F

from marginflow.sources import files, schemas, sinks


def test_csv_roundtrip_latin1(spark, tmpdir_path):
    df = spark.createDataFrame([("Café crème", 1.5, 0.5, 0.1, "Cat", "Sub")], schemas.PRODUCTS)
    sinks.write_csv(df, tmpdir_path + "/p", encoding="ISO-8859-1")
    raw = b"".join(open(p, "rb").read() for p in __import__("glob").glob(tmpdir_path + "/p/*.csv"))
    assert "Café".encode("latin-1") in raw
    back = files.read_csv(spark, tmpdir_path + "/p", schemas.PRODUCTS, encoding="ISO-8859-1")
    assert back.collect() == df.collect()


def test_replace_write_and_bucketed_join_has_no_shuffle(spark, tmpdir_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(1000).select((F.col("id") % 50).alias("VendorNumber"), (F.col("id") % 7).alias("Brand"),
                                     F.col("id").cast("double").alias("v"))
        for name in ("mf_a", "mf_b"):
            sinks.write_table(a, name, path=f"{tmpdir_path}/{name}", bucket_by=["VendorNumber", "Brand"],
                              num_buckets=8, sort_by=["VendorNumber", "Brand"])
        sinks.write_table(a, "mf_a", path=f"{tmpdir_path}/mf_a", bucket_by=["VendorNumber", "Brand"],
                          num_buckets=8)                     # replace, not append
        assert spark.table("mf_a").count() == 1000
        j = spark.table("mf_a").join(spark.table("mf_b"), ["VendorNumber", "Brand"])
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        assert "Exchange" not in buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS mf_a")
        spark.sql("DROP TABLE IF EXISTS mf_b")


def test_json_report_sink(spark, tmpdir_path):
    from marginflow.operators.report import report_json
    df = spark.range(1).select(F.struct(F.lit(1).alias("a"), F.create_map(F.lit("k"), F.lit(2.0)).alias("m"))
                               .alias("report"))
    sinks.write_json(df, tmpdir_path + "/j")
    assert json.loads(report_json(df).first()[0]) == {"a": 1, "m": {"k": 2.0}}
