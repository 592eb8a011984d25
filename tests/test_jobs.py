"""End-to-end jobs on the smallest test data set."""

import json
import os

import pytest

from conftest import SF_SMALL
from marginflow.plans import jobs
from marginflow.sources import testdata

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data absent")


def test_pipeline_end_to_end(spark, tmpdir_path):
    raw = testdata.raw_tables(spark, SF_SMALL)
    summ = jobs.build_summary_job(raw, tmpdir_path)
    assert summ.count() == 1850
    reliable, metrics = jobs.clean_job(summ, tmpdir_path)
    assert metrics["rows_loaded"] == 1850 and metrics["rows_reliable"] == reliable.count()
    out = jobs.stats_ml_job(reliable, tmpdir_path, n_init=3)
    assert out["tiers"].count() == out["vendor"].count() == 10
    lines = [ln for r, _, fs in os.walk(tmpdir_path + "/analysis_results_json") for f in fs
             if f.endswith(".json") for ln in open(os.path.join(r, f)) if ln.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert set(doc) == {"statistics", "clustering", "regression"}
    assert "k=3" in doc["clustering"]["algorithm"]
    assert sum(doc["clustering"]["vendor_counts"].values()) == 10


def test_text_job(spark, tmpdir_path):
    out = jobs.text_job(testdata.products(spark, SF_SMALL), tmpdir_path, k=4, n_init=2)
    n = out["products"].count()
    assert out["clusters"].count() == n
    assert sum(r.n_products for r in out["summary"].collect()) == n


def test_cli_pipeline_from_parquet_paths_with_tier_reference(spark, tmpdir_path, capsys):
    from marginflow.__main__ import main
    raw = testdata.raw_tables(spark, SF_SMALL)
    args = ["build", "--out", tmpdir_path + "/out"]
    for name, df in raw.items():
        df.write.parquet(f"{tmpdir_path}/{name}")
        args += [f"--{name.replace('_', '-')}", f"{tmpdir_path}/{name}"]
    ref = tmpdir_path + "/tiers.csv"
    with open(ref, "w") as f:
        f.write("VendorName,PerformanceTier\nSupplier#000000000,Low Performer\nSupplier#000000001,Mid Performer\n")
    assert main(args + ["--tier-reference", ref], spark=spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["clean_metrics"]["rows_loaded"] == 1850 and out["vendors"] == 10
    assert out["tier_agreement"]["vendors_compared"] == 2


def test_cli_query(spark, capsys):
    from marginflow.__main__ import main
    assert main(["query", "top10_purchase", "--testdata", SF_SMALL, "--show", "3"], spark=spark) == 0
    assert "TotalPurchaseDollars" in capsys.readouterr().out


def test_cli_text_from_latin1_csv(spark, tmpdir_path, capsys):
    from marginflow.__main__ import main
    from marginflow.sources import sinks
    tx = testdata.products(spark, SF_SMALL).drop("_row_order")
    sinks.write_csv(tx.coalesce(1), tmpdir_path + "/tx", encoding="ISO-8859-1")
    assert main(["text", "--out", tmpdir_path + "/out", "--products-csv", tmpdir_path + "/tx"],
                spark=spark) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")]
    assert len(lines) == 8
    assert sum(x["n_products"] for x in lines) == tx.select("Product Name").distinct().count()


def test_text_job_with_stop_words_of_the_callers(spark, tmpdir_path, capsys):
    from marginflow.__main__ import main
    with open(tmpdir_path + "/stop.txt", "w") as f:
        f.write("Anvil\n\nblue\n")
    assert main(["text", "--out", tmpdir_path + "/out", "--testdata", SF_SMALL, "--stop-words", tmpdir_path + "/stop.txt"],
                spark=spark) == 0
    capsys.readouterr()
    terms = {w for r in spark.read.parquet(tmpdir_path + "/out/product_tfidf").select("term").distinct().collect()
             for w in r[0].split()}
    assert terms and not terms & {"anvil", "blue"}


def test_bucketed_summary_joins_without_shuffle(spark, tmpdir_path):
    import contextlib
    import io
    from marginflow.sources import sinks
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        summ = jobs.build_summary_job(testdata.raw_tables(spark, SF_SMALL), tmpdir_path, buckets=8)
        assert summ.count() == 1850
        other = summ.select("VendorNumber", "Brand", "TotalPurchaseDollars")
        sinks.write_table(other, "mf_lookup", path=tmpdir_path + "/lookup",
                          bucket_by=["VendorNumber", "Brand"], num_buckets=8)
        j = summ.join(spark.table("mf_lookup").withColumnRenamed("TotalPurchaseDollars", "t2"),
                      ["VendorNumber", "Brand"])
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        assert "Exchange" not in buf.getvalue()
        assert j.count() == 1850
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql("DROP TABLE IF EXISTS mf_lookup")
        spark.sql("DROP TABLE IF EXISTS vendor_sales_summary")


def test_row_order_follows_file_names(spark, tmpdir_path):
    import pathlib
    head = "Product Name,Sales,Profit,Discount,Category,Sub-Category\n"
    d = pathlib.Path(tmpdir_path) / "tx"
    d.mkdir()
    (d / "a.csv").write_text(head + "x,1,1,0,first,f\n")                      # smaller, but first by name
    (d / "b.csv").write_text(head + "".join(f"x,{i},1,0,later,l\n" for i in range(500)))
    from marginflow.operators import text
    rows = jobs.read_products_csv(spark, str(d))
    assert rows.count() == 501 and text.product_rollup(rows).first().Category == "first"


def test_rewritten_data_is_not_answered_from_old_stages(spark, tmpdir_path):
    from marginflow.plans.catalog import QUERIES
    sf = tmpdir_path + "/sf"
    os.mkdir(sf)
    for name in testdata.BASE_TABLES:
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    n = QUERIES["vendor_rollup"](spark, sf).count()
    spark.read.parquet(f"{SF_SMALL}/supplier.parquet").where("s_suppkey < 4").write.mode("overwrite").parquet(
        f"{sf}/supplier.parquet")
    assert 0 < QUERIES["vendor_rollup"](spark, sf).count() < n
