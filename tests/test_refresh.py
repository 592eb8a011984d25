"""Incremental summary refresh: any split into batches gives the full build's rows."""

import json
import os

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from marginflow.operators import refresh, summary
from marginflow.sources import schemas, testdata
from marginflow.sources.versions import replace_text
from test_summary import raw  # noqa: F401


def rows_of(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def names(raw):  # noqa: F811
    return dict(zip(("purchases", "purchase_prices", "vendor_invoice", "sales"), raw))


@settings(max_examples=5, deadline=None)
@given(st.integers(1, 4), st.integers(0, 10_000))
def test_any_split_gives_the_full_build(spark, raw, tmp_path_factory, batches, seed):  # noqa: F811
    state = refresh.SummaryState(spark, str(tmp_path_factory.mktemp("state")))
    numbered = {k: df.withColumn("_b", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(batches)))
                for k, df in names(raw).items()}
    for b in range(batches):
        assert state.apply(f"b{b}", {k: df.where(F.col("_b") == b).drop("_b") for k, df in numbered.items()})
    assert rows_of(state.summary()) == rows_of(summary.vendor_sales_summary(*raw))
    state.compact()
    assert len(state._manifest()["folders"]) == 1 and len(state.batches()) == batches
    assert rows_of(state.summary()) == rows_of(summary.vendor_sales_summary(*raw))


def test_a_batch_counts_once_and_a_failed_one_not_at_all(spark, raw, tmpdir_path):  # noqa: F811
    state, full = refresh.SummaryState(spark, tmpdir_path), rows_of(summary.vendor_sales_summary(*raw))
    assert state.apply("all", names(raw)) and not state.apply("all", names(raw))
    bad = names(raw) | {"sales": raw[3].withColumn("SalesQuantity", F.raise_error(F.lit("lost")).cast("long"))}
    with pytest.raises(Exception, match="lost"):
        state.apply("more", bad)
    assert state.batches() == ["all"] and rows_of(state.summary()) == full
    replace_text(spark, f"{tmpdir_path}/else.txt", "1")
    replace_text(spark, f"{tmpdir_path}/else.txt", "2")
    assert open(f"{tmpdir_path}/else.txt").read() == "2"


def test_null_sums_and_missing_tables(spark, raw, tmpdir_path):  # noqa: F811
    state = refresh.SummaryState(spark, tmpdir_path)
    with pytest.raises(LookupError):
        state.summary()
    parts = names(raw)
    state.apply("1", {k: parts[k] for k in ("purchases", "purchase_prices")})
    state.apply("2", {k: parts[k] for k in ("vendor_invoice", "sales")})
    state.apply("3", {"sales": spark.createDataFrame([(2, 20, None, None, None, None)], schemas.SALES)})
    assert rows_of(state.summary()) == rows_of(summary.vendor_sales_summary(*raw))


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data absent")
def test_cli_refresh(spark, tmpdir_path, capsys):
    from marginflow.__main__ import main
    for name, df in testdata.raw_tables(spark, SF_SMALL).items():
        df.write.parquet(f"{tmpdir_path}/{name}")
    path = lambda n: f"{tmpdir_path}/{n}"
    first = ["--purchases", path("purchases"), "--purchase-prices", path("purchase_prices"),
             "--vendor-invoice", path("vendor_invoice"), "--sales", path("sales")]
    out = ["refresh", "--out", path("out")]
    try:
        for batch, args in (("a", first), ("a", first), ("b", ["--sales", path("sales")])):
            assert main([*out, "--batch", batch, *args], spark=spark) == 0
            assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"batch": batch, "rows": 1850}
        once = summary.vendor_sales_summary(*testdata.raw_tables(spark, SF_SMALL).values())
        got = spark.table("vendor_sales_summary").agg(F.sum("TotalSalesQuantity")).first()[0]
        assert got == 2 * once.agg(F.sum("TotalSalesQuantity")).first()[0]
    finally:
        spark.sql("DROP TABLE IF EXISTS vendor_sales_summary")


def test_stored_sums_are_dealt_by_brand_once(spark, raw, tmpdir_path):  # noqa: F811
    """Purchase sums of several batches meet sales and prices where they were added up."""
    from test_plans import plan_of
    state = refresh.SummaryState(spark, tmpdir_path)
    state.apply("1", names(raw))
    state.apply("2", names(raw))
    plan = plan_of(state.summary())
    assert "hashpartitioning(Brand" in plan and "Arguments: hashpartitioning(VendorNumber#" in plan
    pairs = [x for x in plan.split("Arguments: hashpartitioning(")[1:] if "VendorNumber" in x.split(")")[0] and "Brand" in x.split(")")[0]]
    assert not pairs
