"""Plan shape guards for every registered query (scale properties, not values)."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from marginflow.plans.catalog import QUERIES as CATALOG

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data absent")
QUERIES = {k: v for k, v in E.queries().items() if k in CATALOG}
PYTHON_ALLOWED = {"silhouette_euclidean", "silhouette_tree", "analysis_report", "report_fields"}  # NumPy block kernel (cogroup)


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_or_row_udfs(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan                     # no row-at-a-time Python UDFs
    if name not in PYTHON_ALLOWED:
        assert "ArrowEvalPython" not in plan and "FlatMapCoGroupsInPandas" not in plan


@pytest.mark.parametrize("name", ["hist_margin", "hist_log_sales", "hist_turnover",
                                  "kde_margin", "kde_log_sales", "kde_turnover"])
def test_distribution_summaries_are_one_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    assert len(re.findall(r"\bExchange \(", plan)) == 1


def test_vendor_rollup_moves_two_columns_at_brand_grain(spark):
    from marginflow.operators import rollup
    from marginflow.plans.stages import workspace
    plan = plan_of(rollup.vendor_level_aggregate(workspace(spark, SF_SMALL).reliable()))
    by_brand = [x for x in re.findall(r"Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\((.*?)\)", plan)
                if "Brand" in x[1]]
    assert by_brand and all(cols.count(",") == 1 for cols, _ in by_brand)


def test_product_rollup_sorts_no_raw_rows(spark):
    from marginflow.operators import text
    from marginflow.sources import testdata
    plan = plan_of(text.product_rollup(testdata.products(spark, SF_SMALL)))
    nodes = re.findall(r"^[+\-:* ]*(\w+)", plan, re.M)
    first_aggregate = re.findall(r"\(\d+\) (\w*Aggregate)", plan)[0]
    assert first_aggregate == "HashAggregate" and nodes
