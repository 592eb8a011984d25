"""Every registered query against its DuckDB oracle (row count, columns, values).

Runs at sf0.001 by default; set ORACLE_SF_DIR (e.g. /root/testdata/sf0.01, the
driver's scale) to check another data set."""

import os

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from harness import compare, duck
from marginflow.plans.catalog import QUERIES as CATALOG

SF_SMALL = os.environ.get("ORACLE_SF_DIR", SF_SMALL)

# the queries of the training-data subpackage have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k in CATALOG}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in CATALOG}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    assert compare(spark, QUERIES[name], ORACLE[name], SF_SMALL, con) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 1


def test_every_query_has_a_docstring_or_oracle():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 55


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["VendorNumber", "VendorName", "Brand"]
    assert df.count() > 0
