"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from vaultline.plans.catalog import QUERIES
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, sorted(QUERIES), duck(SF))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(results, name):
    rec = results[name]
    assert rec.get("status") == "OK", rec


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 1000
    assert "fraud_risk_category" in df.columns
