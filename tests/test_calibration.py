"""Check values of FIXTURES.md part 2 at sf0.01."""

import pytest
from pyspark.sql import functions as F

from vaultline.config import SOURCE
from vaultline.operators import kpi, scd, scores
from vaultline.plans import catalog as C
from vaultline.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


def _dist(df, col):
    return {r[col]: r["count"] for r in kpi.class_distribution(df, col).collect()}


@pytest.fixture(scope="module")
def fact(spark):
    return C.fact_fraud(spark, SF)


def test_transactions_and_cleaning(spark):
    raw = fx.transactions_raw(spark, SF)
    assert fx.transactions(spark, SF).count() == 10000
    assert C.clean_raw(spark, SF).count() == 9624
    assert raw.filter(F.col("location").isNull()).count() == 94


def test_fraud_classes_and_kpi_rows(fact):
    assert _dist(fact, "fraud_risk_category") == {"Low": 3150, "Medium": 5930, "High": 920}
    assert kpi.kpi_daily_fraud(fact).count() == 90


def test_credit_classes(spark):
    cust = fx.customers(spark, SF)
    plain = scores.build_fact_credit(fx.credit(spark, SF), cust, SOURCE)
    assert _dist(plain, "credit_risk_category") == {"Low": 444, "Medium": 916, "High": 140}
    nulls = scores.build_fact_credit(fx.credit_nulls(spark, SF), cust, SOURCE)
    assert _dist(nulls, "credit_risk_category") == {"Low": 436, "Medium": 883, "High": 134, "Unknown": 47}


def test_churn_on_accounts(spark):
    assert _dist(kpi.churn_risk(fx.accounts(spark, SF)), "churn_risk") == {"Churned": 4933, "High": 5088, "Low": 4979}


def test_scd_counts(spark):
    row = scd.scd2_totals(C.scd2_batch2(spark, SF)).first()
    assert (row.total, row.current, row.expired) == (1725, 1530, 195)
    new_keys = C.scd2_batch2(spark, SF).filter(F.col("customer_id") >= 1000000).count()
    assert new_keys == 30
    only = scd.scd2_totals(C.scd2_batch2(spark, SF, insert_new_keys=False)).first()
    assert (only.total, only.current, only.expired) == (1695, 1500, 195)
    assert fx.accounts_b1(spark, SF).count() == 13500
    assert fx.accounts_b2(spark, SF).count() == 5250
    assert scd.dedupe(fx.accounts_b2(spark, SF), ["account_id"], ["load_seq"]).count() == 4500
    assert _dist(C.silver_accounts(spark, SF), "status") == {"Active": 3493, "Closed": 7155, "Dormant": 4352}
