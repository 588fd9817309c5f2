"""Hand-written edge rows (FIXTURES.md part 3)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.config import SOURCE, RiskConfig
from vaultline.operators import kpi, scores
from vaultline.operators import transactions as tx

TS = T.TimestampNTZType()


def _txn(spark, rows):
    schema = T.StructType(
        [
            T.StructField("transaction_id", T.StringType()),
            T.StructField("account_id", T.StringType()),
            T.StructField("txn_timestamp", TS),
        ]
    )
    return spark.createDataFrame(rows, schema)


def _at(sec):
    return dt.datetime(2026, 1, 1) + dt.timedelta(seconds=sec)


def test_rolling_frame_ends_inclusive_and_null_id(spark):
    rows = [("a", "A", _at(0)), ("b", "A", _at(300)), (None, "A", _at(300)), ("c", "A", _at(301)), ("d", "A", _at(301))]
    out = tx.txn_window_count(_txn(spark, rows), SOURCE).orderBy("txn_timestamp", "transaction_id")
    counts = [r[tx.WINDOW_COUNT] for r in out.collect()]
    # NULL id sorts first among its peers; frame [t-300, t] both ends in
    assert sorted(counts) == [1, 2, 2, 3, 3]


def test_rolling_null_time_modes(spark):
    rows = [("a", "A", None), ("b", "A", None), ("c", "A", _at(10))]
    default = {r.transaction_id: r[tx.WINDOW_COUNT] for r in tx.txn_window_count(_txn(spark, rows), SOURCE).collect()}
    assert default == {"a": None, "b": None, "c": 1}
    parity = RiskConfig(null_peers=True)
    p = {r.transaction_id: r[tx.WINDOW_COUNT] for r in tx.txn_window_count(_txn(spark, rows), parity).collect()}
    assert p == {"a": 2, "b": 2, "c": 1}


def test_rapid_limit(spark):
    rows = [(str(i), "A", _at(i * 60)) for i in range(4)]
    out = tx.rapid_flag(_txn(spark, rows), SOURCE).orderBy("txn_timestamp").collect()
    assert [r[tx.WINDOW_COUNT] for r in out] == [1, 2, 3, 4]
    assert [r.rapid_txn_flag for r in out] == [0, 0, 0, 1]


def test_amount_limits_and_cleaning(spark):
    df = spark.createDataFrame(
        [("1", 50000.0), ("2", 50000.01), ("3", 0.0), ("4", -1.0), ("5", None), (None, 10.0)],
        "transaction_id string, amount double",
    )
    kept = tx.clean_transactions(df).transform(tx.high_amount_flag, 50000.0)
    got = {r.transaction_id: r.high_amount_flag for r in kept.collect()}
    assert got == {"1": 0, "2": 1}


def test_timestamp_text(spark):
    df = spark.createDataFrame(
        [("2026-01-01T10:00:00",), ("2026-01-01 10:00:00",), ("garbage",), (None,)], "timestamp string"
    )
    out = tx.add_time_parts(df).collect()
    assert [r.txn_timestamp for r in out] == [dt.datetime(2026, 1, 1, 10), dt.datetime(2026, 1, 1, 10), None, None]
    assert [r.transaction_hour for r in out][:2] == [10, 10]
    assert out[0].txn_date == dt.date(2026, 1, 1)


def test_location_country_both_forms(spark):
    df = spark.createDataFrame([("Mumbai",), ("London",), ("Paris",), (None,)], "location string")
    lit_form = [r.txn_country for r in tx.txn_country(df).orderBy("location").collect()]
    mapping = spark.createDataFrame([("Mumbai", "India"), ("London", "UK")], "location string, country string")
    join_form = [r.txn_country for r in tx.txn_country(df, mapping).orderBy("location").collect()]
    assert lit_form == join_form == ["Unknown", "UK", "India", "Unknown"]


def test_geo_mismatch(spark):
    df = spark.createDataFrame(
        [(1, "India", "India"), (2, "UK", "India"), (3, "Unknown", "India"), (4, "UK", None)],
        "i int, txn_country string, home_country string",
    )
    got = [r.geo_mismatch_flag for r in tx.geo_mismatch_flag(df).orderBy("i").collect()]
    assert got == [0, 1, 0, 0]


def test_fraud_class(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.4,), (0.6,), (0.7,), (1.0,), (None,)], "fraud_score double")
    got = [r.fraud_risk_category for r in scores.fraud_class(df, SOURCE).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "High", "High", "High"]


def test_fraud_score_values(spark):
    flags = [(h, g, r) for h in (0, 1) for g in (0, 1) for r in (0, 1)]
    df = spark.createDataFrame(flags, "high_amount_flag int, geo_mismatch_flag int, rapid_txn_flag int")
    got = sorted({r.fraud_score for r in scores.fraud_score(df, SOURCE).collect()})
    assert got == [0.0, 0.3, 0.4, 0.6, 0.7, 1.0]


def test_credit_class(spark):
    df = spark.createDataFrame([(0.29,), (0.3,), (0.59,), (0.6,), (None,)], "credit_risk_score double")
    got = [r.credit_risk_category for r in scores.credit_class(df, SOURCE).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "Unknown"]


def test_loans_norm(spark):
    df = spark.createDataFrame([(0,), (5,), (10,), (11,), (None,)], "open_loans int")
    got = [r.open_loans_norm for r in scores.open_loans_norm(df, 10.0).collect()]
    assert got == [0.0, 0.5, 1.0, 1.0, None]


def test_credit_score_above_max(spark):
    df = spark.createDataFrame([(950, 0.0, 0)], "credit_score int, open_loans_norm double, recent_defaults int")
    assert scores.credit_risk_score(df, SOURCE).first().credit_risk_score == -0.03


def test_churn_status(spark):
    df = spark.createDataFrame([("Closed",), ("Dormant",), ("Active",), ("closed",), (None,)], "status string")
    got = [r.churn_risk for r in kpi.churn_risk(df).collect()]
    assert got == ["Churned", "High", "Low", "Low", "Low"]


def test_metadata_absent_or_partial(spark):
    plain = spark.createDataFrame([("1",)], "transaction_id string")
    assert tx.flatten_struct(plain).columns == ["transaction_id"]
    partial = spark.createDataFrame([("1", ("d1", "1.2.3.4"))], "transaction_id string, metadata struct<device:string,ip_address:string>")
    row = tx.flatten_struct(partial).first()
    assert (row.device, row.ip_address, row.channel) == ("d1", "1.2.3.4", None)
    assert "metadata" not in tx.flatten_struct(partial).columns


def test_alert_tie_break(spark):
    df = spark.createDataFrame(
        [("t1", "B", 10.0, 1.0, "High"), ("t2", "A", 10.0, 1.0, "High"), ("t3", "C", 20.0, 1.0, "High"),
         ("t4", "D", 5.0, 0.0, "Low")],
        "transaction_id string, account_id string, amount double, fraud_score double, fraud_risk_category string",
    )
    got = [r.account_id for r in kpi.alert_summary(df, 2).collect()]
    assert got == ["C", "A"]
    assert kpi.high_risk_count(df).first().high_risk_count == 3


def test_audit_columns_fixed(spark):
    from vaultline.operators.audit import add_audit

    df = spark.createDataFrame([(1,)], "x int")
    row = add_audit(df, "customers.csv", "2024-01-01 00:00:00").first()
    assert row.created_timestamp == dt.datetime(2024, 1, 1)
    assert row.source_table == "customers.csv"
    assert F is not None


def test_mean_on_a_rounding_tie_is_exact(spark):
    """2,000 scores averaging exactly 0.30805: HALF_UP gives 0.3081 however
    the additions are ordered (a float sum can land on either side)."""
    rows = [(f"t{i}", "A", 1.0, 0.4 if i < 161 else 0.3, "Medium") for i in range(2000)]
    df = spark.createDataFrame(
        rows, "transaction_id string, account_id string, amount double, fraud_score double, fraud_risk_category string"
    ).withColumn("txn_date", F.lit("2024-01-29").cast("date"))
    for n in (1, 7, 16):
        got = kpi.kpi_daily_fraud(df.repartition(n)).first().avg_fraud_score
        assert got == 0.3081
