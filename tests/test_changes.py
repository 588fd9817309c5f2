"""Work and checks that follow the load, not the history."""

import pytest
from pyspark.sql import functions as F

from vaultline.operators import kpi, scd
from vaultline.plans import jobs
from vaultline.session import scratch_path
from vaultline.sources import tables

ONE, TWO, THREE = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def customers(spark, lake, as_of, *rows):
    tables.write_snapshot(spark.createDataFrame(rows, "customer_id string, customer_type string"), lake.bronze("customers"))
    jobs.load_silver_customers(spark, lake, as_of)


@pytest.fixture()
def lake(spark):
    return jobs.Lake(scratch_path(spark, "lake"))


def three_loads(spark, lake):
    customers(spark, lake, ONE, *((f"c{k}", "A") for k in range(40)))
    customers(spark, lake, TWO, *((f"c{k}", "B" if k < 5 else "A") for k in range(42)))
    customers(spark, lake, THREE, *((f"c{k}", "C" if k in (1, 7) else "B" if k < 5 else "A") for k in range(42)))


def test_current_rows_are_joined_on_their_buckets(spark, lake):
    """Only the batch is shuffled for the SCD2 join, and a new version keeps one file a bucket."""
    three_loads(spark, lake)
    base = lake.silver("customer")
    column, n = tables.bucketing(spark, tables.version_path(base, 3))
    assert column == "customer_id" and n == int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = tables.read_bucketed(spark, base).inputFiles()
    assert len(files) <= n
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current = tables.read_bucketed(spark, base)
        staging = spark.createDataFrame([("c1", "Z"), ("new", "A")], "customer_id string, customer_type string")
        step = scd.scd2_apply(current, staging, "customer_id", THREE, keep_expired=False)
        plan = step._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    side = plan[plan.index("Join") :].split("Exchange hashpartitioning")
    assert "Bucketed: true" in side[0] and len(side) <= 3  # the batch: once to drop repeats, once at most to meet the buckets
    assert step.where("is_current").count() == 43


def test_totals_are_carried_and_equal_the_full_count(spark, lake):
    three_loads(spark, lake)
    full = jobs.check_customers(spark, lake)
    assert jobs.check_customer_load(spark, lake) == jobs.customer_totals(spark, lake) == full == {"total": 49, "current": 42, "expired": 7}


def test_the_check_reads_no_history_of_other_loads(spark, lake):
    three_loads(spark, lake)
    tables.drop_folder(spark, f"{lake.silver('customer_history')}/load=2")
    assert jobs.check_customer_load(spark, lake)["expired"] == 7


def test_the_check_finds_a_bad_load(spark, lake):
    three_loads(spark, lake)
    path = f"{lake.silver('customer_history')}/load=3"
    closed = spark.read.parquet(path).checkpoint()
    closed.withColumn("effective_end", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).write.mode("overwrite").parquet(path)
    with pytest.raises(AssertionError):
        jobs.check_customer_load(spark, lake)
    closed.write.mode("overwrite").parquet(path)
    jobs.check_customer_load(spark, lake)
    twice = tables.read_table(spark, lake.silver("customer"))
    tables.write_snapshot(twice.unionByName(twice.limit(1)), lake.silver("customer"))
    with pytest.raises(AssertionError):
        jobs.check_customer_load(spark, lake)


def test_tables_without_buckets_still_load(spark, lake):
    customers(spark, lake, ONE, ("1", "A"), ("2", "A"))
    old = tables.read_table(spark, lake.silver("customer"))
    tables.write_snapshot(old, lake.silver("customer"))  # as earlier versions of the library wrote it
    assert tables.bucketing(spark, tables.version_path(lake.silver("customer"), 2)) is None
    customers(spark, lake, TWO, ("1", "B"), ("2", "A"))
    assert jobs.check_customer_load(spark, lake) == {"total": 3, "current": 2, "expired": 1}
    assert tables.bucketing(spark, tables.version_path(lake.silver("customer"), 3)) is not None


FACT = "transaction_id string, account_id string, amount double, txn_date date, fraud_score double, fraud_risk_category string"


def fact(spark, *rows):
    df = spark.createDataFrame([(f"t{i}", a, m, d, s, c) for i, a, m, d, s, c in rows], FACT.replace("txn_date date", "txn_date string"))
    return df.withColumn("txn_date", F.to_date("txn_date"))


def test_alerts_read_only_the_days_of_the_load(spark):
    path, alerts = scratch_path(spark, "fact"), scratch_path(spark, "alerts")
    rows = [(k, f"a{k % 3}", 10.1 * k, f"2024-01-0{1 + k % 4}", 0.7, "High" if k % 5 else "Low") for k in range(60)]
    tables.write_partitioned(fact(spark, *rows), path, "txn_date")
    jobs.update_alerts(spark, path, alerts)
    want_all = kpi.alert_summary(spark.read.parquet(path)).collect()
    assert kpi.alert_summary_of(spark.read.parquet(alerts)).collect() == want_all
    # a day that is not of the load is out of reach, one loses its alerts, one is new
    changed = [r for r in rows if r[3] != "2024-01-02"] + [(99, "a1", 5.0, "2024-01-02", 0.1, "Low"), (100, "a2", 7.5, "2024-02-01", 0.9, "High")]
    days = ["2024-01-02", "2024-02-01"]
    tables.overwrite_partitions(fact(spark, *[r for r in changed if r[3] in days]), path, "txn_date")
    want = kpi.alert_summary(fact(spark, *changed)).collect()
    count = kpi.high_risk_count(fact(spark, *changed)).first()[0]
    tables.drop_folder(spark, f"{path}/txn_date=2024-01-01")
    import datetime as dt

    got = jobs.update_alerts(spark, path, alerts, [dt.date.fromisoformat(d) for d in days])
    assert kpi.alert_summary_of(got).collect() == want and kpi.high_risk_count_of(got).first()[0] == count


def test_a_write_that_loses_rows_is_found(spark, monkeypatch):
    path = scratch_path(spark, "fact")
    df = spark.range(20).withColumn("p", F.col("id") % 3)
    tables.write_partitioned(df, path, "p", verify=True)
    tables.overwrite_partitions(df.where("p = 1"), path, "p", verify=F.col("p") == 1)
    with pytest.raises(RuntimeError):
        tables.overwrite_partitions(df.where("p = 1"), path, "p", verify=F.col("p") < 2)
