"""A hot account holding a third of all rows must not become one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultline.operators.rolling import rolling_count, rolling_count_plain, second_counts


@pytest.fixture()
def skewed(spark):
    # 60,000 rows over 20 hours: account 0 holds a third of them
    n = 60000
    base = dt.datetime(2024, 1, 1)
    df = spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("account_id"),
        (F.lit(int(base.replace(tzinfo=dt.timezone.utc).timestamp())) + (F.col("id") * 72000 / n).cast("long")).alias("u"),
    )
    return df


def test_hot_account_in_one_span_is_one_row_a_second(spark):
    """A third of all rows in one account within 300 seconds: the window runs
    over seconds, and no task reads much more than the median one."""
    n, span = 90_000, 300
    df = spark.range(n).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 9973 + 1).alias("account_id"),
        F.when(F.col("id") % 3 == 0, F.col("id") % span).otherwise(F.col("id") % 86_400).alias("u"),
    )
    per_second = second_counts(df, "account_id", "u", "transaction_id")
    assert per_second.where("_rc_key = 0").count() == span // 3  # ids of the account are multiples of 3
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = rolling_count(df, "account_id", "u", 300, "transaction_id", "c")
        tasks = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        at_end = out.where("account_id = 0 and u = 297").select("c").distinct().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(tasks) == n and tasks[-1] < 2 * tasks[len(tasks) // 2]
    window = plan[plan.index("Window") :]
    assert "HashAggregate" in window and "transaction_id" not in plan[plan.index("Window") : plan.index("HashAggregate", plan.index("Window"))]
    assert [r["c"] for r in at_end] == [n // 3]


def test_rows_without_a_key_are_dealt_out(spark):
    """A NULL account with a third of all rows forms no hot task."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(30_000).select(F.col("id").alias("v"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), (F.col("id") % 9).alias("u"))
        out = rolling_count(df, "k", "u", 60, "v", "c")
        tasks = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert out.where("k is null and c is not null").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(tasks) == 30_000 and tasks[-1] < 1.5 * tasks[len(tasks) // 2]


def test_hot_second_is_split_by_aqe(spark):
    """All rows of the account in one second: one join key, split on the rows' side."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("v"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit(7).cast("long").alias("u"))
        out = rolling_count(df, "k", "u", 60, "v", "c")
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "skew=true" in plan and {r["c"] for r in rows if r["k"] == 0} == {20_000} and {r["c"] for r in rows if r["k"]} == {1}


def test_hot_account_window_spreads_over_tasks(spark, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = rolling_count(skewed, "account_id", "u", 300, "transaction_id", "c", bucket_seconds=3600)
        per_task = (
            out.filter(F.col("account_id") == 0)
            .groupBy(F.spark_partition_id().alias("p"))
            .count()
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot_rows = sum(r["count"] for r in per_task)
    assert hot_rows == 20000
    assert len(per_task) >= 4
    assert max(r["count"] for r in per_task) < hot_rows / 2


def test_hot_account_counts_equal_plain(spark, skewed):
    a = rolling_count(skewed, "account_id", "u", 300, "transaction_id", "c", bucket_seconds=600)
    p = rolling_count_plain(skewed, "account_id", "u", 300, "transaction_id", "c")
    diff = a.select("transaction_id", "c").exceptAll(p.select("transaction_id", "c"))
    assert diff.count() == 0


def test_hot_account_join_is_split_by_aqe(spark, skewed):
    from vaultline.operators.transactions import account_dimension

    accounts = spark.range(1000).select(F.col("id").alias("account_id"), (F.col("id") % 50).alias("customer_id"))
    customers = spark.range(50).select(F.col("id").alias("customer_id"), F.lit("UK").alias("country"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = skewed.join(account_dimension(accounts, customers), "account_id", "left")
        rows = joined.collect()  # runs this DataFrame's own adaptive plan
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(rows) == 60000
    assert "isFinalPlan=true" in plan
    assert "skew=true" in plan
