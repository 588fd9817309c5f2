"""Dimensions: calendar, two-phase keys, stable extension."""

import datetime as dt

from pyspark.sql import functions as F

from vaultline.operators import dims


def test_dim_date_2026(spark):
    d = dims.build_dim_date(spark, "2026-01-01", "2026-12-31")
    rows = d.collect()
    assert len(rows) == 365
    assert sum(r.is_weekend for r in rows) == 104
    first = min(rows, key=lambda r: r.full_date)
    assert (first.date_key, first.day_name, first.month_name, first.quarter) == (20260101, "Thursday", "January", 1)


def test_dim_date_leap_year(spark):
    assert dims.build_dim_date(spark, "2024-01-01", "2024-12-31").count() == 366


def test_dim_date_for_data_span(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 5),), (dt.date(2025, 7, 1),)], "d date")
    assert dims.build_dim_date_for(df, "d").count() == 366 + 365


def test_two_phase_key_equals_row_number(spark):
    df = spark.range(5000).select(F.format_string("k%05d", (F.col("id") * 7919) % 5000).alias("k"))
    a = {r.k: r.key for r in dims.assign_key(df, "k", "key", num_partitions=7).collect()}
    b = {r.k: r.key for r in dims.assign_key_single(df, "k", "key").collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, 5001))


def test_two_phase_plan_has_no_single_partition(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    plan = dims.assign_key(df, "k", "key")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_extend_keeps_keys(spark):
    first = dims.build_dim_location(spark.createDataFrame([("London",), ("Mumbai",)], "location string"))
    assert {r.location: r.location_key for r in first.collect()} == {"London": 1, "Mumbai": 2}
    more = spark.createDataFrame([("London",), ("Athens",), ("Mumbai",)], "location string")
    ext = {r.location: (r.location_key, r.country, r.region) for r in dims.extend_dim_location(first, more).collect()}
    assert ext == {"London": (1, "UK", "Europe"), "Mumbai": (2, "India", "Asia"), "Athens": (3, "Unknown", "Other")}


def test_two_phase_key_with_adaptive_partitions(spark):
    df = spark.range(3000).select(F.format_string("k%05d", (F.col("id") * 7919) % 3000).alias("k"))
    a = {r.k: r.key for r in dims.assign_key(df, "k", "key").collect()}
    b = {r.k: r.key for r in dims.assign_key_single(df, "k", "key").collect()}
    assert a == b
