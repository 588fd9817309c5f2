"""Loads that must not lose, multiply or misplace rows."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from vaultline.config import SOURCE
from vaultline.operators import scd
from vaultline.operators.transactions import SILVER_COLUMNS
from vaultline.plans import jobs
from vaultline.plans.catalog import QUERIES
from vaultline.session import scratch_path
from vaultline.sources import idindex, tables

ONE, TWO, THREE = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"
SF = "/root/testdata/sf0.01"


def batch(spark, *rows):
    full = [(i, a, 10.0, "USD", "card", "M", "London", t) for i, a, t in rows]
    return spark.createDataFrame(full, "transaction_id string, account_id string, amount double, currency string, transaction_type string, merchant string, location string, timestamp string")


def load(spark, path, *rows):
    acc = spark.createDataFrame([("a", "c"), ("b", "c")], "account_id string, customer_id string")
    cust = spark.createDataFrame([("c", "UK")], "customer_id string, country string")
    return jobs.append_silver_transactions(spark, batch(spark, *rows), acc, cust, path, SOURCE)


def rows_of(spark, path):
    return {r["transaction_id"]: r for r in spark.read.parquet(path).collect()}


def test_repeated_ids_stay_one_row(spark):
    path = scratch_path(spark, "silver")
    load(spark, path, ("t1", "a", "2024-01-01 10:00:00"), ("t1", "a", "2024-01-01 10:01:00"), ("t2", "a", "2024-01-01 10:02:00"))
    for k in range(3):
        load(spark, path, (f"x{k}", "a", f"2024-01-01 10:03:0{k}"))
    assert spark.read.parquet(path).count() == 5
    assert rows_of(spark, path)["t1"]["txn_timestamp"] == dt.datetime(2024, 1, 1, 10, 1)


def test_moved_ids_leave_no_trace(spark):
    path = scratch_path(spark, "silver")
    load(spark, path, *[(f"t{k}", "a", f"2024-01-01 10:00:0{k}") for k in range(5)])
    assert rows_of(spark, path)["t4"]["rapid_txn_flag"] == 1 and rows_of(spark, path)["t3"]["rapid_txn_flag"] == 1
    load(spark, path, ("t0", "b", "2024-01-01 10:00:00"))  # another account
    got = rows_of(spark, path)
    assert len(got) == 5 and got["t3"]["rapid_txn_flag"] == 0 and got["t4"]["rapid_txn_flag"] == 1
    load(spark, path, ("t1", "a", "2024-05-05 10:00:00"))  # another day
    got = rows_of(spark, path)
    assert len(got) == 5 and got["t4"]["rapid_txn_flag"] == 0 and str(got["t1"]["txn_date"]) == "2024-05-05"


def test_late_row_rewrites_few_partitions(spark):
    path = scratch_path(spark, "silver")
    start = dt.datetime(2024, 1, 1, 12)
    load(spark, path, *[(f"t{k}", "a", str(start + dt.timedelta(days=k))) for k in range(200)])
    root = path.replace("file:", "")
    before = {f for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}
    out = load(spark, path, ("late", "a", str(start)), ("new", "a", str(start + dt.timedelta(days=199))))
    after = {f for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}
    assert len(before - after) <= 4 and len(out["days"]) <= 4
    assert spark.read.parquet(path).count() == 202


def test_load_keeps_only_what_later_steps_read(spark, monkeypatch):
    """Silver rows near a batch are kept as ids and places, and of their flags
    only the changed ones; the batch is kept in silver's columns (F3)."""
    path = scratch_path(spark, "silver")
    load(spark, path, *[(f"t{k}", "a", f"2024-01-01 10:00:{k:02d}") for k in range(40)], ("far", "b", ONE))
    kept, plain = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda df, *a, **k: kept.append(plain(df, *a, **k)) or kept[-1])
    load(spark, path, ("t0", "b", "2024-01-01 10:00:00"), ("new", "a", "2024-01-03 00:00:00"))
    wide = [df for df in kept if "amount" in df.columns]
    assert len(wide) == 1 and wide[0].count() == 2 and {*wide[0].columns} < {*SILVER_COLUMNS}
    narrow = {"transaction_id", "account_id", "txn_timestamp", "txn_date", "_was", "_again", "_ctx", "rapid_txn_flag"}
    assert all({*df.columns} <= narrow for df in kept if df is not wide[0])
    (flags,) = (df for df in kept if "_ctx" in df.columns)
    got = {(r["transaction_id"], r["_ctx"], r["rapid_txn_flag"]) for r in flags.collect()}
    assert got == {("t0", False, 0), ("new", False, 0), ("t3", True, 0)}  # t3 was the fourth of account a, now the third
    assert rows_of(spark, path)["t3"]["rapid_txn_flag"] == 0 and len(rows_of(spark, path)) == 42


@pytest.mark.parametrize("window_s", [300, 86400, 100_000])
def test_places_near_equal_plain_day_arithmetic(spark, window_s):
    """Days that windows from the anchors reach, and the days before them that
    windows ending there reach back to; none for rows without account or time."""
    at = [("a", "2024-01-01 23:58:00"), ("a", "2024-01-03 10:00:00"), ("a", "2024-01-03 10:00:00"), ("b", "2024-02-28 12:00:00"), (None, ONE), ("c", None)]
    rows = spark.createDataFrame(at, "account_id string, at string").select("account_id", F.col("at").cast("timestamp_ntz").alias("txn_timestamp"))
    got = jobs._places_near(rows.withColumn("txn_date", F.to_date("txn_timestamp")), window_s).collect()
    want = {}
    for account, text in at:
        if account and text:
            t = dt.datetime.fromisoformat(text)
            for day in (t.date(), (t + dt.timedelta(seconds=window_s)).date()):
                for b in range(-(-window_s // 86400) + 1):
                    place = (account, day - dt.timedelta(days=b))
                    want[place] = want.get(place, False) or b == 0
    assert len(got) == len(want) and {(r["account_id"], r["txn_date"]): r["_again"] for r in got} == want


def test_first_write_that_died_does_not_block(spark):
    path = scratch_path(spark, "silver")
    os.makedirs(os.path.join(path.replace("file:", ""), "_temporary"))
    load(spark, path, ("t1", "a", ONE))
    assert spark.read.parquet(path).count() == 1


def test_a_day_that_loses_its_last_row_goes(spark):
    path = scratch_path(spark, "silver")
    load(spark, path, ("t1", "a", "2024-01-01 10:00:00"), ("t2", "a", "2024-02-02 10:00:00"), ("t3", "a", None))
    load(spark, path, ("t1", "a", "2024-03-03 10:00:00"), ("t3", "a", "2024-03-03 11:00:00"))
    rows = spark.read.parquet(path)
    assert rows.count() == 3 and {str(r["txn_date"]) for r in rows.collect()} == {"2024-02-02", "2024-03-03"}
    load(spark, path, ("t1", "a", "2024-03-03 10:00:00"))  # again: nothing changes
    assert spark.read.parquet(path).count() == 3


def test_a_load_that_died_before_it_removed_a_day_is_mended(spark, monkeypatch):
    path = scratch_path(spark, "silver")
    load(spark, path, ("t1", "a", "2024-01-01 10:00:00"), ("t2", "a", "2024-02-02 10:00:00"))
    moved = ("t1", "a", "2024-03-03 10:00:00")

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(tables, "drop_partitions", dies)
        load(spark, path, moved)
    assert spark.read.parquet(path).count() == 3
    load(spark, path, moved)
    assert {(r["transaction_id"], str(r["txn_date"])) for r in spark.read.parquet(path).collect()} == {("t1", "2024-03-03"), ("t2", "2024-02-02")}


def test_gold_loses_an_emptied_day(spark):
    lake = jobs.Lake(scratch_path(spark, "lake"))
    tables.write_snapshot(spark.createDataFrame([("a", "c", "Open")], "account_id string, customer_id string, status string"), lake.silver("accounts"))
    tables.write_snapshot(scd.scd2_init(spark.createDataFrame([("c", "UK", "A")], "customer_id string, country string, customer_type string"), ONE), lake.silver("customer"))

    def run(*rows):
        tables.write_snapshot(batch(spark, *rows), lake.bronze("transactions"))
        out = jobs.load_silver_transactions(spark, lake, SOURCE)
        return jobs.build_gold(spark, lake, SOURCE, days=out["days"])

    run(("t1", "a", "2024-01-01 10:00:00"), ("t2", "a", "2024-02-02 10:00:00"))
    out = run(("t1", "a", "2024-03-03 10:00:00"))
    for name in ("fact_fraud", "fact_transactions", "kpi_daily_fraud"):
        assert {str(r["txn_date"]) for r in spark.read.parquet(out[name]).collect()} == {"2024-02-02", "2024-03-03"}, name
    assert spark.read.parquet(out["fact_fraud"]).count() == 2


def test_ids_are_looked_up_in_their_buckets_and_days_only(spark):
    """Rows read for a small batch do not grow with the table."""
    path = scratch_path(spark, "silver")
    start = dt.datetime(2024, 1, 1, 12)
    load(spark, path, *[(f"t{k}", "a", str(start + dt.timedelta(days=k))) for k in range(60)])
    ids = spark.createDataFrame([("t7",), ("unknown",)], "transaction_id string")
    assert [str(d) for d in idindex.days_of(spark, path, ids, "transaction_id", "txn_date")] == ["2024-01-08"]
    found = idindex.entries_of(spark, path, ids, "transaction_id", "txn_date")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan and len(set(re.search(r"PartitionFilters: \[bucket#\d+ IN \(([\d,]+)\)", plan)[1].split(","))) <= 2
    load(spark, path, ("t7", "a", "2024-06-01 00:00:00"))
    assert {str(d) for d in idindex.days_of(spark, path, ids, "transaction_id", "txn_date")} == {"2024-01-08", "2024-06-01"}
    idindex.rebuild(spark, path, "transaction_id", "txn_date", 3)  # compacts
    assert [str(d) for d in idindex.days_of(spark, path, ids, "transaction_id", "txn_date")] == ["2024-06-01"]
    load(spark, path, ("new", "a", "2024-01-05 00:00:00"))
    assert sum(1 for _ in idindex.days_of(spark, path, spark.createDataFrame([("new",)], "transaction_id string"), "transaction_id", "txn_date")) == 1


def test_a_table_without_an_index_gets_one(spark):
    path = scratch_path(spark, "silver")
    load(spark, path, ("t1", "a", ONE), ("t2", "a", TWO))
    tables.drop_folder(spark, f"{path}_ids")
    load(spark, path, ("t1", "a", THREE))
    assert {(r["transaction_id"], str(r["txn_date"])) for r in spark.read.parquet(path).collect()} == {("t1", "2024-03-01"), ("t2", "2024-02-01")}


def customers(spark, lake, as_of, *rows):
    tables.write_snapshot(spark.createDataFrame(rows, "customer_id string, customer_type string"), lake.bronze("customers"))
    jobs.load_silver_customers(spark, lake, as_of)


def totals(spark, lake):
    return tuple(scd.scd2_totals(jobs.read_silver_customers(spark, lake)).first())


def test_two_loads_as_of_one_time_keep_all_versions(spark):
    lake = jobs.Lake(scratch_path(spark, "lake"))
    customers(spark, lake, ONE, ("1", "A"), ("2", "A"))
    customers(spark, lake, TWO, ("1", "B"), ("2", "A"))
    customers(spark, lake, TWO, ("1", "B"), ("2", "B"))
    assert totals(spark, lake) == (4, 2, 2)
    with pytest.raises(ValueError):
        customers(spark, lake, ONE, ("1", "C"))
    assert totals(spark, lake) == (4, 2, 2)


def test_load_that_died_before_its_current_rows_is_invisible_and_repaired(spark):
    lake = jobs.Lake(scratch_path(spark, "lake"))
    customers(spark, lake, ONE, ("1", "A"), ("2", "A"))
    before = totals(spark, lake)
    # history written, current version half-written: no marker
    dead = jobs.read_silver_customers(spark, lake).limit(1)
    dead.write.parquet(f"{lake.silver('customer_history')}/load=2")
    os.makedirs(tables.version_path(lake.silver("customer"), 2).replace("file:", ""))
    assert totals(spark, lake) == before
    customers(spark, lake, TWO, ("1", "B"), ("2", "A"))
    assert totals(spark, lake) == (3, 2, 1)
    customers(spark, lake, THREE, ("1", "B"), ("2", "C"))
    assert totals(spark, lake) == (4, 2, 2)


def test_load_that_died_before_its_history_is_repaired(spark):
    lake = jobs.Lake(scratch_path(spark, "lake"))
    customers(spark, lake, ONE, ("1", "A"))
    os.makedirs(f"{lake.silver('customer_history')}/load=2/_temporary".replace("file:", ""))
    customers(spark, lake, TWO, ("1", "B"))
    assert totals(spark, lake) == (2, 1, 1)


def test_history_of_a_dead_load_does_not_come_back(spark, monkeypatch):
    lake = jobs.Lake(scratch_path(spark, "lake"))
    customers(spark, lake, ONE, ("1", "A"), ("2", "A"))
    real = tables.write_snapshot

    def dies(df, base, *args, **more):
        if base == lake.silver("customer"):
            raise RuntimeError("lost")
        return real(df, base, *args, **more)

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(tables, "write_snapshot", dies)
        customers(spark, lake, TWO, ("1", "B"), ("2", "A"))
    customers(spark, lake, TWO, ("1", "A"), ("2", "A"))  # the source is put right: nothing closes
    assert totals(spark, lake) == (2, 2, 0)
    jobs.check_customers(spark, lake)


def test_scd2_refuses_new_columns(spark):
    lake = jobs.Lake(scratch_path(spark, "lake"))
    customers(spark, lake, ONE, ("1", "A"))
    staged = spark.createDataFrame([("1", "B", "x")], "customer_id string, customer_type string, extra string")
    with pytest.raises(ValueError):
        scd.scd2_apply(jobs.read_silver_customers(spark, lake), staged, "customer_id", TWO)


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwrite_replaces_whatever_the_session_says(spark, mode):
    path = scratch_path(spark, "fact")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        tables.write_partitioned(spark.range(10).withColumn("p", F.col("id") % 3), path, "p")
        tables.write_partitioned(spark.range(4).withColumn("p", F.lit(1)), path, "p")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert spark.read.parquet(path).count() == 4


def test_uncounted_rows_form_no_hot_window(spark):
    from vaultline.operators.rolling import rolling_count

    df = spark.range(5000).select(F.col("id").alias("v"), F.lit(None).cast("string").alias("k"), F.col("id").alias("u"))
    got = rolling_count(df, "k", "u", 60, "v", "n")
    assert got.where("n is not null").count() == 0 and got.count() == 5000
    from pyspark.sql.window import Window  # noqa: F401  # the groups themselves
    assert df.select(F.xxhash64("v", "k", "u").alias("h")).distinct().count() > 256


def test_ties_are_dealt_over_ranges(spark):
    from vaultline.operators.dims import assign_key

    df = spark.range(20_000).select(F.lit("same").alias("name"), "id")
    keyed = assign_key(df, "name", "key", num_partitions=8)
    rows = keyed.select("id", "key").orderBy("key").collect()
    assert [r["key"] for r in rows] == list(range(1, 20_001)) and [r["id"] for r in rows] == list(range(20_000))


def test_both_branches_occur(spark):
    cover = QUERIES["join_coverage"](spark, SF).first()
    assert cover["matched"] > 0 and cover["unmatched"] > 0
    labels = QUERIES["location_country_map"](spark, SF).collect()
    assert {r["region"] for r in labels} == {"Asia", "Europe", "Americas", "Other"}
    assert {r["country"] for r in labels} == {"India", "UK", "USA", "Canada", "Unknown"}
    silver = QUERIES["silver_without_account"](spark, SF)
    assert silver.where("account_id is null").count() > 0 and silver.where("txn_timestamp is null").count() > 0
