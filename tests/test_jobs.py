"""Raw files -> bronze -> silver -> gold, twice, on the sf0.001 tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from vaultline.config import AS_OF_1, AS_OF_2, FIXTURE
from vaultline.operators import scd
from vaultline.plans import jobs
from vaultline.session import scratch_path
from vaultline.sources import fixtures as fx
from vaultline.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    raw = scratch_path(spark, "test-raw")
    fx.customers(spark, SF).write.option("header", True).csv(f"{raw}/customers1")
    fx.customers_b2(spark, SF).write.option("header", True).csv(f"{raw}/customers2")
    fx.accounts_b1(spark, SF).drop("load_seq").write.option("header", True).csv(f"{raw}/accounts1")
    fx.accounts_b2(spark, SF).filter(F.col("load_seq") == 2).drop("load_seq").write.option("header", True).csv(
        f"{raw}/accounts2"
    )
    fx.credit(spark, SF).write.option("header", True).csv(f"{raw}/credit")
    fx.transactions_raw(spark, SF).write.json(f"{raw}/transactions")
    lk = jobs.Lake(scratch_path(spark, "test-lake"))
    jobs.ingest(spark, lk, "customers", f"{raw}/customers1", AS_OF_1)
    jobs.load_silver_customers(spark, lk, AS_OF_1)
    jobs.ingest(spark, lk, "customers", f"{raw}/customers2", AS_OF_2)
    jobs.load_silver_customers(spark, lk, AS_OF_2)
    jobs.ingest(spark, lk, "accounts", f"{raw}/accounts1", AS_OF_1)
    jobs.load_silver_accounts(spark, lk)
    jobs.ingest(spark, lk, "accounts", f"{raw}/accounts2", AS_OF_2)
    jobs.load_silver_accounts(spark, lk)
    jobs.ingest(spark, lk, "credit_history", f"{raw}/credit", AS_OF_1)
    jobs.ingest(spark, lk, "transactions", f"{raw}/transactions", AS_OF_1)
    jobs.load_silver_transactions(spark, lk, FIXTURE, fx.location_map(spark, SF))
    gold = jobs.build_gold(spark, lk, FIXTURE, location_map=fx.location_map(spark, SF))
    return lk, gold


def test_bronze_versions(spark, lake):
    lk, _ = lake
    assert tables.versions(spark, lk.bronze("customers")) == [1, 2]
    b = tables.read_table(spark, lk.bronze("customers"))
    assert {"created_timestamp", "source_table"} <= set(b.columns)


def test_silver_customer_counts(spark, lake):
    lk, _ = lake
    s = jobs.read_silver_customers(spark, lk)
    row = scd.scd2_totals(s).first()
    assert (row.total, row.current, row.expired) == (173, 153, 20)
    assert jobs.read_silver_customers(spark, lk, current_only=True).count() == 153
    assert dict(s.dtypes)["effective_end"] == "timestamp_ntz"
    # one history partition per load that closed rows, plus the current one
    assert {r[0] for r in s.select("effective_end").distinct().collect()} == {None, dt.datetime(2024, 2, 1)}


def test_silver_customer_reload_is_noop(spark, lake):
    lk, _ = lake
    before = sorted(map(tuple, jobs.read_silver_customers(spark, lk).collect()), key=repr)
    jobs.load_silver_customers(spark, lk, AS_OF_2)
    after = sorted(map(tuple, jobs.read_silver_customers(spark, lk).collect()), key=repr)
    assert before == after


def test_silver_accounts(spark, lake):
    lk, _ = lake
    a = tables.read_table(spark, lk.silver("accounts"))
    # 1,350 accounts in load 1 + 75 new keys (ending in 19) in load 2
    assert a.count() == a.select("account_id").distinct().count() == 1425


def test_silver_transactions_and_rerun(spark, lake):
    lk, _ = lake
    path = lk.silver("transactions")
    assert spark.read.parquet(path).count() == 964
    jobs.load_silver_transactions(spark, lk, FIXTURE, fx.location_map(spark, SF))
    assert spark.read.parquet(path).count() == 964


def test_gold_tables(spark, lake):
    lk, gold = lake
    assert spark.read.parquet(gold["fact_fraud"]).count() == 964
    assert spark.read.parquet(gold["dim_date"]).count() == 366
    assert spark.read.parquet(gold["dim_location"]).count() == 25
    assert spark.read.parquet(gold["churn"]).count() == 1425
    assert spark.read.parquet(gold["fact_credit"]).count() == 150
    fact = spark.read.parquet(gold["fact_fraud"])
    high = fact.where("fraud_risk_category = 'High'").count()
    assert spark.read.parquet(gold["high_risk_count"]).first()[0] == high
    top = spark.read.parquet(gold["alert_top10"])
    assert top.count() <= 10 and top.agg({"high_risk_txn_count": "sum"}).first()[0] <= high
    # a second gold run succeeds and keeps location keys
    first = {r.location: r.location_key for r in spark.read.parquet(gold["dim_location"]).collect()}
    again = jobs.build_gold(spark, lk, FIXTURE, location_map=fx.location_map(spark, SF), publish_db="gold_test")
    assert spark.table("gold_test.fact_fraud").count() == 964
    assert spark.table("gold_test.kpi_daily_fraud").count() == spark.read.parquet(again["kpi_daily_fraud"]).count()
    assert spark.table("gold_test.dim_location").count() == 25
    second = {r.location: r.location_key for r in spark.read.parquet(again["dim_location"]).collect()}
    assert first == second


def test_schema_evolution_rules(spark, lake):
    lk, _ = lake
    base = lk.silver("accounts")
    cur = tables.read_table(spark, base)
    with pytest.raises(ValueError):
        tables.write_snapshot(cur.withColumn("status", F.lit(1)), base, mode="evolve")
    with pytest.raises(ValueError):
        tables.write_snapshot(cur.withColumn("extra", F.lit(1)), base, mode="evolve")


def test_run_jobs_one_call(spark):
    raw = scratch_path(spark, "test-raw-all")
    fx.customers(spark, SF).write.option("header", True).csv(f"{raw}/customers")
    fx.accounts(spark, SF).write.option("header", True).csv(f"{raw}/accounts")
    fx.transactions_raw(spark, SF).write.json(f"{raw}/transactions")
    lk = jobs.Lake(scratch_path(spark, "test-lake-all"))
    out = jobs.run_jobs(
        spark, lk, {n: f"{raw}/{n}" for n in ("customers", "accounts", "transactions")}, AS_OF_1, FIXTURE,
        fx.location_map(spark, SF),
    )
    q = out["transaction_quality"]
    assert (q["raw_rows"], q["kept_rows"], q["dropped_rows"]) == (1000, 964, 36)
    assert spark.read.parquet(out["gold"]["fact_fraud"]).count() == 964


def test_plain_append_duplicates_on_rerun(spark):
    """Parity mode (source behaviour): a re-run appends the batch again."""
    from vaultline.plans import catalog as C

    path = scratch_path(spark, "plain-append")
    args = (C.bronze_txn_raw(spark, SF), fx.accounts(spark, SF), fx.customers(spark, SF), path, FIXTURE,
            fx.location_map(spark, SF))
    jobs.append_silver_transactions(spark, *args, idempotent=False)
    jobs.append_silver_transactions(spark, *args, idempotent=False)
    assert spark.read.parquet(path).count() == 2 * 964


def test_incremental_gold_equals_full_rebuild(spark):
    from vaultline.operators import kpi, scores
    from vaultline.plans import catalog as C

    raw = scratch_path(spark, "test-raw-inc")
    fx.customers(spark, SF).write.option("header", True).csv(f"{raw}/customers")
    fx.accounts(spark, SF).write.option("header", True).csv(f"{raw}/accounts")
    early = F.coalesce(F.col("timestamp") < F.lit(C.TXN_SPLIT), F.lit(False))
    tr = fx.transactions_raw(spark, SF)
    tr.filter(~early).write.json(f"{raw}/late")
    tr.filter(early).write.json(f"{raw}/early")
    lk = jobs.Lake(scratch_path(spark, "test-lake-inc"))
    loc = fx.location_map(spark, SF)
    jobs.run_jobs(spark, lk, {"customers": f"{raw}/customers", "accounts": f"{raw}/accounts",
                              "transactions": f"{raw}/late"}, AS_OF_1, FIXTURE, loc)
    second = jobs.run_jobs(spark, lk, {"transactions": f"{raw}/early"}, AS_OF_1, FIXTURE, loc)
    assert len(second["transaction_quality"]["days"]) < 40

    silver = spark.read.parquet(lk.silver("transactions"))
    assert silver.count() == 964
    full_fact = scores.build_fact_fraud(silver, FIXTURE)
    got_fact = spark.read.parquet(second["gold"]["fact_fraud"]).select(*full_fact.columns)
    assert got_fact.count() == 964 and got_fact.exceptAll(full_fact).count() == 0
    full_kpi = kpi.kpi_daily_fraud(full_fact)
    got_kpi = tables.read_table(spark, lk.gold("kpi_daily_fraud")).select(*full_kpi.columns)
    assert got_kpi.count() == full_kpi.count()
    assert got_kpi.exceptAll(full_kpi).count() == 0
    assert spark.read.parquet(second["gold"]["fact_transactions"]).count() == 964
    assert tables.read_table(spark, lk.gold("dim_location")).count() == 25


@pytest.mark.parametrize("order", [(2, 0, 1), (1, 2, 0, 1)])
def test_random_batches_in_any_order_equal_one_shot(spark, order):
    """Batches that interleave in time, loaded in any order (and one of
    them twice), give exactly the one-shot silver table."""
    from vaultline.plans import catalog as C

    bronze = C.bronze_txn_raw(spark, SF)
    part = F.pmod(F.xxhash64("timestamp", "account_id"), F.lit(3))
    path = scratch_path(spark, "random-batches")
    acc, cust, loc = fx.accounts(spark, SF), fx.customers(spark, SF), fx.location_map(spark, SF)
    for i in order:
        jobs.append_silver_transactions(spark, bronze.filter(part == i), acc, cust, path, FIXTURE, loc)
    one_shot = C.silver_raw(spark, SF)
    got = spark.read.parquet(path).select(*one_shot.columns)
    assert got.count() == one_shot.count() == 964
    assert got.exceptAll(one_shot).count() == 0 and one_shot.exceptAll(got).count() == 0
    assert got.filter(F.col("rapid_txn_flag") == 1).count() > 0


def test_command_line_load(spark):
    from vaultline.plans import run

    raw = scratch_path(spark, "cli-raw")
    fx.customers(spark, SF).write.option("header", True).csv(f"{raw}/customers")
    fx.accounts(spark, SF).write.option("header", True).csv(f"{raw}/accounts")
    fx.transactions_raw(spark, SF).write.json(f"{raw}/transactions")
    lake = scratch_path(spark, "cli-lake")
    import json
    import os

    cfg_path = os.path.join(scratch_path(spark, "cli-cfg").replace("file:", ""), "cfg.json")
    os.makedirs(os.path.dirname(cfg_path), exist_ok=True)
    with open(cfg_path, "w") as f:
        json.dump({"high_amount": 100.0, "rapid_window_s": 21600, "fraud_weights": [0.4, 0.3, 0.3]}, f)
    out = run.main(["--lake", lake, "--as-of", AS_OF_1, "--customers", f"{raw}/customers", "--accounts",
                    f"{raw}/accounts", "--transactions", f"{raw}/transactions", "--config", cfg_path,
                    "--publish-db", "gold_cli"])
    assert out["transaction_quality"]["kept_rows"] == 964
    assert out["transaction_quality"]["high_amount_rows"] > 0
    assert spark.table("gold_cli.fact_fraud").count() == 964



def test_gold_dim_customer_follows_customer_loads(spark):
    """run_jobs: customer-only loads copy just the changed partitions of
    the SCD2 table into gold; the copy always equals silver."""
    raw = scratch_path(spark, "test-raw-cust")
    fx.customers(spark, SF).write.option("header", True).csv(f"{raw}/c1")
    fx.customers_b2(spark, SF).write.option("header", True).csv(f"{raw}/c2")
    fx.accounts(spark, SF).write.option("header", True).csv(f"{raw}/accounts")
    fx.transactions_raw(spark, SF).write.json(f"{raw}/transactions")
    lk = jobs.Lake(scratch_path(spark, "test-lake-cust"))
    loc = fx.location_map(spark, SF)
    jobs.run_jobs(spark, lk, {"customers": f"{raw}/c1", "accounts": f"{raw}/accounts",
                              "transactions": f"{raw}/transactions"}, AS_OF_1, FIXTURE, loc)
    def data_files(path):
        root = path.replace("file:", "")
        return sorted(f for _, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))

    fact_files = data_files(lk.gold("fact_fraud"))
    assert fact_files
    out = jobs.run_jobs(spark, lk, {"customers": f"{raw}/c2"}, AS_OF_2, FIXTURE, loc)
    assert out["customer_totals"] == {"total": 173, "current": 153, "expired": 20} and out["rejected"] == {"customers": 0}
    gold = spark.read.parquet(out["gold"]["dim_customer"])
    assert dict(gold.dtypes)["effective_end"] == "timestamp_ntz"
    silver = jobs.read_silver_customers(spark, lk)
    assert gold.count() == silver.count() == 173
    assert gold.select(*silver.columns).exceptAll(silver).count() == 0
    # no transaction load: the transaction facts were not rewritten
    assert data_files(lk.gold("fact_fraud")) == fact_files
