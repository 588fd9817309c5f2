"""

Each entry takes ``(spark, sf_dir)``, reads whole driver tables through
``sources.fixtures`` and returns a DataFrame whose columns are named like
the matching SQL in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.config import AS_OF_1, FIXTURE, SOURCE, RiskConfig
from vaultline.operators import kpi, scores
from vaultline.operators import transactions as tx
from vaultline.operators.audit import add_audit
from vaultline.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def q(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------

def bronze_txn_raw(spark: SparkSession, d: str) -> DataFrame:
    return add_audit(fx.transactions_raw(spark, d), "transactions.json", AS_OF_1)


def clean_raw(spark: SparkSession, d: str) -> DataFrame:
    return bronze_txn_raw(spark, d).transform(tx.flatten_struct).transform(tx.clean_transactions)


def prepared_raw(spark: SparkSession, d: str, cfg: RiskConfig = FIXTURE) -> DataFrame:
    return tx.prepare_transactions(bronze_txn_raw(spark, d), cfg)


def silver_raw(spark: SparkSession, d: str, cfg: RiskConfig = FIXTURE) -> DataFrame:
    return tx.build_silver_transactions(
        bronze_txn_raw(spark, d), fx.accounts(spark, d), fx.customers(spark, d), cfg, fx.location_map(spark, d)
    )


def silver_clean(spark: SparkSession, d: str, cfg: RiskConfig = FIXTURE) -> DataFrame:
    return tx.build_silver_transactions(
        fx.transactions(spark, d), fx.accounts(spark, d), fx.customers(spark, d), cfg, fx.location_map(spark, d), "ts"
    )


def fact_fraud(spark: SparkSession, d: str, cfg: RiskConfig = FIXTURE) -> DataFrame:
    return scores.build_fact_fraud(silver_clean(spark, d, cfg), cfg)


# ---------------------------------------------------------------------------
# transactions: cleaning, flags, joins
# ---------------------------------------------------------------------------

@q("txn_flatten")
def _txn_flatten(spark, d):
    return fx.transactions_raw(spark, d).transform(tx.flatten_struct)


@q("txn_clean")
def _txn_clean(spark, d):
    return fx.transactions_raw(spark, d).transform(tx.flatten_struct).transform(tx.clean_transactions)


@q("txn_time_parts")
def _txn_time_parts(spark, d):
    return prepared_raw(spark, d).select("transaction_id", "timestamp", "txn_timestamp", "transaction_hour", "txn_date")


@q("txn_high_amount")
def _txn_high_amount(spark, d):
    return prepared_raw(spark, d).select("transaction_id", "amount", "high_amount_flag")


@q("txn_high_amount_default")
def _txn_high_amount_default(spark, d):
    return prepared_raw(spark, d, SOURCE).select("transaction_id", "amount", "high_amount_flag")


@q("txn_rolling_count")
def _txn_rolling_count(spark, d):
    return tx.txn_window_count(prepared_raw(spark, d), FIXTURE).select(
        "transaction_id", "account_id", "txn_timestamp", tx.WINDOW_COUNT
    )


@q("txn_rapid_flag")
def _txn_rapid_flag(spark, d):
    return tx.rapid_flag(prepared_raw(spark, d), FIXTURE).select(
        "transaction_id", "account_id", "txn_timestamp", tx.WINDOW_COUNT, "rapid_txn_flag"
    )


@q("txn_rapid_flag_default")
def _txn_rapid_flag_default(spark, d):
    return tx.rapid_flag(prepared_raw(spark, d, SOURCE), SOURCE).select(
        "transaction_id", "account_id", "txn_timestamp", tx.WINDOW_COUNT, "rapid_txn_flag"
    )


@q("txn_join_accounts")
def _txn_join_accounts(spark, d):
    return tx.join_accounts(clean_raw(spark, d), fx.accounts(spark, d)).select(
        "transaction_id", "account_id", "customer_id"
    )


@q("txn_join_customers")
def _txn_join_customers(spark, d):
    j = tx.join_accounts(clean_raw(spark, d), fx.accounts(spark, d))
    return tx.join_customers(j, fx.customers(spark, d)).select(
        "transaction_id", "account_id", "customer_id", "home_country"
    )


@q("join_coverage")
def _join_coverage(spark, d):
    """Transactions with an account, with an unknown one, and with none."""
    t = fx.transactions_without_account(spark, d).transform(tx.flatten_struct).transform(tx.clean_transactions)
    j = tx.join_accounts(t, fx.accounts(spark, d))
    return j.agg(
        F.count_if(F.col("customer_id").isNotNull()).alias("matched"),
        F.count_if(F.col("customer_id").isNull()).alias("unmatched"),
    )


@q("silver_without_account")
def _silver_without_account(spark, d):
    """Silver of transactions with unknown or no accounts and unreadable times."""
    bronze = add_audit(fx.transactions_without_account(spark, d), "transactions.json", AS_OF_1)
    return tx.build_silver_transactions(
        bronze, fx.accounts(spark, d), fx.customers(spark, d), FIXTURE, fx.location_map(spark, d)
    )


@q("txn_country")
def _txn_country(spark, d):
    return tx.txn_country(clean_raw(spark, d), fx.location_map(spark, d)).select(
        "transaction_id", "location", "txn_country"
    )


@q("txn_geo_mismatch")
def _txn_geo_mismatch(spark, d):
    return silver_raw(spark, d).select("transaction_id", "txn_country", "home_country", "geo_mismatch_flag")


@q("silver_transactions")
def _silver_transactions(spark, d):
    return silver_raw(spark, d)


# ---------------------------------------------------------------------------
# fraud facts and gold aggregates
# ---------------------------------------------------------------------------

@q("fraud_score")
def _fraud_score(spark, d):
    return scores.fraud_score(silver_clean(spark, d), FIXTURE).select(
        "transaction_id", "high_amount_flag", "geo_mismatch_flag", "rapid_txn_flag", "fraud_score"
    )


@q("fraud_class")
def _fraud_class(spark, d):
    return fact_fraud(spark, d).select("transaction_id", "fraud_score", "fraud_risk_category")


@q("fact_fraud_risk")
def _fact_fraud_risk(spark, d):
    return fact_fraud(spark, d)


@q("fraud_distribution")
def _fraud_distribution(spark, d):
    return kpi.class_distribution(fact_fraud(spark, d), "fraud_risk_category")


@q("high_risk_count")
def _high_risk_count(spark, d):
    return kpi.high_risk_count(fact_fraud(spark, d))


@q("alert_top10_accounts")
def _alert_top10(spark, d):
    return kpi.alert_summary(fact_fraud(spark, d), 10)


@q("kpi_daily_fraud")
def _kpi_daily(spark, d):
    return kpi.kpi_daily_fraud(fact_fraud(spark, d))


# ---------------------------------------------------------------------------
# change handling: SCD2 on customers, SCD1 on accounts
# ---------------------------------------------------------------------------
from vaultline.config import AS_OF_2, AS_OF_3  # noqa: E402
from vaultline.operators import dims, scd  # noqa: E402

CUST_KEY, ACC_KEY = "customer_id", "account_id"


def scd2_initial(spark, d):
    return scd.scd2_apply(None, fx.customers(spark, d), CUST_KEY, AS_OF_1)


def scd2_batch2(spark, d, insert_new_keys: bool = True):
    return scd.scd2_apply(
        scd2_initial(spark, d), fx.customers_b2(spark, d), CUST_KEY, AS_OF_2, insert_new_keys=insert_new_keys
    )


def silver_accounts(spark, d):
    b1 = scd.scd1_upsert(None, fx.accounts_b1(spark, d), ACC_KEY, order_by=["load_seq"])
    return scd.scd1_upsert(b1, fx.accounts_b2(spark, d), ACC_KEY, order_by=["load_seq"])


def customers_current(spark, d):
    return scd.current_only(scd2_batch2(spark, d))


@q("scd2_initial")
def _scd2_initial(spark, d):
    return scd2_initial(spark, d)


@q("scd2_expire")
def _scd2_expire(spark, d):
    return scd.scd2_expire(scd2_initial(spark, d), fx.customers_b2(spark, d), CUST_KEY, AS_OF_2)


@q("scd2_changed_keys")
def _scd2_changed_keys(spark, d):
    expired = scd.expired_only(scd.scd2_expire(scd2_initial(spark, d), fx.customers_b2(spark, d), CUST_KEY, AS_OF_2))
    return scd.changed_keys(fx.customers_b2(spark, d), expired, CUST_KEY)


@q("scd2_apply")
def _scd2_apply(spark, d):
    return scd2_batch2(spark, d)


@q("scd2_apply_existing_only")
def _scd2_apply_existing_only(spark, d):
    return scd2_batch2(spark, d, insert_new_keys=False)


@q("scd2_reapply_noop")
def _scd2_reapply_noop(spark, d):
    return scd.scd2_apply(scd2_batch2(spark, d), fx.customers_b2(spark, d), CUST_KEY, AS_OF_3)


@q("scd2_current")
def _scd2_current(spark, d):
    return scd.current_only(scd2_batch2(spark, d))


@q("scd2_expired")
def _scd2_expired(spark, d):
    return scd.expired_only(scd2_batch2(spark, d))


@q("scd2_totals")
def _scd2_totals(spark, d):
    return scd.scd2_totals(scd2_batch2(spark, d))


@q("scd2_invariants")
def _scd2_invariants(spark, d):
    return scd.scd2_invariants(scd2_batch2(spark, d), CUST_KEY)


@q("accounts_dedupe")
def _accounts_dedupe(spark, d):
    """All accounts, many of them sent more than once."""
    sent = fx.accounts_b1(spark, d).unionByName(fx.accounts_b2(spark, d))
    return scd.dedupe(sent, [ACC_KEY], ["load_seq"])


@q("scd1_upsert")
def _scd1_upsert(spark, d):
    return silver_accounts(spark, d)


# ---------------------------------------------------------------------------
# credit risk (current customers after the second customer load)
# ---------------------------------------------------------------------------

def credit_joined(spark, d, nulls: bool = True):
    src = fx.credit_nulls(spark, d) if nulls else fx.credit(spark, d)
    return scores.credit_join(src, customers_current(spark, d))


@q("credit_join")
def _credit_join(spark, d):
    return credit_joined(spark, d, nulls=False)


@q("credit_defaults")
def _credit_defaults(spark, d):
    return scores.recent_defaults(credit_joined(spark, d)).select("customer_id", "last_default_date", "recent_defaults")


@q("credit_loans_norm")
def _credit_loans_norm(spark, d):
    return scores.open_loans_norm(credit_joined(spark, d), SOURCE.loans_cap).select(
        "customer_id", "open_loans", "open_loans_norm"
    )


@q("credit_score")
def _credit_score(spark, d):
    df = (
        credit_joined(spark, d)
        .transform(scores.recent_defaults)
        .transform(scores.open_loans_norm, SOURCE.loans_cap)
        .transform(scores.credit_risk_score, SOURCE)
    )
    return df.select("customer_id", "credit_score", "open_loans_norm", "recent_defaults", "credit_risk_score")


@q("credit_class")
def _credit_class(spark, d):
    fact = scores.build_fact_credit(fx.credit_nulls(spark, d), customers_current(spark, d), SOURCE)
    return fact.select("customer_id", "credit_risk_score", "credit_risk_category")


@q("fact_credit_risk")
def _fact_credit_risk(spark, d):
    return scores.build_fact_credit(fx.credit(spark, d), customers_current(spark, d), SOURCE)


@q("credit_distribution")
def _credit_distribution(spark, d):
    fact = scores.build_fact_credit(fx.credit_nulls(spark, d), customers_current(spark, d), SOURCE)
    return kpi.class_distribution(fact, "credit_risk_category")


# ---------------------------------------------------------------------------
# gold: churn, dimensions
# ---------------------------------------------------------------------------

@q("churn_risk")
def _churn_risk(spark, d):
    return kpi.churn_risk(silver_accounts(spark, d))


@q("churn_distribution")
def _churn_distribution(spark, d):
    return kpi.class_distribution(kpi.churn_risk(silver_accounts(spark, d)), "churn_risk")


@q("dim_customer")
def _dim_customer(spark, d):
    return scd2_batch2(spark, d)


@q("dim_accounts")
def _dim_accounts(spark, d):
    return silver_accounts(spark, d)


@q("dim_date")
def _dim_date(spark, d):
    """Calendar of the full years the transactions span."""
    return dims.build_dim_date_for(silver_raw(spark, d), "txn_date")


@q("distinct_locations")
def _distinct_locations(spark, d):
    return silver_raw(spark, d).select("location").distinct()


@q("location_country_map")
def _location_country_map(spark, d):
    """The literal map: its five cities in four regions, and unknown ones."""
    txn = fx.with_cities(silver_raw(spark, d).select("location"))
    return dims.location_rows(txn).select("location", "country", "region")


@q("location_country_join")
def _location_country_join(spark, d):
    return dims.location_rows(silver_raw(spark, d), fx.location_map(spark, d)).select("location", "country", "region")


@q("dim_location")
def _dim_location(spark, d):
    return dims.build_dim_location(silver_raw(spark, d), fx.location_map(spark, d))


@q("dim_location_extend")
def _dim_location_extend(spark, d):
    """A first load saw only the mapped locations; the unmapped ones
    arrive later and get the next keys while the first keys stay.

    The distinct (location, txn_country) pairs are checkpointed once, so
    silver is computed once for both loads."""
    locs = silver_raw(spark, d).select("location", "txn_country").distinct().checkpoint(eager=True)
    first = dims.build_dim_location(locs.filter(F.col("txn_country") != "Unknown"), fx.location_map(spark, d))
    return dims.extend_dim_location(first, locs, fx.location_map(spark, d))


@q("assign_key_two_phase")
def _assign_key_two_phase(spark, d):
    """Dense surrogate key for customers in name order, without one task."""
    return dims.assign_key(fx.customers(spark, d).select("customer_id", "name"), "name", "customer_key")


# ---------------------------------------------------------------------------
# ingestion, storage layout, incremental loads, quality counts
# ---------------------------------------------------------------------------
from vaultline.operators import quality  # noqa: E402
from vaultline.plans import jobs  # noqa: E402
from vaultline.session import scratch_path  # noqa: E402
from vaultline.sources import tables  # noqa: E402

TXN_SPLIT = "2024-01-16 00:00:00"


@q("audit_columns")
def _audit_columns(spark, d):
    return add_audit(fx.customers(spark, d), "customers.csv", AS_OF_1)


@q("audit_load_time")
def _audit_load_time(spark, d):
    """Audit columns with the time of the load itself: one instant for all of
    the load's rows, and a recent one."""
    base = scratch_path(spark, "audit")
    tables.write_snapshot(add_audit(fx.customers(spark, d), "customers.csv"), base)
    at, now = F.col("created_timestamp"), F.current_timestamp().cast("timestamp_ntz")
    fresh = (F.max(at) <= F.max(now)) & (F.min(at) > F.max(now - F.expr("INTERVAL 1 DAY")))
    rows = tables.read_table(spark, base).groupBy("source_table")
    return rows.agg(F.count("*").alias("rows"), F.countDistinct(at).alias("load_times"), fresh.alias("fresh"))


@q("bronze_customers")
def _bronze_customers(spark, d):
    """Customers written as CSV with columns in another order and one that is
    not declared: bound by name, nothing lost."""
    raw = scratch_path(spark, "raw-customers")
    shuffled = fx.customers(spark, d).select(
        "risk_category", "name", F.upper("name").alias("email"), "customer_id", "customer_type", "country"
    )
    shuffled.write.option("header", True).csv(raw)
    lake = jobs.Lake(scratch_path(spark, "lake"))
    jobs.ingest(spark, lake, "customers", raw, AS_OF_1)
    return tables.read_table(spark, lake.bronze("customers"))


@q("bronze_credit")
def _bronze_credit(spark, d):
    """Credit history with fields that their type cannot take: NULL there, the
    reason kept in ``_corrupt_record``."""
    raw = scratch_path(spark, "raw-credit")
    cid = F.col("customer_id")
    bad = fx.credit(spark, d).select(
        cid,
        F.when(cid % 10 == 3, F.concat(F.col("credit_score").cast("string"), F.lit("x"))).otherwise(F.col("credit_score").cast("string")).alias("credit_score"),
        "open_loans",
        F.when(cid % 10 == 7, F.lit("notadate")).otherwise(F.col("last_default_date").cast("string")).alias("last_default_date"),
    )
    bad.write.option("header", True).csv(raw)
    lake = jobs.Lake(scratch_path(spark, "lake"))
    jobs.ingest(spark, lake, "credit_history", raw, AS_OF_1)
    return tables.read_table(spark, lake.bronze("credit_history"))


@q("bronze_rejected")
def _bronze_rejected(spark, d):
    """Rows that could not be read as declared, from the table of rejected
    rows, with the folder they came from and the reason."""
    raw = scratch_path(spark, "raw-rejected")
    cid = F.col("customer_id")
    score = F.when(cid % 10 == 3, F.concat(F.col("credit_score").cast("string"), F.lit("x"))).otherwise(F.col("credit_score").cast("string"))
    fx.credit(spark, d).withColumn("credit_score", score).write.option("header", True).csv(raw)
    lake = jobs.Lake(scratch_path(spark, "lake"))
    jobs.ingest(spark, lake, "credit_history", raw, AS_OF_1, provenance=True)
    bad = tables.read_table(spark, lake.bronze("credit_history_rejected"))
    folder = F.regexp_extract("source_file", r"/(raw-rejected)-[^/]*/part-[^/]*\.csv$", 1)
    return bad.select(F.get_json_object("record", "$.customer_id").alias("customer_id"), "reason", folder.alias("folder"), "source_table")


@q("bronze_transactions")
def _bronze_transactions(spark, d):
    """Dirty transactions written as JSON Lines, ingested with the declared
    schema; ``metadata`` is shown as JSON text."""
    raw = scratch_path(spark, "raw-transactions")
    fx.transactions_raw(spark, d).write.json(raw)
    return _ingested_transactions(spark, raw)


def _documents(spark, d):
    """The raw rows as files of one indented array of about a thousand rows."""
    raw = scratch_path(spark, "raw-transactions-documents")
    rows = fx.transactions_raw(spark, d)
    buckets = max(1, rows.count() // 1000)
    rows = rows.select(F.pmod(F.xxhash64("transaction_id", "timestamp"), F.lit(buckets)).alias("part"), F.struct(*rows.columns).alias("row"))
    text = rows.groupBy("part").agg(F.to_json(F.collect_list("row"), {"pretty": "true"}).alias("value"))
    text.write.partitionBy("part").text(raw)
    return raw


@q("bronze_transactions_multiline")
def _bronze_transactions_multiline(spark, d):
    """The same rows as documents of about a thousand rows, each a file that
    holds one indented array; how to read them is recognised."""
    return _ingested_transactions(spark, _documents(spark, d)).drop("part")


@q("bronze_transactions_split")
def _bronze_transactions_split(spark, d):
    """The same documents cut between records, whatever their size."""
    return _ingested_transactions(spark, _documents(spark, d) + "/part=*", split_over=0)


def _ingested_transactions(spark, raw, **how):
    lake = jobs.Lake(scratch_path(spark, "lake"))
    jobs.ingest(spark, lake, "transactions", raw, AS_OF_1, **how)
    bronze = tables.read_table(spark, lake.bronze("transactions"))
    return bronze.withColumn("metadata", F.to_json("metadata"))


@q("fact_transactions")
def _fact_transactions(spark, d):
    """Silver copied to a gold path partitioned by day, read back."""
    return tables.publish_copy(spark, silver_raw(spark, d), scratch_path(spark, "fact-transactions"), "txn_date")


@q("cluster_silver")
def _cluster_silver(spark, d):
    """silver_customer laid out clustered by (customer_id, is_current)."""
    path = tables.cluster_table(scd2_batch2(spark, d), ["customer_id", "is_current"], scratch_path(spark, "clustered"))
    return spark.read.parquet(path)


def _txn_batches(spark, d):
    bronze = bronze_txn_raw(spark, d)
    early = F.coalesce(F.try_to_timestamp(F.col("timestamp")) < F.lit(TXN_SPLIT).cast("timestamp"), F.lit(False))
    return bronze.filter(early), bronze.filter(~early)


@q("silver_txn_append")
def _silver_txn_append(spark, d):
    """The later half of the transactions loaded first, then the earlier
    half (late data), then the later half again: equals the one-shot
    silver table (windows cross batch cuts in both directions)."""
    path = scratch_path(spark, "silver-transactions")
    early, late = _txn_batches(spark, d)
    acc, cust, loc = fx.accounts(spark, d), fx.customers(spark, d), fx.location_map(spark, d)
    for batch in (late, early, late):
        jobs.append_silver_transactions(spark, batch, acc, cust, path, FIXTURE, loc)
    return spark.read.parquet(path)


def _appended(spark, d, name, *batches):
    path = scratch_path(spark, name)
    acc, cust, loc = fx.accounts(spark, d), fx.customers(spark, d), fx.location_map(spark, d)
    for batch in batches:
        jobs.append_silver_transactions(spark, batch, acc, cust, path, FIXTURE, loc)
    return spark.read.parquet(path)


@q("silver_txn_resend")
def _silver_txn_resend(spark, d):
    """Transactions sent again on another day or under another account: one
    row each, at the new place, with the windows of both places right."""
    again = add_audit(fx.transactions_resent(spark, d), "transactions.json", AS_OF_1)
    return _appended(spark, d, "silver-resend", bronze_txn_raw(spark, d), again)


@q("silver_txn_dup_ids")
def _silver_txn_dup_ids(spark, d):
    """Every 30th id twice in one batch, the second time an hour older; then
    two more loads of parts of it: still one row an id."""
    whole = bronze_txn_raw(spark, d)
    older = F.date_format(F.try_to_timestamp(F.col("timestamp")) - F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss")
    twice = whole.unionByName(whole.where("transaction_id % 30 = 0").withColumn("timestamp", older))
    return _appended(spark, d, "silver-dup-ids", twice, whole.where("transaction_id % 30 = 0"), whole.where("transaction_id % 7 = 0"))


@q("silver_txn_moved_day")
def _silver_txn_moved_day(spark, d):
    """All transactions of some days sent again for another year: these days
    are empty then, and gone."""
    whole = bronze_txn_raw(spark, d)
    at = F.try_to_timestamp(F.col("timestamp"))
    later = F.date_format(at + F.expr("INTERVAL 400 DAY"), "yyyy-MM-dd HH:mm:ss")
    moved = whole.where(F.dayofmonth(at) == 3).withColumn("timestamp", later)
    return _appended(spark, d, "silver-moved-day", whole, moved)


@q("alert_top10_incremental")
def _alert_top10_incremental(spark, d):
    """Top accounts from partial sums per day, over two loads: the second
    brings new days and changes days of the first; only those are read again."""
    fact = fact_fraud(spark, d).checkpoint()
    path, alerts = scratch_path(spark, "fact-alerts"), scratch_path(spark, "alert-days")
    first = fact.where("day(txn_date) < 15 and not (day(txn_date) = 7 and transaction_id % 2 = 0)")
    tables.write_partitioned(first, path, "txn_date")
    jobs.update_alerts(spark, path, alerts)
    second = fact.where("txn_date is null or day(txn_date) >= 15 or day(txn_date) = 7")
    days = [r[0] for r in second.select("txn_date").distinct().collect()]
    tables.overwrite_partitions(second, path, "txn_date")
    return kpi.alert_summary_of(jobs.update_alerts(spark, path, alerts, days))


@q("scd2_stored_loads")
def _scd2_stored_loads(spark, d):
    """Three stored customer loads, two of them as of the same time; the
    third undoes the second's changes.  No version is lost."""
    lake = jobs.Lake(scratch_path(spark, "lake-scd2"))
    for batch, as_of in ((fx.customers(spark, d), AS_OF_1), (fx.customers_b2(spark, d), AS_OF_2), (fx.customers(spark, d), AS_OF_2)):
        tables.write_snapshot(batch, lake.bronze("customers"))
        jobs.load_silver_customers(spark, lake, as_of)
    return jobs.read_silver_customers(spark, lake)


@q("scd1_stored_loads")
def _scd1_stored_loads(spark, d):
    """Two stored account loads.  A first write that died is no table, so the
    first load is one; the second finds the table and merges."""
    lake = jobs.Lake(scratch_path(spark, "lake-scd1"))
    base = lake.silver("accounts")
    fx.accounts_b2(spark, d).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(tables.version_path(base, 1))
    for batch, there in ((fx.accounts_b1(spark, d), False), (fx.accounts_b2(spark, d), True)):
        if tables.table_exists(spark, base) != there:
            raise AssertionError(f"{base}: expected {'a' if there else 'no'} table")
        tables.write_snapshot(batch, lake.bronze("accounts"))
        jobs.load_silver_accounts(spark, lake, order_by=["load_seq"])
    return tables.read_table(spark, base)


@q("fact_transactions_rewrite")
def _fact_transactions_rewrite(spark, d):
    """A full rewrite with fewer days replaces the table: the days that are
    gone go, whatever the session's overwrite mode."""
    path = scratch_path(spark, "fact-rewrite")
    silver = silver_raw(spark, d)
    tables.publish_copy(spark, silver, path, "txn_date")
    fewer = silver.where(F.dayofmonth("txn_date") > 5)
    return tables.publish_copy(spark, fewer, path, "txn_date")


@q("snapshot_append")
def _snapshot_append(spark, d):
    """Two appends to a snapshot table, none of which rewrites it."""
    base = scratch_path(spark, "snapshot-append")
    c = fx.customers(spark, d)
    tables.write_snapshot(c.where("customer_id % 3 = 0"), base)
    tables.append_snapshot(c.where("customer_id % 3 = 1"), base)
    tables.append_snapshot(c.where("customer_id % 3 = 2").withColumn("note", F.lit("late")), base)
    return tables.read_table(spark, base)


@q("snapshot_evolve")
def _snapshot_evolve(spark, d):
    """Overwrite that may add columns but not change the type of any."""
    base = scratch_path(spark, "snapshot-evolve")
    c = fx.customers(spark, d)
    tables.write_snapshot(c, base)
    tables.write_snapshot(c.withColumn("name_length", F.length("name")), base, mode="evolve", merge_schema=True, verify=True)
    return tables.read_table(spark, base)


@q("snapshot_widen")
def _snapshot_widen(spark, d):
    """Columns that widen: int to long and long to double by an append, whose
    older files are cast as they are read, then int to long by a new version."""
    base = scratch_path(spark, "snapshot-widen")
    c = fx.customers(spark, d).select("customer_id", F.length("name").alias("n"), F.col("customer_id").cast("long").alias("v"), F.lit(1).alias("k"))
    tables.write_snapshot(c.where("customer_id % 2 = 0"), base)
    wider = c.where("customer_id % 2 = 1").select("customer_id", (F.col("n") + F.lit(3_000_000_000)).alias("n"), (F.col("v") + F.lit(0.5)).alias("v"), "k")
    tables.append_snapshot(wider, base)
    both = tables.read_table(spark, base)
    tables.write_snapshot(both.withColumn("k", F.col("k").cast("long") + F.lit(5_000_000_000)), base, mode="evolve")
    return tables.read_table(spark, base)


@q("publish_table")
def _publish_table(spark, d):
    """A managed table written twice, the second time with other rows."""
    # a folder left by an earlier session would block a fixed name
    name = "vaultline_published_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    tables.publish(scd2_initial(spark, d), name)
    tables.publish(scd2_batch2(spark, d), name)
    return spark.table(name)


@q("publish_new_table")
def _publish_new_table(spark, d):
    """A managed table written without a mode: a second write is refused and
    leaves the table as it is."""
    name = "vaultline_new_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    tables.publish(scd2_initial(spark, d), name, mode="errorifexists")
    try:
        tables.publish(scd2_batch2(spark, d), name, mode="errorifexists")
    except AnalysisException:
        return spark.table(name)
    raise AssertionError(f"{name} was written a second time")


@q("txn_quality_counts")
def _txn_quality_counts(spark, d):
    """Counts observed while writing silver in one job (no extra passes)."""
    path = scratch_path(spark, "silver-observed")
    m = jobs.append_silver_transactions(
        spark, bronze_txn_raw(spark, d), fx.accounts(spark, d), fx.customers(spark, d), path, FIXTURE,
        fx.location_map(spark, d),
    )
    cols = ["raw_rows", "kept_rows", "dropped_rows", "high_amount_rows", "rapid_rows", "geo_mismatch_rows",
            "matched_rows", "unmatched_rows"]
    return spark.createDataFrame([tuple(int(m[c]) for c in cols)], ", ".join(f"{c} long" for c in cols))


@q("silver_txn_stream")
def _silver_txn_stream(spark, d):
    """Dirty transactions landed as JSON files and loaded by the stream,
    two files per micro-batch, each file spanning the whole time range (so
    every micro-batch is partly late): equals the one-shot
    silver table."""
    from vaultline.streaming import start_transaction_stream

    landing = scratch_path(spark, "landing")
    fx.transactions_raw(spark, d).repartition(4).write.json(landing)
    path = scratch_path(spark, "silver-stream")
    acc, cust, loc = fx.accounts(spark, d), fx.customers(spark, d), fx.location_map(spark, d)
    query = start_transaction_stream(
        spark, landing, path, lambda: acc, lambda: cust, FIXTURE, loc, as_of=AS_OF_1, max_files_per_trigger=2
    )
    query.awaitTermination()
    got = spark.read.parquet(path)
    # the stream reads ids as text (declared raw schema); show them typed
    return got.withColumns(
        {"transaction_id": F.col("transaction_id").cast("long"), "account_id": F.col("account_id").cast("long")}
    )


@q("scd1_invariants")
def _scd1_invariants(spark, d):
    """silver_accounts after two loads: one row per account_id."""
    return quality.key_uniqueness(silver_accounts(spark, d), ACC_KEY)
