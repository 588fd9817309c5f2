"""Bindings of the driver's TPC-H-like test tables to the bank model.

Each function reads whole tables under ``sf_dir`` and returns the bank
table the pipeline expects; nothing is sampled.  The same definitions in
DuckDB SQL live in ``plans/oracle.py`` (FIXTURES.md part 2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.sources.files import read_parquet


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", reuse=True)  # given tables do not change


def _k(props: str = "props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def location_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """location -> country for 20 of the 25 locations (the rest are unknown)."""
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    return (
        n.filter(F.col("n_nationkey") < 20)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(F.col("n_name").alias("location"), F.col("r_name").alias("country"))
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean transactions: every event is one transaction."""
    e = _t(spark, sf_dir, "events")
    k = _k()
    return e.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        F.col("value").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("event_type").alias("transaction_type"),
        F.concat(F.lit("M"), (k % 10).cast("string")).alias("merchant"),
        F.concat(F.lit("NATION_"), (k % 25).cast("string")).alias("location"),
        F.col("ts"),
    )


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty transactions: NULL ids, non-positive / NULL amounts, NULL
    locations, text timestamps and a nested ``metadata`` struct."""
    e = _t(spark, sf_dir, "events")
    k = _k()
    eid = F.col("event_id")
    return e.select(
        F.when(eid % 101 == 0, F.lit(None)).otherwise(eid).alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        F.when(eid % 103 == 0, -F.col("value"))
        .when(eid % 109 == 0, F.lit(0.0))
        .when(eid % 113 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value"))
        .alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("event_type").alias("transaction_type"),
        F.concat(F.lit("M"), (k % 10).cast("string")).alias("merchant"),
        F.when(eid % 107 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("NATION_"), (k % 25).cast("string")))
        .alias("location"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.struct(
            F.concat(F.lit("d"), (k % 3).cast("string")).alias("device"),
            F.concat(F.lit("10.0.0."), k.cast("string")).alias("ip_address"),
            F.col("event_type").alias("channel"),
        ).alias("metadata"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("account_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(st == "F", "Closed").when(st == "P", "Dormant").otherwise("Active").alias("status"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")
    r = _t(spark, sf_dir, "region")
    bal = F.col("c_acctbal")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("r_name").alias("country"),
            F.col("c_mktsegment").alias("customer_type"),
            F.when(bal < 0, "High").when(bal < 5000, "Medium").otherwise("Low").alias("risk_category"),
        )
    )


def credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    o = _t(spark, sf_dir, "orders")
    per_cust = o.groupBy(F.col("o_custkey")).agg(
        F.count_if(F.col("o_orderstatus") == "O").alias("n_open"),
        F.max(
            F.when(
                (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("2000-06-01").cast("timestamp_ntz")),
                F.col("o_orderdate"),
            )
        )
        .cast("date")
        .alias("last_f"),
    )
    return c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.floor(F.lit(300.0) + (F.col("c_acctbal") + F.lit(1000.0)) * F.lit(0.05)).cast("int").alias("credit_score"),
        F.coalesce(F.col("n_open"), F.lit(0)).cast("int").alias("open_loans"),
        F.col("last_f").alias("last_default_date"),
    )


def credit_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    cid = F.col("customer_id")
    return credit(spark, sf_dir).select(
        cid,
        F.when(cid % 50 == 0, F.lit(None).cast("int")).otherwise(F.col("credit_score")).alias("credit_score"),
        F.when(cid % 70 == 0, F.lit(None).cast("int")).otherwise(F.col("open_loans")).alias("open_loans"),
        F.col("last_default_date"),
    )


_NEXT_TYPE = {
    "AUTOMOBILE": "BUILDING",
    "BUILDING": "FURNITURE",
    "FURNITURE": "HOUSEHOLD",
    "HOUSEHOLD": "MACHINERY",
}


def customers_b2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second customer load: every 7th key changes type, every 11th is
    missing, and keys + 1,000,000 of every 50th customer are new."""
    base = customers(spark, sf_dir)
    cid = F.col("customer_id")
    ct = F.col("customer_type")
    nxt = None
    for a, b in _NEXT_TYPE.items():
        nxt = F.when(ct == a, b) if nxt is None else nxt.when(ct == a, b)
    nxt = nxt.otherwise("AUTOMOBILE")
    kept = base.filter(cid % 11 != 0).select(
        cid,
        "name",
        "country",
        F.when(cid % 7 != 0, ct).otherwise(nxt).alias("customer_type"),
        "risk_category",
    )
    new = base.filter(cid % 50 == 0).select(
        (cid + F.lit(1000000)).alias("customer_id"), "name", "country", "customer_type", "risk_category"
    )
    return kept.unionByName(new)


def accounts_b1(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = accounts(spark, sf_dir)
    return a.filter(F.col("account_id") % 10 != 9).withColumn("load_seq", F.lit(1))


def accounts_b2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second account load: overlaps batch 1, adds keys ending in 9 and
    holds duplicate keys (the higher ``load_seq`` is the later one)."""
    a = accounts(spark, sf_dir)
    aid = F.col("account_id")
    closed = a.filter(aid % 10 >= 7).select("account_id", "customer_id", F.lit("Closed").alias("status"), F.lit(1).alias("load_seq"))
    dormant = a.filter(aid % 20 == 19).select(
        "account_id", "customer_id", F.lit("Dormant").alias("status"), F.lit(2).alias("load_seq")
    )
    return closed.unionByName(dormant)


#: the literal map's cities, in place of the first location codes
CITIES = ("Mumbai", "Delhi", "London", "New York", "Toronto")


def with_cities(df: DataFrame, location: str = "location") -> DataFrame:
    """Locations NATION_0 to NATION_4 under the names of the literal map."""
    out = F.col(location)
    for k, city in enumerate(CITIES):
        out = F.when(F.col(location) == f"NATION_{k}", city).otherwise(out)
    return df.withColumn(location, out)


def transactions_without_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty transactions of which every 97th names an account nobody has,
    every 89th none at all, and every 83rd has no readable time."""
    t = transactions_raw(spark, sf_dir)
    tid = F.coalesce(F.col("transaction_id"), F.lit(0))
    account = F.when(tid % 97 == 0, F.lit(-1).cast("long")).when(tid % 89 == 0, F.lit(None)).otherwise(F.col("account_id"))
    return t.withColumns({"account_id": account, "timestamp": F.when(tid % 83 == 0, "no time").otherwise(F.col("timestamp"))})


def transactions_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 20th transaction again: half with a time three days later, half
    under the next account."""
    t = transactions_raw(spark, sf_dir).where(F.col("transaction_id") % 20 == 0)
    moved = F.col("transaction_id") % 40 == 0
    later = F.date_format(F.try_to_timestamp(F.col("timestamp")) + F.expr("INTERVAL 3 DAYS"), "yyyy-MM-dd HH:mm:ss")
    return t.withColumns({
        "timestamp": F.when(moved, later).otherwise(F.col("timestamp")),
        "account_id": F.when(moved, F.col("account_id")).otherwise(F.col("account_id") + 1),
    })
