"""Transaction cleaning, flags and enrichment -> silver_transactions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from vaultline.config import LOCATION_COUNTRY, UNKNOWN, RiskConfig
from vaultline.functions.exprs import flag, parse_timestamp, unix_seconds
from vaultline.operators.lookup import lookup_join, lookup_map
from vaultline.operators.rolling import rolling_count, rolling_count_plain

METADATA_FIELDS = ("device", "ip_address", "channel")

# fixed values: output columns of silver
SILVER_COLUMNS = (
    "transaction_id",
    "account_id",
    "customer_id",
    "amount",
    "currency",
    "transaction_type",
    "merchant",
    "location",
    "txn_country",
    "home_country",
    "txn_timestamp",
    "transaction_hour",
    "txn_date",
    "high_amount_flag",
    "rapid_txn_flag",
    "geo_mismatch_flag",
    "created_timestamp",
    "source_table",
)
WINDOW_COUNT = "txn_window_count"


def flatten_struct(df: DataFrame, col: str = "metadata", fields: Sequence[str] = METADATA_FIELDS) -> DataFrame:
    """Lift ``fields`` of the struct ``col`` to top-level columns and drop it.

    No struct column: the frame passes through.  A field the struct lacks
    becomes a typed NULL column instead of an analysis error.
    """
    if col not in df.columns:
        return df
    dtype = df.schema[col].dataType
    present = set(dtype.fieldNames()) if isinstance(dtype, StructType) else set()
    cols = {f: (F.col(col).getField(f) if f in present else F.lit(None).cast("string")) for f in fields}
    return df.withColumns(cols).drop(col)


def _numeric(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return c if isinstance(df.schema[name].dataType, NumericType) else c.try_cast("double")


def clean_transactions(df: DataFrame, id_col: str = "transaction_id", amount_col: str = "amount") -> DataFrame:
    """Keep rows with an id and a positive amount (NULL amount is dropped)."""
    return df.filter(F.col(id_col).isNotNull() & (_numeric(df, amount_col) > F.lit(0)))


def add_time_parts(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """txn_timestamp (wall clock), transaction_hour (0-23), txn_date."""
    df = df.withColumn("txn_timestamp", parse_timestamp(df, col))
    return df.withColumns(
        {"transaction_hour": F.hour("txn_timestamp"), "txn_date": F.to_date("txn_timestamp")}
    )


def high_amount_flag(df: DataFrame, threshold: float = 50000.0, amount_col: str = "amount") -> DataFrame:
    return df.withColumn("high_amount_flag", flag(_numeric(df, amount_col) > F.lit(float(threshold))))


def txn_window_count(df: DataFrame, cfg: RiskConfig, key: str = "account_id") -> DataFrame:
    """Rolling per-account count of transactions in the trailing window."""
    df = df.withColumn("txn_unix", unix_seconds(F.col("txn_timestamp")))
    if not cfg.skew_safe_window:
        return rolling_count_plain(
            df, key, "txn_unix", cfg.rapid_window_s, "transaction_id", WINDOW_COUNT, null_peers=cfg.null_peers
        )
    return rolling_count(
        df,
        key,
        "txn_unix",
        cfg.rapid_window_s,
        "transaction_id",
        WINDOW_COUNT,
        bucket_seconds=cfg.rapid_bucket_s,
        null_peers=cfg.null_peers,
    )


def rapid_flag(df: DataFrame, cfg: RiskConfig) -> DataFrame:
    """1 when more than ``rapid_limit`` transactions fall in the window."""
    if WINDOW_COUNT not in df.columns:
        df = txn_window_count(df, cfg)
    return df.withColumn("rapid_txn_flag", flag(F.col(WINDOW_COUNT) > F.lit(cfg.rapid_limit)))


def current_customers_home(customers_current: DataFrame) -> DataFrame:
    return customers_current.select("customer_id", F.col("country").alias("home_country"))


def join_accounts(df: DataFrame, accounts: DataFrame) -> DataFrame:
    """Left join to accounts for customer_id (accounts unique per id)."""
    return df.join(accounts.select("account_id", "customer_id"), "account_id", "left")


def join_customers(df: DataFrame, customers_current: DataFrame) -> DataFrame:
    """Left join to current customers for home_country."""
    return df.join(current_customers_home(customers_current), "customer_id", "left")


def account_dimension(accounts: DataFrame, customers_current: DataFrame) -> DataFrame:
    """account_id -> (customer_id, home_country), joined once on the small
    side so that the transactions are shuffled for one join, not two.

    (T left-join A) left-join_{A.customer_id} C == T left-join (A left-join C)
    because the second condition only reads columns of A.
    """
    return accounts.select("account_id", "customer_id").join(
        current_customers_home(customers_current), "customer_id", "left"
    )


def txn_country(
    df: DataFrame,
    mapping: Mapping[str, str] | DataFrame | None = None,
    location_col: str = "location",
    out: str = "txn_country",
) -> DataFrame:
    """Country of the transaction location; unknown or NULL -> Unknown."""
    if mapping is None:
        mapping = LOCATION_COUNTRY
    if isinstance(mapping, DataFrame):
        return lookup_join(df, location_col, mapping, "location", "country", out, UNKNOWN)
    return lookup_map(df, location_col, mapping, out, UNKNOWN)


def geo_mismatch_flag(df: DataFrame) -> DataFrame:
    tc, hc = F.col("txn_country"), F.col("home_country")
    return df.withColumn("geo_mismatch_flag", flag((tc != hc) & (tc != F.lit(UNKNOWN)) & hc.isNotNull()))


def _with_audit(df: DataFrame) -> DataFrame:
    add = {}
    if "created_timestamp" not in df.columns:
        add["created_timestamp"] = F.lit(None).cast("timestamp")
    if "source_table" not in df.columns:
        add["source_table"] = F.lit(None).cast("string")
    return df.withColumns(add) if add else df


def prepare_transactions(bronze: DataFrame, cfg: RiskConfig, time_col: str | None = None) -> DataFrame:
    """Narrow part of D5: flatten, clean, parse time, high-amount flag."""
    if time_col is None:
        time_col = "timestamp" if "timestamp" in bronze.columns else "ts"
    return (
        bronze.transform(flatten_struct)
        .transform(clean_transactions)
        .transform(add_time_parts, time_col)
        .transform(high_amount_flag, cfg.high_amount)
    )


def enrich_transactions(
    flagged: DataFrame,
    accounts: DataFrame,
    customers_current: DataFrame,
    location_map: Mapping[str, str] | DataFrame | None = None,
) -> DataFrame:
    """Join part of D5: customer, home country, txn country, geo flag, select."""
    df = flagged.join(account_dimension(accounts, customers_current), "account_id", "left")
    df = txn_country(df, location_map).transform(geo_mismatch_flag)
    return _with_audit(df).select(*SILVER_COLUMNS)


def build_silver_transactions(
    bronze: DataFrame,
    accounts: DataFrame,
    customers_current: DataFrame,
    cfg: RiskConfig,
    location_map: Mapping[str, str] | DataFrame | None = None,
    time_col: str | None = None,
) -> DataFrame:
    """Bronze transactions -> the 18 silver columns, as one lazy plan.

    Shuffles: one for the (account, time bucket) window, one for the join
    to the account dimension (none if AQE broadcasts a small dimension).
    """
    prepared = prepare_transactions(bronze, cfg, time_col)
    return enrich_transactions(rapid_flag(prepared, cfg), accounts, customers_current, location_map)


def rapid_flag_with_context(
    prepared: DataFrame, context: DataFrame | None, cfg: RiskConfig, keep_context: bool = False
) -> DataFrame:
    """Rapid flag of ``prepared`` rows counting earlier-loaded rows too.

    ``context`` holds (transaction_id, account_id, txn_timestamp) of rows
    already in silver near the batch; they take part in the window (marked
    ``_ctx``) and are dropped after it unless ``keep_context``.
    """
    if context is None:
        return rapid_flag(prepared, cfg)
    ctx = context.withColumn("_ctx", F.lit(True))
    both = prepared.withColumn("_ctx", F.lit(False)).unionByName(ctx, allowMissingColumns=True)
    flagged = rapid_flag(both, cfg)
    return flagged if keep_context else flagged.filter(~F.col("_ctx")).drop("_ctx")
