"""Fraud and credit risk scores and classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.config import RiskConfig
from vaultline.functions.exprs import classify, flag, weighted_sum

# fixed values: output columns of the fact
FACT_FRAUD_COLUMNS = (
    "transaction_id",
    "account_id",
    "customer_id",
    "amount",
    "currency",
    "transaction_type",
    "merchant",
    "location",
    "txn_timestamp",
    "transaction_hour",
    "txn_date",
    "high_amount_flag",
    "rapid_txn_flag",
    "geo_mismatch_flag",
    "fraud_score",
    "fraud_risk_category",
)

# fixed values: output columns of the fact
FACT_CREDIT_COLUMNS = (
    "customer_id",
    "name",
    "country",
    "customer_type",
    "risk_category",
    "credit_score",
    "open_loans",
    "open_loans_norm",
    "last_default_date",
    "recent_defaults",
    "credit_risk_score",
    "credit_risk_category",
)


def fraud_score(df: DataFrame, cfg: RiskConfig) -> DataFrame:
    wh, wg, wr = cfg.fraud_weights
    s = weighted_sum(
        [(F.col("high_amount_flag"), wh), (F.col("geo_mismatch_flag"), wg), (F.col("rapid_txn_flag"), wr)]
    )
    return df.withColumn("fraud_score", F.round(s, 2))


def fraud_class(df: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Low / Medium / High; a NULL score is High, as in the source."""
    return df.withColumn("fraud_risk_category", classify(F.col("fraud_score"), cfg.fraud_low, cfg.fraud_medium))


def build_fact_fraud(silver_txn: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Narrow projection over silver: no shuffle."""
    return silver_txn.transform(fraud_score, cfg).transform(fraud_class, cfg).select(*FACT_FRAUD_COLUMNS)


def recent_defaults(df: DataFrame) -> DataFrame:
    """1 when a default date is recorded at all (no recency test)."""
    return df.withColumn("recent_defaults", flag(F.col("last_default_date").isNotNull()))


def open_loans_norm(df: DataFrame, cap: float = 10.0) -> DataFrame:
    """loans / cap, capped at 1.0 and rounded to 2 places; NULL stays NULL."""
    r = F.col("open_loans") / F.lit(float(cap))
    return df.withColumn("open_loans_norm", F.when(r > F.lit(1.0), F.lit(1.0)).otherwise(F.round(r, 2)))


def credit_risk_score(df: DataFrame, cfg: RiskConfig) -> DataFrame:
    ws, wl, wd = cfg.credit_weights
    score_term = F.lit(1.0) - F.col("credit_score") / F.lit(float(cfg.max_credit_score))
    s = weighted_sum([(score_term, ws), (F.col("open_loans_norm"), wl), (F.col("recent_defaults"), wd)])
    return df.withColumn("credit_risk_score", F.round(s, 2))


def credit_class(df: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Low / Medium / High; a NULL score is Unknown."""
    return df.withColumn(
        "credit_risk_category",
        classify(F.col("credit_risk_score"), cfg.credit_low, cfg.credit_medium, null_label="Unknown"),
    )


def credit_join(credit: DataFrame, customers_current: DataFrame) -> DataFrame:
    """Inner join: credit rows without a current customer are dropped."""
    return credit.join(
        customers_current.select("customer_id", "name", "country", "customer_type", "risk_category"),
        "customer_id",
        "inner",
    )


def build_fact_credit(credit: DataFrame, customers_current: DataFrame, cfg: RiskConfig) -> DataFrame:
    return (
        credit_join(credit, customers_current)
        .transform(recent_defaults)
        .transform(open_loans_norm, cfg.loans_cap)
        .transform(credit_risk_score, cfg)
        .transform(credit_class, cfg)
        .select(*FACT_CREDIT_COLUMNS)
    )
