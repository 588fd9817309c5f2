"""Gold aggregates: distributions, alerts, daily KPI, churn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.config import CHURN_BY_STATUS, CHURN_DEFAULT
from vaultline.functions.exprs import exact_mean, lookup_expr, units


def churn_risk(accounts: DataFrame, status_col: str = "status") -> DataFrame:
    """Closed -> Churned, Dormant -> High, anything else (or NULL) -> Low.
    Case-sensitive, as in the source."""
    return accounts.withColumn("churn_risk", lookup_expr(F.col(status_col), CHURN_BY_STATUS, CHURN_DEFAULT))


def class_distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows per class (partial aggregation map-side, so hot classes are fine)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def high_risk_count(fact_fraud: DataFrame, label: str = "High") -> DataFrame:
    return fact_fraud.agg(F.count_if(F.col("fraud_risk_category") == F.lit(label)).alias("high_risk_count"))


def alert_summary(fact_fraud: DataFrame, k: int = 10, label: str = "High") -> DataFrame:
    """Top-k accounts by number of ``label`` transactions.

    Ties are broken by total amount (desc) then account_id (asc), so the
    cut is deterministic.  The amount sum is rounded to 2 places and the
    mean score is exact (integer units, rounded once to 4 places), so the
    result does not depend on the order of floating-point additions.
    The plan is partial agg -> shuffle -> final agg -> TakeOrderedAndProject;
    only k rows per task ever reach the driver.
    """
    agg = (
        fact_fraud.filter(F.col("fraud_risk_category") == F.lit(label))
        .groupBy("account_id")
        .agg(
            F.count("transaction_id").alias("high_risk_txn_count"),
            F.round(F.sum("amount"), 2).alias("total_amount"),
            F.sum(units(F.col("fraud_score"))).alias("_su"),
            F.count("fraud_score").alias("_sn"),
        )
        .withColumn("avg_fraud_score", exact_mean("_su", "_sn"))
        .drop("_su", "_sn")
    )
    return agg.orderBy(F.desc("high_risk_txn_count"), F.desc("total_amount"), F.asc("account_id")).limit(k)


def alert_partials(fact_fraud: DataFrame, label: str = "High") -> DataFrame:
    """Per day and account: what ``alert_summary`` and ``high_risk_count`` need
    of the ``label`` rows, in forms that add up exactly whatever the order: row
    counts, the amount as a decimal, scores in integer units.  A day's partials
    depend on that day's rows alone."""
    return (
        fact_fraud.filter(F.col("fraud_risk_category") == F.lit(label))
        .groupBy("txn_date", "account_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("transaction_id").alias("txns"),
            F.sum(F.col("amount").cast("decimal(28,8)")).alias("amount"),
            F.sum(units(F.col("fraud_score"))).alias("score_units"),
            F.count("fraud_score").alias("scores"),
        )
    )


def alert_summary_of(partials: DataFrame, k: int = 10) -> DataFrame:
    """``alert_summary`` from the partials of all days."""
    agg = (
        partials.groupBy("account_id")
        .agg(
            F.sum("txns").alias("high_risk_txn_count"),
            F.round(F.sum("amount"), 2).cast("double").alias("total_amount"),
            F.sum("score_units").alias("_su"),
            F.sum("scores").alias("_sn"),
        )
        .withColumn("avg_fraud_score", exact_mean("_su", "_sn"))
        .drop("_su", "_sn")
    )
    return agg.orderBy(F.desc("high_risk_txn_count"), F.desc("total_amount"), F.asc("account_id")).limit(k)


def high_risk_count_of(partials: DataFrame) -> DataFrame:
    return partials.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("high_risk_count"))


def kpi_daily_fraud(fact_fraud: DataFrame, ordered: bool = True) -> DataFrame:
    """Per day and class: transactions, amount (2 places), mean score (4).

    Scores hold 2 decimals, so the mean is taken over exact integer units
    and rounded once (HALF_UP): a mean that lands exactly on a rounding
    tie (e.g. 0.30805) no longer flips with the order of additions.

    Partial aggregation runs before the shuffle, so a hot day costs no
    more than any other; the sort is over the small aggregated result
    (days x classes).
    """
    agg = (
        fact_fraud.groupBy("txn_date", "fraud_risk_category")
        .agg(
            F.count("transaction_id").alias("transaction_count"),
            F.round(F.sum("amount"), 2).alias("total_amount"),
            F.sum(units(F.col("fraud_score"))).alias("_su"),
            F.count("fraud_score").alias("_sn"),
        )
        .withColumn("avg_fraud_score", exact_mean("_su", "_sn"))
        .drop("_su", "_sn")
    )
    return agg.orderBy("txn_date", "fraud_risk_category") if ordered else agg
