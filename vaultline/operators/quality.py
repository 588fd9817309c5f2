"""Data-quality checks (Q1-Q5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def observe_raw(df: DataFrame) -> tuple[DataFrame, Observation]:
    obs = Observation("raw_input")
    return df.observe(obs, F.count(F.lit(1)).alias("raw_rows")), obs


def observe_silver(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts the source pipeline printed one action at a time, gathered
    by the write itself: no extra job over the data."""
    obs = Observation("silver_output")
    cid = F.col("customer_id")
    return (
        df.observe(
            obs,
            F.count(F.lit(1)).alias("kept_rows"),
            F.count_if(F.col("high_amount_flag") == 1).alias("high_amount_rows"),
            F.count_if(F.col("rapid_txn_flag") == 1).alias("rapid_rows"),
            F.count_if(F.col("geo_mismatch_flag") == 1).alias("geo_mismatch_rows"),
            F.count_if(cid.isNotNull()).alias("matched_rows"),
            F.count_if(cid.isNull()).alias("unmatched_rows"),
        ),
        obs,
    )


def quality_row(raw: Observation, silver: Observation) -> dict:
    m = dict(raw.get)
    m.update(silver.get)
    m["dropped_rows"] = m["raw_rows"] - m["kept_rows"]
    return m


def expect_count(df: DataFrame, expected: int, label: str = "rows") -> int:
    n = df.count()
    if n != expected:
        raise AssertionError(f"{label}: expected {expected}, got {n}")
    return n


def assert_schema(df: DataFrame, expected: StructType | Mapping[str, str]) -> None:
    """Column names and types must match (order-insensitive)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = (
        {f.name: f.dataType.simpleString() for f in expected.fields}
        if isinstance(expected, StructType)
        else dict(expected)
    )
    if have != want:
        raise AssertionError(f"schema mismatch: have {have}, want {want}")


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, keys held by more than one row.

    Partial aggregation per key before the shuffle, then one global
    aggregate over the per-key counts.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
    )
