"""Lookups of a code to a label (J7), as a literal map or a table join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.exprs import lookup_expr


def lookup_map(df: DataFrame, key: str, mapping: Mapping[str, str], out: str, default: str | None) -> DataFrame:
    """Literal map in the plan: no join, no shuffle."""
    return df.withColumn(out, lookup_expr(F.col(key), mapping, default))


def lookup_join(
    df: DataFrame,
    key: str,
    mapping: DataFrame,
    map_key: str,
    map_value: str,
    out: str,
    default: str | None,
) -> DataFrame:
    """Left join to a mapping table; unmatched or NULL keys get ``default``.

    The mapping is reduced to one value per key first (the smallest), so a
    duplicated mapping row can never multiply the input rows.  Whether the
    mapping is broadcast is Spark's choice by its size at run time.
    """
    m = mapping.groupBy(F.col(map_key).alias("_lk")).agg(F.min(map_value).alias("_lv"))
    joined = df.join(m, df[key] == m["_lk"], "left")
    val = F.col("_lv") if default is None else F.coalesce(F.col("_lv"), F.lit(default))
    return joined.withColumn(out, val).drop("_lk", "_lv")
