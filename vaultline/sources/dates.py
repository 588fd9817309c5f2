"""Generated date spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: str, end: str, name: str = "full_date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))).alias(name)
    )


def year_spine_of(df: DataFrame, date_col: Column | str, name: str = "full_date") -> DataFrame:
    """Every day of the calendar years that ``date_col`` spans.

    The bounds come from one aggregate inside the plan (no driver round
    trip); the spine is at most 366 rows per year spanned.
    """
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    bounds = df.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    return bounds.filter(F.col("lo").isNotNull()).select(
        F.explode(
            F.sequence(
                F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
                F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
                F.expr("interval 1 day"),
            )
        ).alias(name)
    )
