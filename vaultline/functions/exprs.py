"""Column-level building blocks.  No Python UDF anywhere."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from vaultline.config import RISK_LABELS


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (NULL counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def parse_timestamp(df: DataFrame, name: str) -> Column:
    """Wall-clock timestamp (``timestamp_ntz``) of a text or timestamp column.

    Text that does not parse gives NULL instead of failing the job (ANSI
    mode would raise on ``to_timestamp``).  ISO ``T`` and space forms parse.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, TimestampNTZType):
        return c
    if isinstance(dtype, TimestampType):
        return c.cast("timestamp_ntz")
    if not isinstance(dtype, StringType):
        c = c.cast("string")
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def unix_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch (truncated), as a long."""
    return F.unix_timestamp(ts)


def weighted_sum(terms: Iterable[tuple[Column, float]]) -> Column:
    total = None
    for c, w in terms:
        t = c * F.lit(float(w))
        total = t if total is None else total + t
    return total


def classify(score: Column, low: float, medium: float, null_label: str | None = None) -> Column:
    """< low -> Low, < medium -> Medium, else High.

    With ``null_label`` a NULL score gets that label; without it a NULL
    score falls through to High (the fraud classifier's behaviour).
    """
    lo, mid, hi = RISK_LABELS
    expr = F.when(score < F.lit(low), F.lit(lo)).when(score < F.lit(medium), F.lit(mid))
    if null_label is not None:
        expr = F.when(score.isNull(), F.lit(null_label)).when(score < F.lit(low), F.lit(lo)).when(
            score < F.lit(medium), F.lit(mid)
        )
    return expr.otherwise(F.lit(hi))


def units(value: Column, scale: int = 2) -> Column:
    """Exact integer units of a value held to ``scale`` decimals (e.g. a
    score rounded to 2 places: 0.3 -> 30), summable without float noise."""
    return F.round(value * F.lit(10**scale)).cast("long")


def exact_mean(units_sum: str, count: str, scale: int = 2, places: int = 4) -> Column:
    """HALF_UP rounding to ``places`` of ``units_sum / (count * 10^scale)``,
    computed in integers over two aggregated columns (non-negative
    values), so the result does not depend on the order of additions."""
    num = f"CAST({units_sum} AS DECIMAL(38,0)) * {2 * 10**places} + CAST({count} AS DECIMAL(38,0)) * {10**scale}"
    den = f"CAST({count} AS DECIMAL(38,0)) * {2 * 10**scale}"
    return F.expr(
        f"CASE WHEN {count} = 0 THEN NULL ELSE CAST(({num}) div ({den}) AS DOUBLE) / {float(10**places)!r} END"
    )


def lookup_expr(key: Column, mapping: Mapping[str, str], default: str | None) -> Column:
    """Literal map lookup; a missing key or NULL gives ``default``.

    For small literal maps only (the map is part of the plan).  A mapping
    that lives in a table goes through ``operators.lookup.lookup_join``.
    """
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    val = F.try_element_at(m, key)
    return val if default is None else F.coalesce(val, F.lit(default))
