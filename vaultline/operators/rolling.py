"""Per-key rolling count over a trailing time range.

The plain form is one window partition per key, so a hot key (one account
holding a third of all rows) becomes one task and AQE cannot split it.
The default form counts in two levels.  Rows are first counted for each
(key, second), aggregated before the shuffle, so a second with a million rows
is one row.  The window then runs over distinct seconds, in partitions of
(key, time bucket): every second is owned by bucket ``floor(t / B)``, and
seconds in the last ``seconds`` of a bucket are also copied, as context only,
into the next one.  A window partition holds at most B + ``seconds`` rows
however hot the key and however narrow the span of its rows.  The counts are
joined back to the rows on (key, second); rows that get no count are spread by
their hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

_B, _OWN, _SPREAD = "_rc_bucket", "_rc_own", "_rc_spread"
_KEY, _AT, _N = "_rc_key", "_rc_at", "_rc_n"


def rolling_count_plain(
    df: DataFrame, key: str, order_unix: str, seconds: int, value: str, out: str, null_peers: bool = False
) -> DataFrame:
    """Reference form: one window partition per key (not skew-safe)."""
    w = Window.partitionBy(key).orderBy(order_unix).rangeBetween(-seconds, 0)
    res = df.withColumn(out, F.count(value).over(w))
    if not null_peers:
        res = res.withColumn(
            out, F.when(F.col(key).isNull() | F.col(order_unix).isNull(), F.lit(None)).otherwise(F.col(out))
        )
    return res


def rolling_count(
    df: DataFrame,
    key: str,
    order_unix: str,
    seconds: int,
    value: str,
    out: str,
    bucket_seconds: int | None = None,
    null_peers: bool = False,
) -> DataFrame:
    """Count of non-NULL ``value`` among rows of the same ``key`` whose
    ``order_unix`` lies in ``[t - seconds, t]`` (both ends inclusive).

    By default rows with a NULL key or time get a NULL count; with
    ``null_peers=True`` they count each other as the source pipeline does.

    ``df`` is read twice, the first time for three columns only; its rows are
    shuffled once, for the join.  A (key, second) with very many rows is one
    join key: AQE splits it on the side of the rows.
    """
    # a second gets a context copy with probability ~ seconds / bsec, so the
    # default keeps that at <= 25% while a bucket stays short
    bsec = int(bucket_seconds or max(4 * seconds, 3600))
    if bsec < seconds:
        raise ValueError("bucket_seconds must be >= the window length")
    counts = second_counts(df, key, order_unix, value)
    u = F.col(order_unix)
    if null_peers:
        same = F.col(key).eqNullSafe(F.col(_KEY)) & u.eqNullSafe(F.col(_AT))
        rows, counts = df, counts.transform(_window_sums, seconds, bsec, out)
    else:
        counts = counts.where(F.col(_KEY).isNotNull() & F.col(_AT).isNotNull()).transform(_window_sums, seconds, bsec, out)
        # rows without a key or time match nothing; in place of the time their
        # whole hash deals them out
        atomic = [f.name for f in df.schema.fields if not isinstance(f.dataType, (StructType, ArrayType, MapType))]
        spread = F.xxhash64(*[F.col(c) for c in atomic]).cast(df.schema[order_unix].dataType)
        none = u.isNull() | F.col(key).isNull()
        rows = df.withColumn(_SPREAD, F.when(none, spread).otherwise(u))
        same = (F.col(key) == F.col(_KEY)) & (F.col(_SPREAD) == F.col(_AT)) & ~none
    return rows.join(counts, same, "left").select(*df.columns, out)


def second_counts(df: DataFrame, key: str, order_unix: str, value: str) -> DataFrame:
    """First level: non-NULL values of each (key, second)."""
    return df.groupBy(F.col(key).alias(_KEY), F.col(order_unix).alias(_AT)).agg(F.count(value).alias(_N))


def _window_sums(counts: DataFrame, seconds: int, bsec: int, out: str) -> DataFrame:
    """Second level: (key, second, out), the sums over trailing windows."""
    at = F.col(_AT)
    bucket = F.floor(at / F.lit(bsec)).cast("long")
    in_tail = at.isNotNull() & (at >= (bucket + F.lit(1)) * F.lit(bsec) - F.lit(seconds))
    copies = F.when(in_tail, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    both = counts.withColumn(_OWN, F.explode(copies)).withColumn(_B, F.when(F.col(_OWN), bucket).otherwise(bucket + F.lit(1)))
    w = Window.partitionBy(_KEY, _B).orderBy(_AT).rangeBetween(-seconds, 0)
    return both.withColumn(out, F.sum(_N).over(w)).where(_OWN).select(_KEY, _AT, out)
