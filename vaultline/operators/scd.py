"""Slowly changing dimensions without MERGE (M1-M8).

SCD2 keeps every version of a row with a half-open validity interval
``[effective_start, effective_end)`` and an ``is_current`` flag.  One apply
is a single full outer join of the *current* rows with the de-duplicated
staging rows on the key; expired rows never enter the shuffle and are
unioned back.  Each side travels as one struct, so a missing side is a
NULL struct rather than a row of NULL columns, and each joined row emits
its output rows through one ``inline`` (closed version + new version)
without evaluating the join twice.

SCD1 is ``target LEFT ANTI staging UNION ALL staging``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, CURRENT = "effective_start", "effective_end", "is_current"
SCD_COLUMNS = (START, END, CURRENT)


def _at(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def _open_end() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def current_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CURRENT))


def expired_only(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col(CURRENT), F.lit(False)))


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties broken by the
    remaining columns (greatest wins), so the survivor is deterministic.

    A ``max`` over a struct aggregates partially before the shuffle, so a
    key holding a third of all rows is reduced map-side, never in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in order_by if c in rest] + [c for c in rest if c not in order_by]
    if not rest:
        return df.dropDuplicates(keys)
    best = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in order])).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns])


def scd2_init(staging: DataFrame, as_of: str) -> DataFrame:
    """First load: every row opens a version at ``as_of``."""
    return staging.withColumns({START: _at(as_of), END: _open_end(), CURRENT: F.lit(True)})


def _changed(t: Column, s: Column, tracked: Sequence[str]) -> Column:
    # NULL -> x, x -> NULL are changes; NULL -> NULL is not.
    return reduce(lambda a, b: a | b, [~t.getField(c).eqNullSafe(s.getField(c)) for c in tracked])


def _sides(silver: DataFrame, staging: DataFrame, key: str, order_by: Sequence[str]):
    data_cols = [c for c in silver.columns if c not in SCD_COLUMNS]
    missing = [c for c in data_cols if c not in staging.columns]
    extra = [c for c in staging.columns if c not in data_cols]
    if missing or extra:
        raise ValueError(f"staging lacks columns {missing}" if missing else f"staging has new columns {extra}")
    types = {f.name: f.dataType for f in silver.schema.fields}
    keyed = staging.filter(F.col(key).isNotNull())  # a row without a key is never loaded
    st = dedupe(keyed.select(*[F.col(c).cast(types[c]).alias(c) for c in data_cols]), [key], order_by)
    cur = current_only(silver)
    t = cur.select(F.col(key).alias("_k"), F.struct(*[F.col(c) for c in silver.columns]).alias("_t"))
    s = st.select(F.col(key).alias("_k"), F.struct(*[F.col(c) for c in data_cols]).alias("_s"))
    return data_cols, t, s


def _version(silver_cols: Sequence[str], src: Column, start: Column, end: Column, current: bool) -> Column:
    fields = []
    for c in silver_cols:
        if c == START:
            fields.append(start.alias(START))
        elif c == END:
            fields.append(end.alias(END))
        elif c == CURRENT:
            fields.append(F.lit(current).alias(CURRENT))
        else:
            fields.append(src.getField(c).alias(c))
    return F.struct(*fields)


def scd2_expire(
    silver: DataFrame, staging: DataFrame, key: str, as_of: str, tracked: Sequence[str] = ("customer_type",),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Only the expiry step: close current rows whose tracked columns changed."""
    _, t, s = _sides(silver, staging, key, order_by)
    tt, ss = F.col("_t"), F.col("_s")
    closed = _version(silver.columns, tt, tt.getField(START), _at(as_of), False)
    row = F.when(ss.isNotNull() & _changed(tt, ss, tracked), closed).otherwise(tt)
    out = t.join(s, "_k", "left").select(row.alias("_r")).select("_r.*")
    return out.unionByName(expired_only(silver))


def scd2_apply(
    silver: DataFrame | None,
    staging: DataFrame,
    key: str,
    as_of: str,
    tracked: Sequence[str] = ("customer_type",),
    insert_new_keys: bool = True,
    order_by: Sequence[str] = (),
    keep_expired: bool = True,
) -> DataFrame:
    """Apply one staging batch to an SCD2 table (``None`` = first load).

    Per key: unchanged or absent from staging -> kept as is; tracked value
    changed -> old version closed at ``as_of`` and a new one opened at
    ``as_of``; key new -> opened (unless ``insert_new_keys=False``).
    Staging rows without a key are skipped (they could never match, so
    every re-apply would insert them again).  Re-applying the same batch
    changes nothing.  ``keep_expired=False`` returns only the current rows
    and the rows this batch closes (for tables that keep history apart).
    """
    if silver is None:
        return scd2_init(dedupe(staging.filter(F.col(key).isNotNull()), [key], order_by), as_of)
    data_cols, t, s = _sides(silver, staging, key, order_by)
    tt, ss = F.col("_t"), F.col("_s")
    cols = silver.columns
    both = tt.isNotNull() & ss.isNotNull()
    changed = both & _changed(tt, ss, tracked)
    opened = _version(cols, ss, _at(as_of), _open_end(), True)
    closed = _version(cols, tt, tt.getField(START), _at(as_of), False)
    first = F.when(tt.isNull(), opened if insert_new_keys else F.lit(None)).when(changed, closed).otherwise(tt)
    second = F.when(changed, opened)
    rows = F.filter(F.array(first, second), lambda r: r.isNotNull())
    out = t.join(s, "_k", "full_outer").select(F.inline(rows))
    return out.unionByName(expired_only(silver)) if keep_expired else out


def changed_keys(staging: DataFrame, expired: DataFrame, key: str) -> DataFrame:
    """Staging rows whose key has an expired version (a semi join: each
    staging row at most once, however many versions expired)."""
    return staging.join(expired.select(key), key, "left_semi")


def scd2_totals(df: DataFrame) -> DataFrame:
    c = F.col(CURRENT)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(c).alias("current"),
        F.count_if(~F.coalesce(c, F.lit(False))).alias("expired"),
    )


def scd2_invariants(df: DataFrame, key: str) -> DataFrame:
    """One row of health counts: keys, keys with exactly one current row,
    versions overlapping their predecessor, expired rows without an end.

    Window per key -> aggregate per key (same partitioning, no second
    shuffle) -> one global aggregate.
    """
    w = Window.partitionBy(key).orderBy(START, END)
    prev_end = F.lag(END).over(w)
    has_prev = F.lag(START).over(w).isNotNull()
    flagged = df.select(
        F.col(key),
        F.col(CURRENT),
        F.when(has_prev & (prev_end.isNull() | (prev_end > F.col(START))), 1).otherwise(0).alias("_ov"),
        F.when(~F.col(CURRENT) & F.col(END).isNull(), 1).otherwise(0).alias("_oe"),
    )
    per_key = flagged.groupBy(key).agg(
        F.count_if(F.col(CURRENT)).alias("_nc"), F.sum("_ov").alias("_ov"), F.sum("_oe").alias("_oe")
    )
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("_nc") == 1).alias("keys_one_current"),
        F.coalesce(F.sum("_ov"), F.lit(0)).cast("long").alias("overlapping"),
        F.coalesce(F.sum("_oe"), F.lit(0)).cast("long").alias("expired_open"),
    )


def scd1_upsert(
    target: DataFrame | None,
    staging: DataFrame,
    key: str,
    order_by: Sequence[str] = (),
    merge_schema: bool = False,
) -> DataFrame:
    """Update every column on a key match, insert otherwise (staging rows
    without a key are skipped).

    Staging must hold every target column; extra staging columns are an
    error unless ``merge_schema`` (then old rows get NULL for them).
    """
    st = dedupe(staging.filter(F.col(key).isNotNull()), [key], order_by)
    if target is None:
        return st
    missing = [c for c in target.columns if c not in st.columns]
    if missing:
        raise ValueError(f"staging lacks columns {missing}")
    extra = [c for c in st.columns if c not in target.columns]
    if extra and not merge_schema:
        raise ValueError(f"staging has new columns {extra}; pass merge_schema=True")
    kept = target.join(st.select(key), key, "left_anti")
    return kept.unionByName(st, allowMissingColumns=bool(extra))
