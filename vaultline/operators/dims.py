"""Gold dimensions: dates, locations, dense surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from vaultline.config import COUNTRY_REGION, LOCATION_COUNTRY, OTHER_REGION, UNKNOWN
from vaultline.functions.exprs import flag, lookup_expr
from vaultline.operators.lookup import lookup_join
from vaultline.session import ensure_checkpoint_dir
from vaultline.sources.dates import date_spine, year_spine_of

_PID_SHIFT = 33  # monotonically_increasing_id = partition id << 33 | row index


def calendar(dates: DataFrame, col: str = "full_date") -> DataFrame:
    """Date attributes: key yyyyMMdd, parts, names, weekend flag (Sun/Sat)."""
    d = F.col(col)
    return dates.select(
        d,
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        flag(F.dayofweek(d).isin(1, 7)).alias("is_weekend"),
    )


def build_dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end`` (the source used 2026)."""
    return calendar(date_spine(spark, start, end))


def build_dim_date_for(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar of every full year that ``date_col`` of ``df`` spans."""
    return calendar(year_spine_of(df, date_col))


def assign_key(
    df: DataFrame,
    order_col: str,
    out: str,
    start: int = 0,
    num_partitions: int | None = None,
    dtype: str = "int",
) -> DataFrame:
    """Dense key ``start + 1, start + 2, ...`` in ``order_col`` order, without
    funnelling the rows through one task (a global ``row_number`` window
    plans an ``Exchange SinglePartition``).

    1. range-partition and sort on ``order_col``; every row takes
       ``monotonically_increasing_id`` (partition id in the upper bits,
       position within the sorted partition in the lower 33 bits);
    2. checkpoint that once to the shared checkpoint folder, because range
       bounds come from sampling and must not change between the two uses;
    3. offsets = running total of the per-partition row counts (one row
       per partition, a size bound known up front, so it is broadcast);
    4. key = start + offset + position + 1.
    Ties in ``order_col`` get distinct keys in the order of the other
    columns.  Keys are ``int`` like the source's; pass
    ``dtype="long"`` for more than 2^31 rows (ANSI mode raises rather
    than wrapping).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # without an explicit count AQE may merge neighbouring ranges (a small
    # dimension becomes a few tasks, not spark.sql.shuffle.partitions);
    # merged ranges stay contiguous and in order, so positions hold
    # the other columns break ties, so that a hot value spans many ranges
    ties = [f.name for f in df.schema.fields if f.name != order_col and isinstance(f.dataType, AtomicType)]
    order = [F.col(order_col), *(F.col(c) for c in ties)]
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ranged = (
        ranged.sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumns(
            {
                "_pid": F.shiftright(F.col("_mid"), _PID_SHIFT),
                "_pos": F.col("_mid").bitwiseAND(F.lit((1 << _PID_SHIFT) - 1)),
            }
        )
        .drop("_mid")
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    keyed = ranged.join(F.broadcast(offsets), "_pid")
    return keyed.withColumn(out, (F.lit(start) + F.col("_off") + F.col("_pos") + F.lit(1)).cast(dtype)).drop(
        "_pid", "_pos", "_off"
    )


def assign_key_single(df: DataFrame, order_col: str, out: str, start: int = 0) -> DataFrame:
    """Source form (``row_number`` over a global order): one task. Kept
    only to check ``assign_key`` against; do not use on large inputs."""
    return df.withColumn(out, (F.lit(start) + F.row_number().over(Window.orderBy(order_col))).cast("int"))


def region_of(country_col: str = "country", mapping: Mapping[str, str] = COUNTRY_REGION):
    return lookup_expr(F.col(country_col), mapping, OTHER_REGION)


def location_rows(txn: DataFrame, location_map: Mapping[str, str] | DataFrame | None = None) -> DataFrame:
    """Distinct non-NULL locations with country and region (no key yet)."""
    locs = txn.select("location").distinct().filter(F.col("location").isNotNull())
    if location_map is None:
        location_map = LOCATION_COUNTRY
    if isinstance(location_map, DataFrame):
        locs = lookup_join(locs, "location", location_map, "location", "country", "country", UNKNOWN)
    else:
        locs = locs.withColumn("country", lookup_expr(F.col("location"), location_map, UNKNOWN))
    return locs.withColumn("region", region_of())


def build_dim_location(txn: DataFrame, location_map: Mapping[str, str] | DataFrame | None = None) -> DataFrame:
    rows = location_rows(txn, location_map)
    return assign_key(rows, "location", "location_key").select("location_key", "location", "country", "region")


def extend_dim_location(
    existing: DataFrame, txn: DataFrame, location_map: Mapping[str, str] | DataFrame | None = None
) -> DataFrame:
    """Keep existing keys; give locations not seen before keys after the
    current maximum, in name order.  Keys stay stable across loads."""
    new = location_rows(txn, location_map).join(existing.select("location"), "location", "left_anti")
    top = existing.agg(F.max("location_key")).first()[0] or 0
    added = assign_key(new, "location", "location_key", start=int(top))
    cols = ["location_key", "location", "country", "region"]
    return existing.select(*cols).unionByName(added.select(*cols))
