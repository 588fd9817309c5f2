"""Index of a day-partitioned table: which days may hold an id.

The index lies beside its table as Parquet, partitioned by hash bucket of the
id: rows (id, day), sorted by id in each file.  A batch appends its ids with
their days before the table itself is written, so every row of the table has
an entry, also after a crash between the two writes.  Entries are never
removed by a load: an id that moved has one for each day it stood on, and a
lookup returns a superset of the days that hold it.  ``rebuild`` compacts.

A lookup reads the buckets of the batch's ids only, and the table is then read
on the found days only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.sources import tables

BUCKETS = 16  # of a new index; ``rebuild`` with more as the table grows: about 100-200 MB a bucket


def _base(path: str) -> str:
    return f"{path.rstrip('/')}_ids"


def index_path(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest complete index of the table at ``path``; its name
    tells the number of buckets."""
    found = [n for n in tables.subfolders(spark, _base(path)) if "-of-" in n and tables.has_data(spark, f"{_base(path)}/{n}")]
    return f"{_base(path)}/{max(found)}" if found else None


def _buckets(folder: str) -> int:
    return int(folder.rsplit("-of-", 1)[1])


def _bucket(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _entries(df: DataFrame, key: str, day: str, n: int, unique: bool = False) -> DataFrame:
    rows = df.select(F.col(key).alias("id"), F.col(day).alias("day")).where("id is not null")
    rows = rows if unique else rows.distinct()
    return rows.withColumn("bucket", _bucket("id", n))


def rebuild(spark: SparkSession, path: str, key: str, day: str, buckets: int = BUCKETS) -> str:
    """Write a new index from the table itself (also to compact, or to change
    the number of buckets); the newest complete one counts."""
    taken = [int(n.split("-of-")[0]) for n in tables.subfolders(spark, _base(path)) if "-of-" in n]
    folder = f"{_base(path)}/{max(taken, default=0) + 1:06d}-of-{buckets}"
    tables.write_partitioned(_entries(spark.read.parquet(path), key, day, buckets), folder, "bucket", sort_by=["id"])
    return folder


def add(spark: SparkSession, path: str, batch: DataFrame, key: str, day: str, buckets: int = BUCKETS, unique: bool = False) -> None:
    """Append a batch's ids and days; call it before the table is written.  A
    table without an index gets one of all its rows first.  ``unique``: the
    batch has one row an id, so its entries need no de-duplication."""
    folder = index_path(spark, path)
    if folder is None and tables.has_data(spark, path):
        folder = rebuild(spark, path, key, day, buckets)
    if folder is None:
        folder = f"{_base(path)}/{1:06d}-of-{buckets}"
    rows = _entries(batch, key, day, _buckets(folder), unique)
    tables.clustered_by(rows, "bucket").sortWithinPartitions("bucket", "id").write.mode("append").partitionBy("bucket").parquet(folder)


def entries_of(spark: SparkSession, path: str, ids: DataFrame, key: str, day: str) -> DataFrame:
    """(id, day) entries of the ids; only their buckets are read."""
    folder = index_path(spark, path) or rebuild(spark, path, key, day)
    n = _buckets(folder)
    wanted = ids.select(F.col(key).alias("id")).where("id is not null")
    used = [r[0] for r in wanted.select(_bucket("id", n).alias("b")).distinct().collect()]  # at most n numbers
    index = spark.read.parquet(folder).where(F.col("bucket").isin(used) if used else F.lit(False))
    return index.join(wanted, "id", "left_semi").select("id", "day")


def days_of(spark: SparkSession, path: str, ids: DataFrame, key: str, day: str) -> list[object]:
    """Days of the table that may hold one of the ids: one value a day."""
    return [r[0] for r in entries_of(spark, path, ids, key, day).select("day").distinct().collect()]
