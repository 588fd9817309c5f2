"""Tables by path: versioned Parquet snapshots and date-partitioned facts.

A snapshot table is a folder ``base/v=000001/``, ``base/v=000002/`` ...;
each version is a complete Parquet write (committed by Spark's
``_SUCCESS`` marker) and readers take the newest committed one.  A new
version never overwrites the folder a plan is reading, so "read, change,
write back" (SCD apply, schema evolution) is safe, and a failed write
leaves the previous version current.  Appended rows lie in folders beside
their version.  Partitioned facts live in one
folder and are re-emitted per touched day with dynamic partition
overwrite, whose commit is per day, not for all days at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F



def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder has been committed; a folder that a
    first write left half-way has no marker and counts as empty."""
    return _exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, none if it is not there."""
    fs, p, _ = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []


def partition_values(spark: SparkSession, path: str, column: str) -> set[str]:
    """Folder values of one partition column directly below ``path``."""
    return {n.split("=", 1)[1] for n in subfolders(spark, path) if n.startswith(f"{column}=")}


def _partition_folder(spark: SparkSession, column: str, value: object) -> str:
    """Folder name of a partition as Spark writes it (NULL and signs included)."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return names.getPartitionPathString(column, None if value is None else str(value))


def present_partitions(spark: SparkSession, path: str, column: str, values: Sequence[object]) -> list[object]:
    """Those of ``values`` that have a folder."""
    there = set(subfolders(spark, path))
    return [v for v in values if _partition_folder(spark, column, v) in there]


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[object]) -> None:
    """Delete the folders of partition values that have no rows any more: a
    dynamic overwrite leaves partitions alone that its result lacks."""
    for v in present_partitions(spark, path, column, values):
        drop_folder(spark, f"{path.rstrip('/')}/{_partition_folder(spark, column, v)}")


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions of the snapshot table at ``base``, ascending."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            marker = jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
            if fs.exists(marker):
                out.append(int(name[2:]))
    return sorted(out)


def next_version(spark: SparkSession, base: str) -> int:
    """One past every version folder, committed or not: a write that died
    half-way leaves its folder behind, and a retry must not reuse it."""
    fs, p, _ = _fs(spark, base)
    if not fs.exists(p):
        return 1
    taken = [
        int(st.getPath().getName()[2:])
        for st in fs.listStatus(p)
        if st.isDirectory() and st.getPath().getName().startswith("v=") and st.getPath().getName()[2:].isdigit()
    ]
    return max(taken, default=0) + 1


def table_exists(spark: SparkSession, base: str) -> bool:
    return bool(versions(spark, base))


def version_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/v={version:06d}"


def read_table(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    vs = versions(spark, base)
    if not vs:
        raise FileNotFoundError(f"no committed snapshot under {base}")
    v = vs[-1] if version is None else version
    df = spark.read.parquet(version_path(base, v))
    for path in _parts(spark, base, v):
        df = df.unionByName(spark.read.parquet(path), allowMissingColumns=True)
    return df


#: numeric types that widen into the ones to their right without a change of value, and where they meet
_INTEGRAL, _FRACTIONAL = ("tinyint", "smallint", "int", "bigint"), ("float", "double")


def common_type(a: str, b: str) -> str | None:
    """Least type that takes the values of both (simple names); None if only a
    conversion could.  Whole and fractional numbers meet in double, as in a
    union of the two."""
    if a == b:
        return a
    for ladder in (_INTEGRAL, _FRACTIONAL):
        if a in ladder and b in ladder:
            return max(a, b, key=ladder.index)
    return "double" if {a, b} <= {*_INTEGRAL, *_FRACTIONAL} else None


def check_schema(old: DataFrame, new: DataFrame, merge_schema: bool) -> DataFrame:
    """``new`` with same-name columns in the least common type of both tables;
    new columns, and types that do not meet, need more than that:
    ``merge_schema`` or a replaced table."""
    ot = {f.name: f.dataType.simpleString() for f in old.schema.fields}
    cast = {}
    for f in new.schema.fields:
        own = f.dataType.simpleString()
        if f.name not in ot:
            if not merge_schema:
                raise ValueError(f"new column {f.name}; pass merge_schema=True")
            continue
        meet = common_type(ot[f.name], own)
        if meet is None:
            raise ValueError(f"column {f.name} changes type {ot[f.name]} -> {own}")
        if meet != own:
            cast[f.name] = F.col(f"`{f.name}`").cast(meet)
    return new.withColumns(cast) if cast else new


def write_snapshot(
    df: DataFrame,
    base: str,
    mode: str = "replace",
    merge_schema: bool = False,
    partition_by: Sequence[str] | None = None,
    verify: bool = False,
    cluster_by: Sequence[str] = (),
    bucket_by: tuple[str, int] | None = None,
) -> str:
    """Write ``df`` as the next version of ``base``; returns its path.

    ``mode="replace"`` accepts any schema (overwrite with a new schema);
    ``mode="evolve"`` applies ``check_schema`` against the current version
    (columns may be added and numbers widened);
    ``mode="errorifexists"`` refuses when a version exists.
    ``verify=True`` counts the rows while writing (an Observation, no
    extra pass) and compares with a count of the committed files.
    ``cluster_by`` lays the rows out by ranges of those columns, sorted in
    each file, so that Parquet statistics skip files and row groups.
    ``bucket_by=(column, n)`` writes Spark buckets, sorted inside, one file
    each if ``df`` is dealt out that way; ``read_bucketed`` then joins and
    groups on the column without a shuffle of the table.
    """
    spark = df.sparkSession
    if cluster_by:
        df = df.repartitionByRange(*[F.col(c) for c in cluster_by]).sortWithinPartitions(*cluster_by)
    vs = versions(spark, base)
    if vs and mode == "errorifexists":
        raise FileExistsError(base)
    if vs and mode == "evolve":
        df = check_schema(read_table(spark, base), df, merge_schema)
    path = version_path(base, next_version(spark, base))
    obs = None
    if verify:
        df, obs = _observed(df)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        column, n = bucket_by
        name = f"vaultline_{uuid.uuid4().hex}"  # bucketed files are written through a catalog entry, which goes again
        w.format("parquet").bucketBy(n, column).sortBy(column).option("path", path).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
        fs, p, _ = _fs(spark, f"{path}/{_BUCKETED}{n}.{column}")
        fs.create(p, True).close()
    else:
        w.parquet(path)
    if obs is not None:
        _read_back(df, path, obs)
    return path


_BUCKETED = "_buckets."


def bucketing(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """(column, number) of the buckets a version was written in."""
    fs, p, _ = _fs(spark, path)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(_BUCKETED):
            n, column = name[len(_BUCKETED) :].split(".", 1)
            return column, int(n)
    return None


def read_bucketed(spark: SparkSession, base: str) -> DataFrame:
    """The newest version of a snapshot table; if it was written in buckets,
    as a bucketed scan (the catalog entry that tells Spark so is dropped at
    once; the files and the returned plan stay)."""
    vs = versions(spark, base)
    path = version_path(base, vs[-1]) if vs else ""
    how = bucketing(spark, path) if vs else None
    if how is None or _parts(spark, base, vs[-1]):
        return read_table(spark, base)
    column, n = how
    name = f"vaultline_{uuid.uuid4().hex}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {n} BUCKETS LOCATION '{path}'")
    df = spark.table(name)
    df.schema  # resolved before the entry goes
    spark.sql(f"DROP TABLE {name}")
    return df


def _parts(spark: SparkSession, base: str, version: int) -> list[str]:
    """Committed appends to a version, in order."""
    names = partition_values(spark, base, f"a{version:06d}")
    paths = [f"{base.rstrip('/')}/a{version:06d}={n}" for n in sorted(names)]
    return [p for p in paths if has_data(spark, p)]


def append_snapshot(df: DataFrame, base: str) -> str:
    """Append rows to the newest version, by column name: they go to a folder
    of their own beside it (``a000001=000001`` is the first append to version
    1) and nothing is rewritten.  The next full version ends them.  Columns
    that either side lacks are NULL there; numbers may widen: files written
    before are cast as they are read."""
    spark = df.sparkSession
    if not table_exists(spark, base):
        return write_snapshot(df, base, mode="replace")
    df = check_schema(read_table(spark, base), df, merge_schema=True)
    version = versions(spark, base)[-1]
    taken = partition_values(spark, base, f"a{version:06d}")  # those of writes that died too
    path = f"{base.rstrip('/')}/a{version:06d}={max(map(int, taken), default=0) + 1:06d}"
    df.write.mode("errorifexists").parquet(path)
    return path


def upsert_partitions(
    df: DataFrame, path: str, partition_col: str, key: str | None, days: Sequence[object] | None = None
) -> None:
    """Idempotent append of a batch to a table partitioned by ``partition_col``.

    Only the days the batch touches are rewritten: their existing rows
    minus the batch's keys, plus the batch (the batch wins).  Dynamic
    partition overwrite stages the new files, so the job may read the days
    it replaces and a job that fails before its commit leaves the table as
    it was; the commit itself moves one day folder after another, so a crash
    in it can leave some days new and others old until the batch is run
    again.  Re-running a batch changes nothing.  With ``key=None`` the batch is appended as is (source
    behaviour: a re-run duplicates rows).  ``days`` (a superset of the
    batch's partition values) saves the pass that would collect them.
    """
    spark = df.sparkSession
    if key is not None and not has_data(spark, path):
        write_partitioned(df, path, partition_col)  # nothing there, or a first write that died
        return
    if key is None:
        clustered_by(df, partition_col).write.mode("append").partitionBy(partition_col).parquet(path)
        return
    if days is None:
        # one row per touched day: bounded by the batch's time span
        days = [r[0] for r in df.select(partition_col).distinct().collect()]
    existing = spark.read.parquet(path)
    values = [v for v in days if v is not None]
    touched = F.col(partition_col).isin(values) if values else F.lit(False)
    if len(values) < len(days):
        touched = touched | F.col(partition_col).isNull()
    keep = existing.filter(touched).join(df.select(key), key, "left_anti")
    merged = keep.unionByName(df.select(*existing.columns))
    (
        clustered_by(merged, partition_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def clustered_by(df: DataFrame, partition_col: str) -> DataFrame:
    """Before a partitioned write: rows of one partition value are brought to
    few tasks, so each value gets few files instead of one per task; AQE
    splits a hot value and merges small ones (REBALANCE)."""
    return df.hint("rebalance", partition_col)


def _laid_out(df: DataFrame, partition_col: str, sort_by: Sequence[str]) -> DataFrame:
    out = clustered_by(df, partition_col)
    return out.sortWithinPartitions(partition_col, *sort_by) if sort_by else out


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    obs = Observation(f"written_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _read_back(df: DataFrame, path: str, obs: Observation, where: Column | None = None) -> None:
    """Count the stored rows (from Parquet footers) and compare them with those
    of ``df`` that were written; a partitioned table of no rows has no files."""
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    written, there = obs.get["rows"], (stored if where is None else stored.where(where)).count()
    if written != there:
        raise RuntimeError(f"{path}: wrote {written} rows, read back {there}")


def overwrite_partitions(df: DataFrame, path: str, partition_col: str, sort_by: Sequence[str] = (), verify: Column | None = None) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite);
    the others stay.  ``sort_by`` sorts the rows of each file.  ``verify``: the
    partitions that ``df`` covers; their rows are counted while written and
    again in the table."""
    obs = None
    if verify is not None:
        df, obs = _observed(df)
    (
        _laid_out(df, partition_col, sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )
    if obs is not None:
        _read_back(df, path, obs, verify)


def write_partitioned(df: DataFrame, path: str, partition_col: str, sort_by: Sequence[str] = (), verify: bool = False) -> str:
    """Overwrite of a whole partitioned table (to a path not read): static,
    whatever the session says, so partitions that ``df`` lacks go.  ``verify``
    counts the rows while they are written and again in the table."""
    obs = None
    if verify:
        df, obs = _observed(df)
    (
        _laid_out(df, partition_col, sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(partition_col)
        .parquet(path)
    )
    if obs is not None:
        _read_back(df, path, obs)
    return path


def publish(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Register a managed catalog table (overwrite by default so re-runs
    succeed)."""
    df.write.mode(mode).saveAsTable(name)


def publish_path(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """Register files already written at ``path`` as an external catalog
    table: metadata only, where a second ``saveAsTable`` write would run
    the whole plan again.

    Re-publishing moves the entry to the new location in one step, so readers
    always find the table, in its old or its new state; new columns are added
    to it.  Only a change of a type, or a column that is gone, replaces the
    entry by a rename.  Partitioned tables get the partitions of the folders,
    and lose those whose folders are gone."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    else:
        old = {f.name: f.dataType for f in spark.table(name).schema.fields}
        new = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
        if all(new.get(c) == t for c, t in old.items()):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            added = ", ".join(f"`{c}` {t.simpleString()}" for c, t in new.items() if c not in old)
            if added:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
            spark.catalog.refreshTable(name)
        else:
            beside = f"{name}_{uuid.uuid4().hex[:8]}"
            spark.catalog.createTable(f"{beside}_new", path=path, source="parquet")
            spark.sql(f"ALTER TABLE {name} RENAME TO {beside}_old")
            spark.sql(f"ALTER TABLE {beside}_new RENAME TO {name}")
            spark.sql(f"DROP TABLE {beside}_old")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")


def publish_copy(spark: SparkSession, src: DataFrame, dst: str, partition_by: str | None = None) -> DataFrame:
    """Copy a silver table to a gold path and read the copy back."""
    if partition_by:
        write_partitioned(src, dst, partition_by)
    else:
        src.write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)


def cluster_table(df: DataFrame, cols: Sequence[str], path: str, n_files: int | None = None) -> str:
    """Lay rows out clustered by ``cols``: range-partition into ``n_files``
    files, sorted inside each, so Parquet min/max statistics skip row
    groups on those columns.  The rows are unchanged."""
    keys = [F.col(c) for c in cols]
    # no count given: AQE sizes the ranges (few files for a small table)
    ranged = df.repartitionByRange(n_files, *keys) if n_files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)
    return path


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Explicit retention: deletes all but the newest ``keep`` committed
    versions of a snapshot table with their appends, and unfinished older
    ones; returns how many folders went.  Only for tables that no running
    plan reads in an old version."""
    fs, p, _ = _fs(spark, base)
    vs = versions(spark, base)
    if len(vs) <= keep:
        return 0
    oldest, gone = vs[-keep], 0
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        number = name[2:] if name.startswith("v=") else name[1:7] if name.startswith("a") and "=" in name else ""
        if st.isDirectory() and number.isdigit() and int(number) < oldest:
            gone += bool(fs.delete(st.getPath(), True))
    return gone
