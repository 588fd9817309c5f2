"""The pipeline as jobs over a lake folder: bronze -> silver -> gold.

Every job reads its inputs by path, writes one new snapshot (or rewrites
the touched days of a partitioned fact) and returns what it wrote; jobs
can be re-run.  Data between jobs lives only in files, so lineage is cut
at each job boundary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.config import RiskConfig
from vaultline.operators import dims, kpi, quality, scd, scores
from vaultline.operators import transactions as tx
from vaultline.operators.audit import add_audit
from vaultline.schemas import SOURCES
from vaultline.sources import idindex, tables
from vaultline.sources.files import CORRUPT, accepted, read_csv, read_json, rejected


@dataclass(frozen=True)
class Lake:
    """Folder layout of one lake (a base folder on shared storage)."""

    root: str

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


# ---------------------------------------------------------------- bronze ---

def ingest(
    spark: SparkSession,
    lake: Lake,
    name: str,
    path: str,
    as_of: str | None = None,
    infer: bool = False,
    multiline: bool | None = None,
    split_over: int | None = None,
    provenance: bool = False,
    undeclared: bool = True,
) -> str:
    """Raw file -> bronze snapshot with audit columns.

    Bronze keeps every column and every row of the file; rows that could not
    be read as declared carry the reason in ``_corrupt_record`` and go no
    further (``rejected_count``).  With ``provenance`` each row names its file
    and block, and the rejected rows also make a table of their own,
    ``<name>_rejected``, with file and reason.  ``undeclared=False`` takes the
    declared columns of JSON alone and spares the pass that finds others."""
    fmt, schema = SOURCES[name]
    declared = None if infer else schema
    if fmt == "csv":
        df = read_csv(spark, path, declared, infer=infer or schema is None, provenance=provenance)
    else:
        df = read_json(spark, path, declared, multiline=multiline, split_over=split_over, provenance=provenance, undeclared=undeclared)
    if declared is not None:
        quality.assert_schema(df.select(*declared.fieldNames()), declared)
    path = tables.write_snapshot(add_audit(df, f"{name}.{fmt}", as_of), lake.bronze(name), mode="replace")
    if provenance:
        bad = rejected(spark.read.parquet(path).drop("created_timestamp", "source_table"))
        tables.write_snapshot(add_audit(bad, f"{name}.{fmt}", as_of), lake.bronze(f"{name}_rejected"), mode="replace")
    return path


def read_bronze(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """Rows of the newest bronze snapshot that were read without fault."""
    return accepted(tables.read_table(spark, lake.bronze(name)))


def rejected_count(spark: SparkSession, lake: Lake, name: str) -> int:
    """Rows of the newest bronze snapshot that could not be read as declared."""
    df = tables.read_table(spark, lake.bronze(name))
    return df.where(F.col(CORRUPT).isNotNull()).count() if CORRUPT in df.columns else 0


# ---------------------------------------------------------------- silver ---

def _history(lake: Lake) -> str:
    return lake.silver("customer_history")


def read_silver_customers(spark: SparkSession, lake: Lake, current_only: bool = False) -> DataFrame:
    """The SCD2 customer table: the newest version of the current rows, and
    the rows closed by every committed load; ``current_only`` leaves the
    history unread."""
    base = lake.silver("customer")
    current = tables.read_table(spark, base)
    if current_only:
        return current.transform(scd.current_only)
    committed = {str(v) for v in tables.versions(spark, base)}
    loads = tables.partition_values(spark, _history(lake), "load")
    if not loads & committed:
        return current
    closed = spark.read.schema(current.schema.add("load", "long")).parquet(_history(lake))
    dead = sorted(int(x) for x in loads - committed)  # loads that died before their current rows
    closed = closed.where(~F.col("load").isin(dead)) if dead else closed
    return current.unionByName(closed.drop("load"))


def load_silver_customers(spark: SparkSession, lake: Lake, as_of: str, tracked=("customer_type",)) -> str:
    """SCD2 apply of the newest bronze customers onto silver_customer.

    A load reads only the current rows.  They lie in buckets of the key (as
    many as ``spark.sql.shuffle.partitions`` says at the first load), so only
    the batch is shuffled for the join and the new version's buckets are
    written where they were joined.  The load first writes the rows it closes
    to their own folder of the history, named by the version it is about to
    write, and the table's totals beside them, and then the current rows as
    that version; the version's commit marker makes all visible at once.  A
    load that dies before it leaves the table as it was; the next attempt
    takes a new number, or replaces what the dead one wrote under the same.
    Closed rows of earlier loads are never touched, whatever their ``as_of``;
    a load older than the newest open row is refused.  Costs O(current rows +
    batch).
    """
    staging = read_bronze(spark, lake, "customers")
    base, key = lake.silver("customer"), "customer_id"
    load = tables.next_version(spark, base)
    if not tables.table_exists(spark, base):
        first = scd.scd2_apply(None, staging, key, as_of, tracked).checkpoint()
        _write_totals(lake, load, first, 0)
        return _write_current(first, base, key, int(spark.conf.get("spark.sql.shuffle.partitions")), dealt=False)
    how = tables.bucketing(spark, _latest(spark, base))
    current = tables.read_bucketed(spark, base).transform(scd.current_only)
    newest = current.agg(F.max(scd.START).alias("at"), F.lit(as_of).cast("timestamp_ntz").alias("now")).first()
    if newest["at"] is not None and newest["now"] < newest["at"]:
        raise ValueError(f"load as of {as_of} is older than rows opened at {newest['at']}")
    step = scd.scd2_apply(current, staging, key, as_of, tracked, keep_expired=False)
    step = step.select(*current.columns).checkpoint()
    before = customer_totals(spark, lake)["expired"]
    closed = step.transform(scd.expired_only)
    if closed.isEmpty():  # a load of this number that died may have left rows
        tables.drop_folder(spark, f"{_history(lake)}/load={load}")
    else:
        closed.write.mode("overwrite").parquet(f"{_history(lake)}/load={load}")
    _write_totals(lake, load, step, before)
    buckets = how[1] if how else int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _write_current(step.transform(scd.current_only), base, key, buckets, dealt=how is not None)


def _write_current(df: DataFrame, base: str, key: str, buckets: int, dealt: bool) -> str:
    """``dealt``: ``df`` comes from a join on the buckets and needs no shuffle."""
    df = df if dealt else df.repartition(buckets, key)
    return tables.write_snapshot(df, base, verify=True, bucket_by=(key, buckets))


def _write_totals(lake: Lake, load: int, step: DataFrame, expired_before: int) -> None:
    """Totals of the table as load ``load`` will leave it, from its own rows
    and the closed rows of earlier loads, which are carried as a number."""
    sums = scd.scd2_totals(step)
    carried = F.lit(expired_before).cast("long")
    sums = sums.select((F.col("total") + carried).alias("total"), "current", (F.col("expired") + carried).alias("expired"))
    sums.write.mode("overwrite").parquet(f"{lake.silver('customer_totals')}/load={load}")


def customer_totals(spark: SparkSession, lake: Lake) -> dict:
    """Total, current and expired rows of silver_customer as its newest load
    recorded them; counted where there is no record."""
    load = tables.versions(spark, lake.silver("customer"))[-1]
    path = f"{lake.silver('customer_totals')}/load={load}"
    if tables.has_data(spark, path):
        return spark.read.parquet(path).first().asDict()
    return scd.scd2_totals(read_silver_customers(spark, lake)).first().asDict()


def check_customer_load(spark: SparkSession, lake: Lake) -> dict:
    """The invariants of ``check_customers`` for the newest load: every key has
    one current row, and the versions of the keys that the load changed do not
    overlap and are closed.  Reads the current rows (grouped on their buckets)
    and what the load closed; rows closed before were checked by the loads that
    closed them.  Returns the totals, compared with the stored rows."""
    base = lake.silver("customer")
    load = tables.versions(spark, base)[-1]
    current = tables.read_bucketed(spark, base)
    totals = customer_totals(spark, lake)
    keys = quality.key_uniqueness(current, "customer_id").first()
    closed_path = f"{_history(lake)}/load={load}"
    closed_rows, health = 0, None
    if tables.has_data(spark, closed_path):
        closed = spark.read.schema(current.schema).parquet(closed_path)
        changed = current.join(closed.select("customer_id").distinct(), "customer_id", "left_semi").select(*closed.columns)
        health = scd.scd2_invariants(changed.unionByName(closed), "customer_id").first()
        closed_rows = closed.count()
    if health is not None and (health["keys"] != health["keys_one_current"] or health["overlapping"] or health["expired_open"]):
        raise AssertionError(f"silver customers, load {load}: {health.asDict()}")
    if keys["duplicate_keys"] or keys["rows"] != totals["current"] or closed_rows > totals["expired"] or totals["total"] != totals["current"] + totals["expired"]:
        raise AssertionError(f"silver customers, load {load}: {keys.asDict()}, {closed_rows} closed, recorded {totals}")
    return totals


def check_customers(spark: SparkSession, lake: Lake) -> dict:
    """Totals of the customer table; fails if a key has not exactly one
    current row, versions overlap, or a closed row has no end."""
    df = read_silver_customers(spark, lake)
    health = scd.scd2_invariants(df, "customer_id").first()
    if health["keys"] != health["keys_one_current"] or health["overlapping"] or health["expired_open"]:
        raise AssertionError(f"silver customers: {health.asDict()}")
    return scd.scd2_totals(df).first().asDict()


def load_silver_accounts(spark: SparkSession, lake: Lake, order_by=()) -> str:
    """SCD1 upsert of the newest bronze accounts onto silver_accounts."""
    staging = read_bronze(spark, lake, "accounts")
    base = lake.silver("accounts")
    target = tables.read_table(spark, base) if tables.table_exists(spark, base) else None
    out = scd.scd1_upsert(target, staging, "account_id", order_by, merge_schema=True)
    return tables.write_snapshot(out, base, mode="evolve", merge_schema=True, verify=True, cluster_by=["account_id", "customer_id"])


def _day_filter(days: Sequence[object]):
    values = [d for d in days if d is not None]
    cond = F.col("txn_date").isin(values) if values else F.lit(False)
    return cond | F.col("txn_date").isNull() if len(values) < len(days) else cond


def _emptied_days(existing: DataFrame, days: Sequence[object], gone_ids: DataFrame) -> list[object]:
    """Those of the days that hold nothing but rows with the given ids (read
    before the days are rewritten, ids only)."""
    if not days:
        return []
    rows = existing.where(_day_filter(days)).select("transaction_id", "txn_date")
    stay = {r[0] for r in rows.join(gone_ids, "transaction_id", "left_anti").select("txn_date").distinct().collect()}
    return [d for d in days if d not in stay]


def _places_near(anchors: DataFrame, window_s: int) -> DataFrame:
    """(account_id, txn_date, _again): the days that windows of ``window_s``
    seconds starting at the anchors reach (``_again``), and the days before
    them that windows ending there reach back to; one row a place."""
    at = F.col("txn_timestamp")
    reached = (F.col("txn_date"), F.to_date(at + F.expr(f"INTERVAL {window_s} SECONDS")))
    back = range(-(-window_s // 86400) + 1)
    days = [F.struct(F.date_sub(d, b).alias("day"), F.lit(b == 0).alias("again")) for d in reached for b in back]
    rows = anchors.where("account_id is not null and txn_timestamp is not null")
    rows = rows.select("account_id", F.explode(F.array_distinct(F.array(*days))).alias("_d"))
    return rows.groupBy("account_id", F.col("_d.day").alias("txn_date")).agg(F.max("_d.again").alias("_again"))


def append_silver_transactions(
    spark: SparkSession,
    bronze_batch: DataFrame,
    accounts: DataFrame,
    customers_current: DataFrame,
    path: str,
    cfg: RiskConfig,
    location_map: Mapping[str, str] | DataFrame | None = None,
    idempotent: bool = True,
) -> dict:
    """Add one bronze batch to silver_transactions (partitioned by day).

    Silver holds one row for each ``transaction_id``: of an id sent more than
    once the newest row counts, within a batch by time and then by the other
    columns, and across batches the later batch.  Batches may arrive in any
    time order.  The batch is read once (kept in the checkpoint folder).

    * Rows of silver with an id of the batch go, wherever they lie: an index
      of ids (``sources/idindex.py``) tells the days that may hold one, and
      silver is read on these days only.  The batch's own ids enter the index
      before silver is written.
    * Anchors are the places, (account, time), of the batch's rows and of the
      rows that go.  Windows reach from an anchor to W later, so the account's
      rows on the anchor's day and on the day W later are counted anew, with
      the days before them as context.
    * The days rewritten are those of the batch's rows, of rows that go and
      of rows whose flag changes: no day is rewritten for lying between two
      others.  A day that loses its last row is removed after the write (a
      load that dies in between is mended by running it again).

    The result equals loading all batches at once.  Returns the quality
    counts observed on the way and ``days``, the partitions that may have
    changed (for an incremental gold run).  ``idempotent=False`` is the plain
    append of the source pipeline.
    """
    raw, raw_obs = quality.observe_raw(bronze_batch)
    prepared = tx.prepare_transactions(raw, cfg)
    if not idempotent:
        silver = tx.enrich_transactions(tx.rapid_flag(prepared, cfg), accounts, customers_current, location_map)
        silver, out_obs = quality.observe_silver(silver)
        if idindex.index_path(spark, path):
            idindex.add(spark, path, prepared, "transaction_id", "txn_date")
        tables.upsert_partitions(silver, path, "txn_date", None)
        return quality.quality_row(raw_obs, out_obs)

    # every column breaks ties between rows of an id; those that silver lacks go no further
    prepared = scd.dedupe(prepared, ["transaction_id"], ["txn_timestamp"])
    prepared = prepared.select(*[c for c in prepared.columns if c.lower() in tx.SILVER_COLUMNS]).checkpoint()
    accounts = accounts.join(prepared.select("account_id").distinct(), "account_id", "left_semi")
    if not tables.has_data(spark, path):
        idindex.add(spark, path, prepared, "transaction_id", "txn_date", unique=True)
        silver = tx.enrich_transactions(tx.rapid_flag(prepared, cfg), accounts, customers_current, location_map)
        silver, out_obs = quality.observe_silver(silver)
        tables.write_partitioned(silver, path, "txn_date", sort_by=["account_id"], verify=True)
        days = [r[0] for r in prepared.select("txn_date").distinct().collect()]
        return {**quality.quality_row(raw_obs, out_obs), "days": days}

    existing = spark.read.parquet(path)
    ids = prepared.select("transaction_id")
    place = ["account_id", "txn_timestamp", "txn_date"]
    old_days = idindex.days_of(spark, path, ids, "transaction_id", "txn_date")
    idindex.add(spark, path, prepared, "transaction_id", "txn_date", unique=True)
    gone = existing.where(_day_filter(old_days)).select("transaction_id", *place).join(ids, "transaction_id", "left_semi").checkpoint()
    near = (
        existing.select("transaction_id", *place, F.col("rapid_txn_flag").alias("_was"))
        .join(_places_near(prepared.select(*place).unionByName(gone.select(*place)), int(cfg.rapid_window_s)), ["account_id", "txn_date"])
        .join(ids, "transaction_id", "left_anti")
        .checkpoint()  # the windows read it twice
    )
    # windows are counted on ids and places alone; of the result the batch's flags and the changed ones are kept
    flags = tx.rapid_flag_with_context(prepared.select("transaction_id", *place), near, cfg, keep_context=True)
    flags = flags.where(~F.col("_ctx") | (F.col("_again") & (F.col("rapid_txn_flag") != F.col("_was"))))
    flags = flags.select("transaction_id", "txn_date", "_ctx", "rapid_txn_flag").checkpoint()
    changed = flags.where(F.col("_ctx")).select("transaction_id", "txn_date", F.col("rapid_txn_flag").alias("_flag"))
    own = prepared.select("txn_date", F.lit(True).alias("_own"))
    others = gone.select("txn_date").unionByName(changed.select("txn_date")).withColumn("_own", F.lit(False))
    touched = own.unionByName(others).groupBy("txn_date").agg(F.max("_own").alias("_own")).collect()  # one row for each day that changes
    days = [r["txn_date"] for r in touched]
    emptied = _emptied_days(existing, [r["txn_date"] for r in touched if not r["_own"]], ids)

    flagged = prepared.join(flags.where(~F.col("_ctx")).select("transaction_id", "rapid_txn_flag"), "transaction_id", "left")
    new_rows = tx.enrich_transactions(flagged, accounts, customers_current, location_map)
    new_rows, out_obs = quality.observe_silver(new_rows)
    # the days as they will be: rows not replaced by the batch, with their new
    # flags, plus the batch; silver has one row an id, so the join adds none
    kept = (
        existing.filter(_day_filter(days))
        .join(ids, "transaction_id", "left_anti")
        .join(changed.select("transaction_id", "_flag"), "transaction_id", "left")
        .withColumn("rapid_txn_flag", F.coalesce(F.col("_flag"), F.col("rapid_txn_flag")))
        .select(*new_rows.columns)
    )
    filled = _day_filter([d for d in days if d not in emptied])
    tables.overwrite_partitions(kept.unionByName(new_rows), path, "txn_date", sort_by=["account_id"], verify=filled)
    tables.drop_partitions(spark, path, "txn_date", emptied)
    return {**quality.quality_row(raw_obs, out_obs), "days": days}


def load_silver_transactions(spark: SparkSession, lake: Lake, cfg: RiskConfig, location_map=None) -> dict:
    bronze = read_bronze(spark, lake, "transactions")
    accounts = tables.read_table(spark, lake.silver("accounts"))
    customers = read_silver_customers(spark, lake, current_only=True)
    return append_silver_transactions(
        spark, bronze, accounts, customers, lake.silver("transactions"), cfg, location_map
    )


# ------------------------------------------------------------------ gold ---

def _latest(spark: SparkSession, base: str) -> str:
    return tables.version_path(base, tables.versions(spark, base)[-1])


def _copy_customers(spark: SparkSession, lake: Lake, path: str, whole: bool) -> None:
    """Gold copy of the customer table, partitioned by the load that closed
    the rows (NULL: current).  Unless ``whole``, the current rows and the
    loads that the copy lacks are written; the others are left as they are."""
    base = lake.silver("customer")
    there = set() if whole or not tables.has_data(spark, path) else tables.partition_values(spark, path, "closed_by")
    loads = tables.partition_values(spark, _history(lake), "load") & {str(v) for v in tables.versions(spark, base)}
    current = tables.read_table(spark, base)
    out = current.withColumn("closed_by", F.lit(None).cast("long"))
    missing = sorted(int(x) for x in loads - there)
    if missing:
        closed = spark.read.schema(current.schema.add("load", "long")).parquet(_history(lake))
        out = out.unionByName(closed.where(F.col("load").isin(missing)).withColumnRenamed("load", "closed_by"))
    if there:
        tables.overwrite_partitions(out, path, "closed_by")
    else:
        tables.write_partitioned(out, path, "closed_by")


def _replace_days(df: DataFrame, path: str, days: Sequence[object], filled: Sequence[object]) -> None:
    """Rewrite ``days`` of a day-partitioned table: ``df`` holds their rows as
    they are now, on the ``filled`` ones; the others go."""
    if filled:
        tables.overwrite_partitions(df, path, "txn_date", verify=_day_filter(filled))
    tables.drop_partitions(df.sparkSession, path, "txn_date", [d for d in days if d not in filled])


def update_alerts(spark: SparkSession, fact_path: str, alerts_path: str, days: Sequence[object] | None = None) -> DataFrame:
    """Partial alert sums per day and account, as a table partitioned by day.

    With ``days`` only these days of the fact are read and replaced; without,
    or where the table is not there yet, all of them.  The alerts are a sum
    over the partials: high-risk rows only, one for each account and day."""
    fact = spark.read.parquet(fact_path)
    if days is None or not tables.has_data(spark, alerts_path):
        tables.write_partitioned(kpi.alert_partials(fact), alerts_path, "txn_date", verify=True)
    else:
        fresh = kpi.alert_partials(fact.where(_day_filter(days))).checkpoint()
        filled = [r[0] for r in fresh.select("txn_date").distinct().collect()]
        _replace_days(fresh, alerts_path, days, filled)
    return spark.read.schema(kpi.alert_partials(fact).schema).parquet(alerts_path)  # there may be no alert at all


def build_gold(
    spark: SparkSession,
    lake: Lake,
    cfg: RiskConfig,
    location_map: Mapping[str, str] | DataFrame | None = None,
    days: Sequence[object] | None = None,
    publish_db: str | None = None,
    customer_as_of: str | None = None,
) -> dict:
    """Facts, dimensions and KPIs from silver (jobs 4-6 of the source).

    ``days=None`` builds everything from all of silver.  With the days a
    silver load reported, the day-partitioned facts are recomputed for
    those days only (dynamic partition overwrite), the daily KPI is
    recomputed for them and merged with the other days, and the location
    and date dimensions are extended (``days=[]``: no transaction changed,
    so none of these is touched).  ``dim_customer`` holds a partition for
    each customer load that closed rows and one for the current rows: after a
    customer load (``customer_as_of``) only the current rows and the loads
    not yet there are copied, and an incremental run without a customer load
    leaves it as it is.  Work is
    proportional to the load, not to the history.  ``publish_db`` also
    registers every gold output as an external catalog table
    ``publish_db.<name>`` (metadata only).
    """
    silver_txn = spark.read.parquet(lake.silver("transactions"))
    accounts = tables.read_table(spark, lake.silver("accounts"))
    out: dict = {}
    paths = {n: lake.gold(n) for n in ("fact_fraud", "fact_transactions", "dim_customer")}
    incremental = days is not None and all(tables.has_data(spark, paths[n]) for n in ("fact_fraud", "fact_transactions"))
    bases = {n: lake.gold(n) for n in ("kpi_daily_fraud", "dim_location", "dim_date", "alert_top10", "high_risk_count")}
    nothing_new = incremental and not days and all(tables.table_exists(spark, b) for b in bases.values())
    touched = silver_txn.filter(_day_filter(days)) if incremental else silver_txn

    if nothing_new:
        out.update({n: paths[n] for n in ("fact_fraud", "fact_transactions")})
        out.update({n: _latest(spark, b) for n, b in bases.items()})
    else:
        filled = tables.present_partitions(spark, lake.silver("transactions"), "txn_date", days) if incremental else []
        fact = scores.build_fact_fraud(touched, cfg)
        for name, df in (("fact_fraud", fact), ("fact_transactions", touched)):
            if incremental:
                _replace_days(df, paths[name], days, filled)
            else:
                tables.write_partitioned(df, paths[name], "txn_date", verify=True)
            out[name] = paths[name]

        fact_days = spark.read.parquet(paths["fact_fraud"])
        kpi_base = bases["kpi_daily_fraud"]
        if incremental and tables.table_exists(spark, kpi_base):
            fresh = kpi.kpi_daily_fraud(fact_days.filter(_day_filter(days)), ordered=False)
            kept = tables.read_table(spark, kpi_base).filter(~F.coalesce(_day_filter(days), F.lit(False)))
            daily = kept.unionByName(fresh).orderBy("txn_date", "fraud_risk_category")
        else:
            daily = kpi.kpi_daily_fraud(fact_days)
        out["kpi_daily_fraud"] = tables.write_snapshot(daily, kpi_base, verify=True)
        partials = update_alerts(spark, paths["fact_fraud"], lake.gold("alert_days"), days if incremental else None)
        out["alert_top10"] = tables.write_snapshot(kpi.alert_summary_of(partials), bases["alert_top10"], verify=True)
        out["high_risk_count"] = tables.write_snapshot(kpi.high_risk_count_of(partials), bases["high_risk_count"], verify=True)

        loc_base = bases["dim_location"]
        if tables.table_exists(spark, loc_base):
            locs = dims.extend_dim_location(tables.read_table(spark, loc_base), touched, location_map)
        else:
            locs = dims.build_dim_location(touched, location_map)
        out["dim_location"] = tables.write_snapshot(locs, loc_base, verify=True)

        date_base = bases["dim_date"]
        if incremental and tables.table_exists(spark, date_base):
            span = tables.read_table(spark, date_base).select(F.col("full_date").alias("txn_date")).unionByName(
                touched.select("txn_date")
            )
        else:
            span = silver_txn.select("txn_date")
        out["dim_date"] = tables.write_snapshot(dims.build_dim_date_for(span, "txn_date"), date_base, verify=True)

    cust_path = paths["dim_customer"]
    if customer_as_of is not None or days is None or not tables.has_data(spark, cust_path):
        _copy_customers(spark, lake, cust_path, whole=days is None)
    out["dim_customer"] = cust_path

    if tables.table_exists(spark, lake.bronze("credit_history")):
        credit = read_bronze(spark, lake, "credit_history")
        out["fact_credit"] = tables.write_snapshot(
            scores.build_fact_credit(credit, read_silver_customers(spark, lake, current_only=True), cfg),
            lake.gold("fact_credit"),
            verify=True,
        )
    out["dim_accounts"] = tables.write_snapshot(accounts, lake.gold("dim_accounts"), verify=True)
    out["churn"] = tables.write_snapshot(kpi.churn_risk(accounts), lake.gold("churn"), verify=True)
    if publish_db:
        for name, path in out.items():
            tables.publish_path(spark, f"{publish_db}.{name}", path, partitioned=name in paths)
    return out


def run_jobs(
    spark: SparkSession,
    lake: Lake,
    raw: Mapping[str, str],
    as_of: str,
    cfg: RiskConfig,
    location_map: Mapping[str, str] | DataFrame | None = None,
    json_multiline: bool | None = None,
    publish_db: str | None = None,
) -> dict:
    """One load of the whole lake, in the source's job order: ingest each
    raw source given (name -> path), SCD2 customers, SCD1 accounts,
    transactions into silver, then gold.  Returns what each step wrote
    plus the observed transaction quality counts."""
    out: dict = {}
    for name, path in raw.items():
        out[f"bronze_{name}"] = ingest(spark, lake, name, path, as_of, multiline=json_multiline, provenance=True)
    out["rejected"] = {name: rejected_count(spark, lake, name) for name in raw}
    if "customers" in raw:
        out["silver_customer"] = load_silver_customers(spark, lake, as_of)
        out["customer_totals"] = check_customer_load(spark, lake)
    if "accounts" in raw:
        out["silver_accounts"] = load_silver_accounts(spark, lake)
    days: list = []  # no transaction load: no transaction day changed
    if "transactions" in raw:
        out["transaction_quality"] = load_silver_transactions(spark, lake, cfg, location_map)
        days = out["transaction_quality"].get("days")
        out["silver_transaction_rows"] = spark.read.parquet(lake.silver("transactions")).count()
    out["gold"] = build_gold(
        spark, lake, cfg, location_map=location_map, days=days, publish_db=publish_db,
        customer_as_of=as_of if "customers" in raw else None,
    )
    return out
