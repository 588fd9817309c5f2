"""Transactions landing as JSON files, loaded into silver as they arrive.

The batch job appends one bronze batch at a time; here the same step is
driven by Structured Streaming: a file source over the landing folder,
``foreachBatch`` applying the idempotent, order-independent silver append
to each micro-batch, and the stream checkpoint in the shared checkpoint
folder.  Because the append re-emits touched days with the batch winning
on ``transaction_id``, a micro-batch replayed after a failure writes the
same rows again (effectively exactly-once into silver).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vaultline.config import RiskConfig
from vaultline.operators.audit import add_audit
from vaultline.plans import jobs
from vaultline.schemas import TRANSACTIONS
from vaultline.session import scratch_path


def start_transaction_stream(
    spark: SparkSession,
    landing: str,
    silver_path: str,
    accounts: Callable[[], DataFrame],
    customers_current: Callable[[], DataFrame],
    cfg: RiskConfig,
    location_map: Mapping[str, str] | DataFrame | None = None,
    checkpoint: str | None = None,
    as_of: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; ``accounts`` / ``customers_current`` are called per
    micro-batch so that each batch joins the newest dimension snapshots.

    ``available_now=True`` processes what has landed and stops (scheduled
    runs); ``False`` keeps polling.
    """
    stream = (
        spark.readStream.schema(TRANSACTIONS)
        .option("maxFilesPerTrigger", max_files_per_trigger or 1000)
        .json(landing)
    )
    stream = add_audit(stream, "transactions.json", as_of)

    def load(batch: DataFrame, batch_id: int) -> None:
        # the load reads its batch several times (bounds, rows, keys,
        # accounts): parse the landed files once (spills to disk; lost
        # blocks are recomputed from the files)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            jobs.append_silver_transactions(
                batch.sparkSession, batch, accounts(), customers_current(), silver_path, cfg, location_map
            )
        finally:
            batch.unpersist()

    w = stream.writeStream.foreachBatch(load).option(
        "checkpointLocation", checkpoint or scratch_path(spark, "stream-checkpoint")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
