"""The file-landing stream resumes from its checkpoint."""

from pyspark.sql import functions as F

from vaultline.config import AS_OF_1, FIXTURE
from vaultline.plans import catalog as C
from vaultline.session import scratch_path
from vaultline.sources import fixtures as fx
from vaultline.streaming import start_transaction_stream

SF = "/root/testdata/sf0.001"


def test_stream_resumes_and_equals_one_shot(spark):
    raw = fx.transactions_raw(spark, SF)
    part = F.pmod(F.xxhash64("timestamp", "account_id"), F.lit(2))
    landing = scratch_path(spark, "landing")
    silver = scratch_path(spark, "silver-stream")
    ckpt = scratch_path(spark, "stream-ckpt")
    acc, cust, loc = fx.accounts(spark, SF), fx.customers(spark, SF), fx.location_map(spark, SF)

    def run():
        q = start_transaction_stream(
            spark, landing, silver, lambda: acc, lambda: cust, FIXTURE, loc, checkpoint=ckpt, as_of=AS_OF_1,
            max_files_per_trigger=1,
        )
        q.awaitTermination()
        return q

    raw.filter(part == 0).coalesce(1).write.mode("append").json(landing)
    first = run()
    assert spark.read.parquet(silver).count() > 0
    raw.filter(part == 1).coalesce(1).write.mode("append").json(landing)
    second = run()
    assert first.lastProgress is not None and second.lastProgress is not None
    # the second run read only the newly landed file, and parsed it once
    assert second.lastProgress["numInputRows"] == raw.filter(part == 1).count()

    got = spark.read.parquet(silver).withColumns(
        {"transaction_id": F.col("transaction_id").cast("long"), "account_id": F.col("account_id").cast("long")}
    )
    one_shot = C.silver_raw(spark, SF)
    got = got.select(*one_shot.columns)
    assert got.count() == one_shot.count() == 964
    assert got.exceptAll(one_shot).count() == 0
