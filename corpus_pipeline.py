"""The corpus pipeline over ``documents``: quality rules, near duplicates,
personal data, mixing, packing.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaultline.llm import stages
from vaultline.session import scratch_path

STAGES = [
    ("quality rules", stages.quality),
    ("simhash near-dedup", stages.near_duplicates),
    ("personal data", stages.personal_data),
    ("mixing to target weights", stages.mixing),
    ("best-fit packing", stages.packing),
]

#: suffix arrays, fingerprints, boosted trees and packing are not SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; the stages between are
    written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
