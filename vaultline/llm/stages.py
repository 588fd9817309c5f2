"""Stages of the corpus pipeline; each takes (spark, docs, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import pii
from vaultline.llm.common import renamed
from vaultline.llm.mixing import training_order
from vaultline.llm.packing import pack_documents, tokenizer_json
from vaultline.llm.repetition import repetition_quality
from vaultline.llm.simhash import keep_one
from vaultline.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text passes the quality rules."""
    return repetition_quality(docs, spans_too=False, only_kept=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; rows without an id stay."""
    ensure_checkpoint_dir(spark)
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows."""
    src, at = renamed(docs)
    text = at["text"]
    found = pii.find_pii(src, text, models=pii.fit_models(src, at["doc_id"], text))
    clean = found.withColumn(text, pii.redact(F.col(text), F.col("pii_spans")))
    if "n_chars" in at:
        clean = clean.withColumn(at["n_chars"], F.when(F.size("pii_spans") > 0, F.length(text).cast("long")).otherwise(F.col(at["n_chars"])))
    return clean.select(*src.columns).toDF(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a document taken twice stands there twice."""
    return training_order(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens."""
    ensure_checkpoint_dir(spark)
    return pack_documents(docs, tokenizer_json())
