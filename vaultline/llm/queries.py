"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import pii
from vaultline.llm.common import fold_bucket
from vaultline.llm.lines import dedup_lines, kept_digest
from vaultline.llm.merkle import fold, manifest, proof_text
from vaultline.llm.mixing import mix_sources, training_places
from vaultline.llm.neardup import embedding_components
from vaultline.llm.oracle import ORACLE
from vaultline.llm.packing import pack_documents, tokenizer_json
from vaultline.llm.pages import extract_pages
from vaultline.llm.ppm import ppm_score
from vaultline.llm.repetition import repetition_quality
from vaultline.llm.simhash import simhash_components
from vaultline.llm.toxicity import fit_toxicity, score_toxicity
from vaultline.llm.turns import conversation_digests, repair_turns
from vaultline.llm.units import dedup_units


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition_quality(docs, spans_too=False).drop("text")


def op4_extract_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op5_toxicity_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_bucket(F.col("doc_id")) == 0
    model = fit_toxicity(docs, _table(spark, sf_dir, "labels"), ~held_out)
    return score_toxicity(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op6_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    mixed = training_places(mix_sources(docs))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "copies", "positions", "places")


def op2_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold_bucket(F.col("doc_id")) == 1
    got = ppm_score(docs, ~held_out, carry={"held_out": held_out})
    return got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_pii_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    got = pii.find_pii(docs, keep=["doc_id"], models=pii.fit_models(docs))
    counts = [F.size(F.filter("pii_base", lambda x: x["rank"] == k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    base, spans = pii.spans_text(F.col("pii_base")), pii.spans_text(F.col("pii_spans"))
    return got.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def op9_pack_min_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer_json())


def op7_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    got = dedup_units(docs, unit="clause", least_words=15, least_run=30)  # passages, not common short lines
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    kept_in = F.array_sort(F.array_distinct(F.transform("removed", lambda s: s["kept_id"])))
    return got.select("doc_id", F.size("removed").cast("long").alias("n_removed"), F.array_join(spans, ",").alias("removed_spans"), kept_in.alias("kept_in"), "text")


def op8_embedding_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(_table(spark, sf_dir, "embeddings"))


def op10_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash_components(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, dealt by crc32 of ``conv_id:turn``
    modulo 20; a null is one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fate.alias("fate")).where("fate <> 0")
    said = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), said.alias("text"), copies.alias("copy")).drop("copy")


def op11_repair_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(rows, repair_turns(damaged(rows)))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(hit, F.translate("text", capitals, small)).otherwise(F.col("text"))
    got = manifest(docs, altered={"text": tampered})
    folded = fold(F.col("altered_leaf"), F.col("path"))
    got = got.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return got.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return kept_digest(dedup_lines(docs), "text", "keep").select("doc_id", "n_lines", "n_dropped", "kept_sha256")


QUERIES = {
    "op1_quality_repetition": op1_quality_repetition,
    "op2_ppm_score": op2_ppm_score,
    "op3_pii_boosted": op3_pii_boosted,
    "op4_extract_template": op4_extract_template,
    "op5_toxicity_subword": op5_toxicity_subword,
    "op6_mix_curriculum": op6_mix_curriculum,
    "op7_dedup_lines": op7_dedup_lines,
    "op8_embedding_collisions": op8_embedding_collisions,
    "op9_pack_min_slack": op9_pack_min_slack,
    "op10_simhash_gray": op10_simhash_gray,
    "op11_repair_turns": op11_repair_turns,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_dedup_lines": op13_dedup_lines,
}

__all__ = ["ORACLE", "QUERIES"]
