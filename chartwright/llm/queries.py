"""The registered queries ``opN_<name>``: each operator over its whole table.

A query derives the digest columns of its result from the operator's output.
Vocabulary files come from the ``public_tokenizers`` package on every machine.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwright.llm import (
    bpe, chat, decontaminate, extract, fertility, jaccard, langid, licenses, merkle, negatives, oracles, packing, passages, warc)
from chartwright.plans.session import arrow_batches

PIECES = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE)).drop("ids")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("n_blocks", F.size("blocks").cast("long")).drop("blocks")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.passages(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("target").alias("source_doc_id"), *found.columns[2:])


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    with arrow_batches(spark):
        return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("class_id")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = langid.train(langid.sample(docs, ~held_out))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.rotate(table(spark, sf_dir, "conversations"))
    mask = F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return found.select(
        "conv_id", "participant", "chunk_no", "n_turns", "start", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        F.array_join(mask, ",").alias("mask"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = packing.Vocabulary(public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, public_tokenizers.path(BYTE_BPE))
    pieces = packing.pack(table(spark, sf_dir, "documents"), vocabulary)
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), F.col("id") % 50 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle.manifest(docs, tampered, {"text": F.translate("text", merkle.UPPER, merkle.LOWER)})
    return found.withColumnRenamed("id", "doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_license_scan": op2_license_scan,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_decontamination": op4_decontamination,
        "op5_html_extraction": op5_html_extraction,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_language_id": op7_language_id,
        "op8_chat_formatting": op8_chat_formatting,
        "op9_warc": op9_warc,
        "op10_quality_rules": op10_quality_rules,
        "op11_packing": op11_packing,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the operators that SQL can express."""
    return dict(oracles.SQL)
