"""Corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark text, tokens.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartwright.llm import bpe, decontaminate, fertility, jaccard, passages
from chartwright.llm.queries import PIECES, WORD_BPE, table
from chartwright.plans.session import arrow_batches, discard, materialize, stage_scope

#: SQL cannot run a subword vocabulary; the stages are tested by brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """The documents whose id is not listed; the list is written first, so the join is planned from its size."""
    return docs.join(materialize(gone, name), "doc_id", "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules do not reject."""
    verdicts = fertility.quality(docs, public_tokenizers.path(PIECES))
    with arrow_batches(spark):
        return _without(docs, verdicts.filter(~F.col("kept")).select("doc_id"), "rejected")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    with arrow_batches(spark):
        found = jaccard.near_duplicates(docs)
    return _without(docs, found.filter("component_id <> doc_id").select("doc_id"), "duplicates")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that repeat an earlier document's."""
    with arrow_batches(spark):
        found = materialize(passages.passages(docs), "passages")
    return passages.cut(docs, found)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text by the contamination rule."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.filter("contaminated").select("doc_id"), "contaminated")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of what they decode to."""
    return bpe.encode(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote on its way, and the stage before it, goes when its result is written."""
    docs = source = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with stage_scope(spark):
            made = materialize(stage(spark, docs, sf_dir), name, keep=True)
        if docs is not source:
            discard(docs)
        docs = made
    return STAGES[-1][1](spark, docs, sf_dir)
