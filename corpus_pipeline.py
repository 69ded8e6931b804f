"""Corpus pipeline: language identification, near-duplicate removal, benchmark
decontamination, secret masking, packing.

Each stage is a function of ``(spark, docs, sf_dir)``. All but the last return
the columns of ``documents``; the last returns the packed pieces. ``run``
writes each stage's result as Parquet into the shared work folder and gives the
reread table to the next. Stages that send texts to Python bound the batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartscope.llm import decontaminate, language_id, near_dedup, packing, secret_scan
from cartscope.llm.common import bound_batches, read_documents, read_table, stage


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; those without letters, and those not typical of
    any language the corpus is labelled with, are rejected."""
    bound_batches(spark)
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8)."""
    bound_batches(spark)
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    bound_batches(spark)
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, with their ids."""
    bound_batches(spark)
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

#: The stages learn models and tokenize; SQL can't express the rows of ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
