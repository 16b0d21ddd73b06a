"""The corpus pipeline: quality rules, near-dedup, PII, mixing to target weights, BPE encoding.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read as the next one's ``docs``.
All but the last return the columns of ``documents``.

Defined results: a document with a null or empty text fails the quality rules and goes, as do those of rejected hosts; a null
doc_id is kept, without near-duplicates; rows repeated with id and text are one document after near-dedup; documents of
any length pass whole; ties in a group of near-duplicates go to the smallest doc_id; labels of documents that are gone, or
with nulls, have no part; without labels all rates are 1; other columns, whatever their names, pass through all stages
but the last; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deidflow.llm import bpe, mixing, neardup, pii, quality
from deidflow.llm.shared import materialise, small_batches


#: Similarity from which the near-dedup stage takes documents for copies; op1's own contract has 0.85.
NEAR = 0.8


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go."""
    small_batches(spark)
    return quality.keep(docs)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that of the smallest doc_id."""
    small_batches(spark)
    return neardup.keep(docs, NEAR)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to pseudonyms of their format."""
    return pii.pseudonymise(docs, pii.session_key(spark)).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out as their rates say."""
    return mixing.resample(docs, mixing.labels(spark, sf_dir))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded: token count and digests."""
    small_batches(spark)
    return bpe.encode(docs, ids=False)


STAGES = [
    ("quality", quality_stage),
    ("neardup", neardup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Near-duplicates by chosen paths and Feistel pseudonyms are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs
