"""A corpus pipeline over ``documents``: each stage calls one operator of ``simcat.llm``.

Stages take (spark, docs, sf_dir) and return a DataFrame that is written as Parquet and read again
as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from simcat.llm import circulant, digest_merge, packing, suffix_automaton, toxicity
from simcat.llm.common import materialise, table

NEAR = 80                # per cent of the union of two documents' shingles; op7 alone links at 85


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go; labels of the training fold fit the score."""
    return toxicity.filter_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest ``doc_id`` stays."""
    return digest_merge.filter_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (links at 0.8) stays, that with the smallest
    ``doc_id``."""
    return circulant.filter_documents(docs, NEAR)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are nearly all benchmark text go."""
    return suffix_automaton.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents packed into training sequences of several lengths."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", cut_benchmark),
    ("pack", pack),
]

# The toxicity score, near-duplicate components and bin packing can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
