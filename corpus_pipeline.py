"""Pipeline over ``documents``: toxicity, line dedup, near-dedup, decontamination, encoding.

Each stage takes what its predecessor kept and is written as Parquet before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorelab.llm import decontaminate, line_dedup, pieces, simhash, toxicity
from scorelab.llm.common import load, reachable
from scorelab.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7; the model learns from labelled documents outside the held-out fold."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on ten or more sites go from all documents but the first; every document stays."""
    reachable(spark)
    return line_dedup.drop_boilerplate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 0.8 of its five-word shingles in common: the smallest doc_id."""
    reachable(spark)
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window of ten words."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, row, chunk, n_chunks and ids: one row per document, one per chunk of a giant one."""
    reachable(spark)
    return pieces.encode(docs).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("encoding", encode),
]

#: Fitted models, fingerprints and piece vocabularies are beyond SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
