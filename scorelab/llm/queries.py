"""Registered queries of the numbered operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorelab.llm import decontaminate, extraction, graph_ann, langid, line_dedup, merkle, oracle, periodic, pieces, pii, secret_scan, sharding, simhash, toxicity
from scorelab.llm.common import fold, load


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select(*columns)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(documents(spark, sf_dir, "doc_id", "text"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir, "doc_id", "text"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlap_digests(documents(spark, sf_dir, "doc_id", "text"), load(spark, sf_dir, "benchmark"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digests(documents(spark, sf_dir, "doc_id", "text"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(documents(spark, sf_dir, "doc_id", "text", "source"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_ann.nearest(load(spark, sf_dir, "embeddings"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_digests(documents(spark, sf_dir, "doc_id", "text"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = langid.identify(docs, langid.fit(langid.train_part(docs)))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op11_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(load(spark, sf_dir, "pages"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_proofs(documents(spark, sf_dir, *merkle.LEAF_COLUMNS))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return periodic.run_digests(docs.select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text")))


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_simhash": op2_simhash,
    "op3_sharding": op3_sharding,
    "op4_decontamination": op4_decontamination,
    "op5_pieces": op5_pieces,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_neighbours": op8_neighbours,
    "op9_personal_data": op9_personal_data,
    "op10_language": op10_language,
    "op11_extraction": op11_extraction,
    "op12_manifest": op12_manifest,
    "op13_periodic": op13_periodic,
}
#: The other queries rest on fits, hashes, scans or searches that SQL cannot state; tests/llm checks them by brute force.
ORACLE: dict[str, str] = {"op4_decontamination": oracle.DECONTAMINATION, "op6_line_dedup": oracle.LINE_DEDUP, "op12_manifest": oracle.MERKLE}
