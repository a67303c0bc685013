"""From raw documents to packed training sequences: a list of stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featmart.llm import exact, langid, mixing, packing, simhash
from featmart.llm.queries import MAX_DISTANCE, SHINGLE, tokenizer_path
from featmart.workdir import cut


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart clearly."""
    return langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, the one with the largest doc_id."""
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of near-duplicates, the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs, SHINGLE, MAX_DISTANCE)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# Compression, XXH64 bit votes, hashed shuffles and the tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES):
            docs = cut(docs, name)
    return docs
