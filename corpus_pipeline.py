"""The corpus pipeline: stages over documents, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barlake.llm import bpe_tree, curriculum_mix, fertility, ngram_join, quality_embeddings
from barlake.workspace import materialise


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model trained on the labels finds good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_embeddings.keep_good(docs, quality_embeddings.fit(docs, labels))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the tokeniser's bands keep."""
    return fertility.keep_kept(docs, public_tokenizers.path("piece_bpe_32k.model"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return curriculum_mix.training_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian 32-bit numbers) of every document left."""
    return bpe_tree.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("bpe_encoding", bpe_encoding),
]

#: No SQL expresses trained models and token merges; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
