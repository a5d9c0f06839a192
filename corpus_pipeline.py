"""A training corpus from raw documents, stage by stage; each stage's result is stored for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oreline.llm import mixing, neardup, packing, quality, secrets
from oreline.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return quality.good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id."""
    return neardup.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets masked; n_chars follows the new text."""
    return secrets.masked(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those beyond their source's target go."""
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", near_duplicates),
    ("secret scans", secret_scans),
    ("source mix", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: Similarity groups, trained models and token ids cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
