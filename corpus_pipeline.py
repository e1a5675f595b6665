"""A training corpus from ``documents``: rules, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of ``documents``: the first three drop rows, mixing repeats rows of the
smaller sources (at most twice as often as those of the largest, which appear once, so nothing that
was kept is lost), and packing returns a row per piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trialbook.llm import exact_dedup, minhash, mixing, packing, quality
from trialbook.session import stage as written

MOST_REPEATS = 2.0


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.survivors(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return minhash.survivors(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources asks."""
    return mixing.mixed(docs, most_repeats=MOST_REPEATS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack(packing.pieces(docs, packing.byte_bpe()))


STAGES = [("quality rules", rules), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", pack)]

# Tokens and their packing are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = written(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
