"""Corpus pipeline: toxic documents go, one document of each near-duplicate group stays, benchmark leaks go, sources are
mixed to their target weights, and what is left is dealt into shards.

Every stage takes (spark, docs, sf_dir), works on all rows of its predecessor and returns the columns of documents;
the last returns each document's place in the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import decontaminate, jaccardjoin, mixing, sharding, toxicity
from factloom.llm.common import table, written

#: Near-duplicates: words of a shingle and similarity of two sets in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80
SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier learns from the labelled documents among ``docs``."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccardjoin.dedup(docs, SHINGLE_WORDS, SIMILARITY, 100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.digest(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Compression lengths and R-trees are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
