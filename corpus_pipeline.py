"""Corpus pipeline: quality, near duplicates, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir), works on all rows of `docs` and returns a table that is
written as Parquet and read again as the next stage's `docs`. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm.jaccard import drop_near_duplicates
from labelloom.llm.leaks import drop_leaking
from labelloom.llm.mixture import mix
from labelloom.llm.quality import drop_bad
from labelloom.llm.shards import shard_rows
from labelloom.llm.store import land

SHARDS = 16


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_bad(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one with the smallest id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or dropped as their rates towards the target weights say."""
    return mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot; equal texts, such as a document's repeats, share a shard."""
    return shard_rows(docs, SHARDS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("sharding", sharding),
]

# No SQL states a trained classifier or an iterative fit; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each over all that the one before kept, which is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
