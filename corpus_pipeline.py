"""A training-data pipeline over ``documents``: quality, near-duplicates, benchmark leaks, mixing, shards.

Every stage takes all rows that the one before it kept and returns them with the columns of ``documents``; the last one
adds ``slot`` and ``shard``. The result of a stage is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmart.llm import decontam, mixing, neardup, quality, sharding
from eventmart.llm.common import prepare


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or the adaptive rules go."""
    return quality.keep_good(docs, prepare(spark))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return neardup.keep_one(docs, prepare(spark))


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"), prepare(spark))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as their rates say; toxic ones get a rate near zero."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return mixing.mixed(docs, labels, prepare(spark))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its shard."""
    prepare(spark)
    return sharding.place(docs, sharding.shard_names())


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", neardup_stage),
    ("decontamination", decontam_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The mixing stage trains a model, which SQL cannot express; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    area = prepare(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = area.table(stage(spark, docs, sf_dir), f"{k}_{name}")
    return docs
