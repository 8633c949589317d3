"""A training-corpus pipeline over the documents table, stage by stage.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the
last deals them to shards. Every stage's result is written as Parquet and read again, so a lost
executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesflow.llm.decontaminate import without_contaminated
from salesflow.llm.hilbert import shards
from salesflow.llm.minhash import without_near_duplicates
from salesflow.llm.mixing import mixed
from salesflow.llm.queries import with_package
from salesflow.llm.toxicity import without_toxic
from salesflow.session import staged


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine, learnt from the labels, does not reject."""
    with_package(spark)
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near duplicates: five words, 0.8."""
    with_package(spark)
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows hit less than a twentieth of the words."""
    with_package(spark)
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the schedule of target weights takes them."""
    with_package(spark)
    return mixed(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard and slot along the Hilbert curve."""
    made = {"size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve"}
    return shards(docs, keep=[c for c in docs.columns if c not in made])


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
    ("hilbert_sharding", sharding),
]

#: A trained model and checksums decide here; the tests hold each stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
