"""A corpus from raw documents to shards: five stages, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardspan.llm.common import crc_of_id, fresh_name
from wardspan.llm.decontamination import decontaminate
from wardspan.llm.langid import fit, reject_unknown
from wardspan.llm.mixing import mix
from wardspan.llm.sharding import shard
from wardspan.llm.simhash import near_duplicates
from wardspan.runtime import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those whose text is null or has no letter go."""
    return reject_unknown(docs, fit(docs.filter(crc_of_id("doc_id") % 5 != 0)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    return near_duplicates(docs).filter("representative").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    copy = fresh_name(docs, "copy")
    mixed = mix(docs).filter("copies > 0")
    numbers = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(copy)
    return mixed.select(*docs.columns, numbers).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes: its shard and its place there."""
    return shard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The first two stages run models and hashes that SQL does not have.
ORACLE_SQL: str | None = None
