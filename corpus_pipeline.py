"""From raw documents to training shards: quality rules, near-duplicate removal,
benchmark decontamination, mixing to target weights, sharding.

Each stage takes all rows its predecessor kept and returns the columns of
``documents``; the last adds the shard. Quality rules and decontamination drop
rows, near-duplicate removal keeps one row of each class, mixing repeats the rows
of small sources and samples large ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import decontamination, mixing, near_dedup, quality_rules, sharding
from skyledger.llm.common import Scratch
from skyledger.sources.star_tables import table

SHARDS = 16


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.first_of_class(docs, Scratch(spark, "near"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, Scratch(spark, "mix"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.sharded_rows(docs, SHARDS)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL cannot express the fitted rules, the sampled candidates and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written as Parquet and read again."""
    scratch, docs, before = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
