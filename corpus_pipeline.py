"""Corpus pipeline: classify, deduplicate, decontaminate, mix and shard ``documents``.

``STAGES`` lists ``(name, function)``; each function takes
``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontam, jaccard_join, mixing, quality, sharding
from strata.llm.scratch import Scratch

#: The stages learn, iterate and break ties by hash; tests hold them against brute force.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return quality.accepted(docs, Scratch(spark, "pipeline-quality"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of texts linked at Jaccard 0.8 or more."""
    return jaccard_join.one_of_each_group(docs, Scratch(spark, "pipeline-jaccard"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is inside a benchmark window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.clean(docs, items, Scratch(spark, "pipeline-decontam"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as the target weights of their sources take them."""
    return mixing.mix(docs, Scratch(spark, "pipeline-mix"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return sharding.balanced_shards(docs, Scratch(spark, "pipeline-shards"), carry=("lang", "source"))


STAGES = [
    ("quality", classify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
