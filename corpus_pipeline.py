"""The corpus pipeline: documents to training shards in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet under the shared checkpoint folder and read again as the
next stage's ``docs``.  All but the last return the columns of ``documents``;
the last adds ``size``, ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import decontaminate, mixing, quality, sharding, simhash
from tallyfold.llm.common import table
from tallyfold.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the line CRF keep."""
    return quality.retain(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"), column="__leaks")
    return marked.where(F.size("__leaks") == 0).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0, 1 or 2 times)."""
    mixed = mixing.mix(docs, prefix="__mix_")
    times = F.array_repeat(F.lit(1), F.col("__mix_copies").cast("int"))
    return mixed.withColumn("__mix_once", F.explode(times)).select(*docs.columns)


def size_balanced_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot in it."""
    return sharding.shard(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", size_balanced_sharding),
]

#: The CRF's verdicts and the SimHash components are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
