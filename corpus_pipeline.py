"""A pipeline over ``documents``: drop toxic texts, near copies and benchmark leaks, mix, shard.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs.  All but the
last return the columns they were given.  Null and empty texts pass all filters, except
that near-copy removal keeps one of them; see the operators for repeated rows, ties and
nulls.  No SQL can express the filters, so there is no ORACLE_SQL; tests/llm/
test_pipeline.py compares the stages with plain versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontamination, mixing, sharding, simhash, toxicity
from tidewatch.llm.common import stored

SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, words=4, bits=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat_mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near copies", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each but the last is stored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
