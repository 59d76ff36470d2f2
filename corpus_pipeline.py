"""From raw documents to shards of a training mix: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltspan.llm import decontamination, language, mixing, near, sharding
from voltspan.llm.common import beside, read
from voltspan.session import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin; ``lang`` keeps its given value."""
    learned = language.learn(docs.filter(~language.held_out(F.col("doc_id"))).select("text", "lang"))
    return beside(docs, language.ADDED, lambda rows: language.identify(rows, learned).filter("not rejected"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near.one_per_class(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontamination.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their size, checksum, shard and slot."""
    return sharding.shard(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", not_in_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

# language identification and the near-duplicate classes can't be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
