"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltspan.llm import (
    archives,
    chat,
    chunks,
    decontamination,
    divergence,
    extraction,
    interactions,
    language,
    mixing,
    near,
    sharding,
    urls,
    winnowing,
)
from voltspan.llm.common import read


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(read(spark, sf_dir, "pages"))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.against_next(read(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(read(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, lean=True).drop("copies")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.deduplicated(read(spark, sf_dir, "documents"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(read(spark, sf_dir, "documents")).drop("text_key")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_conversations(table.unionByName(chat.adversary(spark)))


def op9_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archives.round_trip(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placements(read(spark, sf_dir, "documents"))


def op11_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audited(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(read(spark, sf_dir, "documents"))


def op13_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_main_text,
        op2_winnowing,
        op3_language,
        op4_decontamination,
        op5_mixing,
        op6_substrings,
        op7_near_duplicates,
        op8_chat,
        op9_archives,
        op10_sharding,
        op11_interactions,
        op12_divergence,
        op13_url_rules,
        pipeline,
    )
}
ORACLES = {
    "op4_decontamination": decontamination.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op8_chat": chat.ORACLE,
    "op9_archives": archives.ORACLE,
    "op11_interactions": interactions.ORACLE,
    "op12_divergence": divergence.ORACLE,
    "op13_url_rules": urls.ORACLE,
}
