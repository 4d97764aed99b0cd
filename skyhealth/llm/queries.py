"""Queries of the operators, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyhealth.llm import (bpe, chat, context_tree, decontaminate, divergence, language, privacy, quality, sharding,
                           simhash, suffix_dedup, token_counts, vector_codes)
from skyhealth.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f
    return add


@query("op6_decontamination", decontaminate.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judge(read_table(spark, sf_dir, "documents"),
                                read_table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op7_sharding", sharding.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


@query("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), ["doc_id"])


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    # file_id and doc_no depend on how Spark splits the scan.
    return token_counts.of_documents(read_table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


@query("op2_chat", chat.SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


@query("op5_quality", quality.SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents")).drop("text")


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), ["doc_id"])


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


@query("op1_suffix_dedup", suffix_dedup.SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(read_table(spark, sf_dir, "documents"), with_text=False)
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op4_context_tree")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(read_table(spark, sf_dir, "documents"))


@query("op13_divergence", divergence.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


@query("op11_vector_codes", vector_codes.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


@query("op12_privacy", privacy.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.find(read_table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
