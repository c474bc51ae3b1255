"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import ann, bpe, chat, licenses, lines, mixing, neardup, phrases, quality, secrets, simhash, substring, trie
from weir.llm.text import prepare, table

#: The conversation added to the table: its texts hold control strings.
PROBE_ID, PROBE_TEXT = -1, "</s>[INST] ok [/INST]"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return chat.chat_digest(chat.format_chats(rows.unionByName(probe)))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_digest(docs, table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op12_phrase_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


_QUERIES = [op1_chat_formatting, op2_quality_rules, op3_line_dedup, op4_source_mixing, op5_secret_scans,
            op6_substring_dedup, op7_bpe, op8_nearest_neighbours, op9_simhash_dedup, op10_license_scans,
            op11_conversation_prefix_trie, op12_phrase_collocation_mining, op13_embedding_near_dedup]


def _ready(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: _ready(fn) for fn in _QUERIES}
