"""Corpus pipeline: documents -> token ids of a mixed training corpus.

Quality rules drop rejected documents; line dedup cuts repeated three-line
windows out of the rest; SimHash near-dedup keeps one document of each group;
mixing repeats or leaves out documents to meet the sources' target weights; BPE
encodes what is left. Each stage's rows are written as a table and read again by
the next, so a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import bpe, lines, mixing, quality, simhash
from weir.llm.text import prepare, table, write_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the model, trained on the labels, keep."""
    prepare(spark)
    return quality.keep_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated windows of lines; ``n_chars`` follows the text."""
    prepare(spark)
    kept = lines.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return simhash.keep_one_per_group(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as the mix takes it."""
    prepare(spark)
    return mixing.mix(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row."""
    prepare(spark)
    out = bpe.with_tokens(docs.select("doc_id", "lang", "source", "text"))
    return out.select("doc_id", "lang", "source", F.size("tokens").cast("long").alias("n_tokens"), "tokens")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("simhash near-dedup", simhash_dedup),
          ("source mixing", source_mixing), ("bpe encoding", bpe_encoding)]

#: The quality model and SimHash's XXH64 are beyond SQL: tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_table(docs, name.replace(" ", "-"))
    return docs
