"""From raw documents to token ids: the stages in order, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gavelcast.llm import decontaminate, ngram_join, pieces, quality_rules, secret_scan
from gavelcast.llm.catalog import ship, table, tokenizer
from gavelcast.runtime import scratch_path


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    return quality_rules.clean(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    ship(spark)
    return ngram_join.one_of_each(docs, width=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_scan.masked(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and token ids of all documents."""
    ship(spark)
    return pieces.encoded(docs.select("doc_id", "text"), tokenizer("piece_bpe_32k.model")).drop("text")


STAGES = [("quality_rules", rules), ("near_copies", near_copies), ("benchmark", benchmark), ("secrets", secrets), ("encode", encode)]

# Viterbi segmentation, tiling and the forest cannot be said in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
