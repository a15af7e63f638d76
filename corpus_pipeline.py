"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import decontaminate, line_dedup, metric_join, packing, quality
from factloom.llm.common import cut, read_table
from factloom.llm.queries import tokenizer


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: the documents that they reject go."""
    return quality.keep_good(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: the first line of each class stays; documents of which nothing is left go."""
    return line_dedup.dedup_lines(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group stays."""
    return metric_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: the documents that hold an item go."""
    return decontaminate.drop_leaking(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"), end_id=2, words=50_000)


STAGES = [
    ("quality rules", good),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

#: Edit distance, tokenizing and packing aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
