"""From raw documents to a mixed training corpus, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns documents; all but the last return the
columns of their input, and the last adds the number of ``copies`` to train on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metforge.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_rules
from metforge.session import scratch_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of windows of three lines cut out; documents that lose every line go."""
    return line_dedup.drop_lines(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return jaccard_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, with the number of copies."""
    return mixing.mixed_docs(docs)


STAGES = [
    ("quality_rules", good_quality),
    ("line_dedup", without_repeated_lines),
    ("jaccard_join", one_of_similar),
    ("decontaminate", without_benchmark),
    ("mixing", mixed),
]

# the fences of one stage and the components of another depend on what earlier stages left, text by text: tested by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
