"""Documents to training sequences, one operator a stage. Each stage is written as Parquet and read again as
the documents of the next; all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regtables.llm import decontaminate, exact_dedup, lsh_forest, packing, quality
from regtables.llm.common import work_folder, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of exact copies the one with the largest doc_id."""
    return exact_dedup.without_copies(docs)


def distinct_content(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, five words and a similarity of 0.8, the one with the smallest doc_id."""
    return lsh_forest.without_near_copies(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def training_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", distinct_texts),
    ("MinHash near-dedup", distinct_content),
    ("benchmark decontamination", not_in_benchmark),
    ("best-fit packing", training_sequences),
]

# A trained classifier and a tokenizer decide what the rows are; SQL has neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{k}")
    return docs
