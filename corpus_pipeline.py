"""The training-data pipeline over ``documents``.

Every stage reads what its predecessor kept and is written as Parquet before the next one starts, so a
lost executor never replays an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from tidemark.llm.common import load, written


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects (score 0.5 or more)."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text that is equal up to white space."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar 4-word shingle sets."""
    return near_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly benchmark dropped."""
    return decontaminate.remove_benchmark(docs, load(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048 ids at most, with the ids."""
    return packing.pack(docs, packing.default_tokenizer(), with_ids=True).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxic), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", benchmark), ("packing", packed)]

#: The models and the tokenizer have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the ``documents`` of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
