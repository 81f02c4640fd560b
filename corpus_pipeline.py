"""The training-data pipeline: each stage works on the rows that the one before it kept.

Every stage is written as Parquet in the shared folder and read back as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.llm.common import documents, kept, workers_import_package
from saleswright.llm.decontamination import without_contaminated
from saleswright.llm.exact_dedup import without_duplicates
from saleswright.llm.hmm_scoring import fold
from saleswright.llm.packing import pack
from saleswright.llm.simhash_dedup import without_near_duplicates
from saleswright.llm.tokens import vocabulary_path
from saleswright.llm.toxicity import without_toxic

#: No SQL: it has no tokenizer and trains no classifier.
ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that a factorization machine of the labels predicts to be toxic go."""
    workers_import_package(spark)
    learns = fold(F.col("doc_id"), 5) != 0
    return without_toxic(docs, documents(spark, sf_dir, "labels"), learns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the one with the most characters stays."""
    workers_import_package(spark)
    return without_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that links between near fingerprints join, the one of the least doc_id stays."""
    workers_import_package(spark)
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row from a benchmark item go."""
    return without_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, cut and packed into sequences of 4096 tokens."""
    workers_import_package(spark)
    return pack(docs, vocabulary_path("word_bpe_49k.json"), capacity=4096, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
