"""Corpus pipeline: rate, deduplicate, decontaminate, redact and encode documents.

Each stage takes (spark, docs, sf_dir) and gives a table that is written and read again as
the next one's ``docs``. All but the last keep the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import bpe, decontaminate, near_dup, pii, quality
from basketry.llm.common import materialise, read_table, tune
from basketry.llm.queries import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on ``labels``, does not reject."""
    return quality.drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id."""
    return near_dup.drop_near_duplicates(docs)


def keep_clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, per document."""
    return bpe.encode_and_decode(docs, vocabulary_path(), stored=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_dup", keep_one_of_near),
    ("decontaminate", keep_clean_of_benchmark),
    ("pii", redact_personal_data),
    ("bpe", encode_texts),
]

# The quality model is trained by iteration, which SQL cannot express; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's table is written before the next starts."""
    tune(spark)
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
