"""The corpus pipeline: documents in, a mixed training set out.

Each stage works on all that its predecessor kept; ``run`` writes each stage's rows to the shared scratch folder and
reads them again for the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchloom.llm import decontaminate, jaccard_join, mixing, suffix_dedup, weak_labels
from matchloom.llm.common import store, table

NEAR_WORDS = 5
NEAR_PERCENT = 80
REPEAT_BYTES = 100


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of weak labels does not reject."""
    return weak_labels.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity, that with the smallest id."""
    return jaccard_join.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that start earlier in the corpus."""
    return suffix_dedup.without_repeats(docs, length=REPEAT_BYTES)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix reads, with their size and how often it reads them."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", repeat_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources to target weights", mix_stage),
]

ORACLE_SQL = None  # the classifier learns; the whole is tested against plain versions of its stages


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
