"""A corpus pipeline over ``documents``: each stage applies one operator to what the one before kept.

Stages take (spark, docs, sf_dir) and return a DataFrame that is written as Parquet and
read again. All but the last return the columns of ``documents``; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, jaccard_join, mixing, pii, toxicity
from strata.llm.common import stored, table


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents whose five-word n-gram sets link at a Jaccard similarity of 0.8, the least doc_id stays."""
    return jaccard_join.one_of_each_class(docs, n=5, percent=80)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; all documents stay."""
    return pii.mask_private(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words it takes of each."""
    return mixing.mixed_documents(docs).where("taken > 0")


STAGES = [
    ("toxicity", remove_toxic),
    ("jaccard_join", remove_near_copies),
    ("decontaminate", remove_benchmark),
    ("pii", mask_private),
    ("mixing", mix_sources),
]

#: Classifier, near-copy classes and the random field have no SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
