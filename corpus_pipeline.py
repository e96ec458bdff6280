"""From raw documents to packed training sequences, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.classifier import quality_weights, score
from meterlake.llm.common import documents, labels, stored
from meterlake.llm.exact import without_copies
from meterlake.llm.jaccard import without_near_copies
from meterlake.llm.mixing import mixed_documents
from meterlake.llm.packing import default_vocabulary, packed_rows, places


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives at least 0.5; it learns from the labels of ``docs``."""
    weights = quality_weights(docs, labels(spark, sf_dir))
    return docs.where(score(F.col("text"), weights, spark) >= 0.5)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document and pass, its text the words that the pass takes."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences, which are written."""
    return places(packed_rows(docs, default_vocabulary()))


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("mixing", mixing),
    ("best_fit_packing", packing),
]

#: A trained classifier and hashed draws: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
