"""Documents made ready for training: language, near copies, benchmark leaks, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewright.llm import decontaminate, jaccard, langid, packing, secrets
from tidewright.llm.common import fold_of, table
from tidewright.session import configure, materialise

#: A text whose best language has less than this probability is in none.
LEAST = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the network learns from the labelled ones outside fold 0."""
    return langid.with_language(docs, langid.fit(docs, fold_of(F.col("doc_id")) != 0), LEAST)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the Jaccard join."""
    return jaccard.one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets replaced by a mark."""
    return secrets.redact(docs)


def bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin."""
    return packing.pack(docs)


STAGES = [("language", language), ("near copies", near_copies), ("benchmark leaks", leaks), ("secrets", secret_values), ("packing", bins)]

#: A trained network, connected components and best fit are not for SQL; tests/llm/test_pipeline.py follows the stages by hand.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written to the shared folder and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialise(docs, "stage")
    return docs
