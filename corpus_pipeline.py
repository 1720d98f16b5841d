"""From raw documents to a training mix: five stages, each reading what the one before it wrote.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame with the columns of documents; the last adds the
number of the copy and the key of the global order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from propensight.llm import contamination, language, mixing, near_dups, pii
from propensight.llm.common import DOCUMENT_COLUMNS, prepare, table
from propensight.session import materialize

LIKE = 80  # per cent of the union from which two documents are near copies here; op9 has its own


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters go."""
    prepare(spark)
    return language.keep_known(docs.select(*DOCUMENT_COLUMNS))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates at a similarity of 0.80: the document with the least id of each group stays."""
    prepare(spark)
    return near_dups.keep_one(docs.select(*DOCUMENT_COLUMNS), LIKE)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: benchmark passages are cut out, documents that are mostly benchmark go."""
    return contamination.decontaminate(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: every span is replaced by its kind."""
    prepare(spark)
    clean = pii.mask(docs.select(*DOCUMENT_COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents are repeated to the target weights of their sources and ordered by a hash."""
    prepare(spark)
    return mixing.poisson_mix(docs.select(*DOCUMENT_COLUMNS))


STAGES = [("language ID", known_language), ("near-duplicates", one_of_each), ("decontamination", no_benchmark),
          ("personal data", no_personal_data), ("mixing", mixed)]

# Learned classifiers and repeated cutting have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k}")
    return docs
