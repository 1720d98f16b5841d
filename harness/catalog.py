"""All registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from harness import queries_extract, queries_sequences, queries_explain  # noqa: F401  (register on import)
from harness.registry import ORACLES, QUERIES, rounded
from harness.stage import Stage
from propensight.operators import sequences as S

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extraction to sequences with labels and inactivity for one cutoff, one row per id."""
    s = Stage(spark, sf_dir)
    examples = S.sequence_examples(s.features, s.params.max_len, s.params.horizon)
    return rounded(examples.select("data_date", "id", "seq_length", "inactivity", "label"))
