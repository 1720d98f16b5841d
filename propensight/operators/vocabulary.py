"""Append-only value lists: vocabularies of coded columns and slot maps of indicator columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from propensight import constants as C
from propensight.operators.numbering import global_numbers


def constant_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A few fixed rows as an inline relation."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def seed_table(spark: SparkSession, features: list[str], seed: tuple[str, int]) -> DataFrame:
    return constant_table(spark, [(f, *seed) for f in features], ["feature", "value", "code"])


def _grow(old: DataFrame, found: DataFrame) -> DataFrame:
    """Append the new ``(feature, value)`` pairs with the next codes, in ascending order of the value.

    New values are numbered in ranges, so a catalogue of any size is no single task.
    """
    new = found.distinct().join(old, ["feature", "value"], "left_anti")
    last = old.groupBy("feature").agg(F.max("code").alias("_last"))
    numbered = (global_numbers(new, ["feature"], ["value"], "_n").join(last, "feature", "left")
                .select("feature", "value", (F.coalesce("_last", F.lit(-1)) + F.col("_n") + 1).cast("int").alias("code")))
    return old.select("feature", "value", "code").unionByName(numbered)


def grow_vocabulary(old: DataFrame | None, df: DataFrame, features: list[str] = C.CODED_COLUMNS) -> DataFrame:
    """Vocabulary extended by the values of ``df``; existing codes never change."""
    if old is None:
        old = seed_table(df.sparkSession, features, C.VOCABULARY_SEED)
    found = (df.select(*features).unpivot([], features, "feature", "value")
             .where(F.col("value").isNotNull() & ~F.col("value").isin(C.VOCABULARY_EXCLUDED)))
    return _grow(old, found)


def grow_slot_map(old: DataFrame | None, categories: DataFrame, features: list[str] = C.INDICATOR_COLUMNS) -> DataFrame:
    """Slot map extended by ``categories (feature, value)``."""
    if old is None:
        old = seed_table(categories.sparkSession, features, C.SLOT_SEED)
    return _grow(old, categories.select("feature", "value"))


def encode_vocabulary(df: DataFrame, vocabulary: DataFrame, feature: str) -> DataFrame:
    """Code of a value; values outside the vocabulary get 0."""
    codes = vocabulary.where(F.col("feature") == feature).select(
        F.col("value").alias(feature), F.col("code").alias(f"{feature}_code"))
    return df.join(codes, feature, "left").withColumn(
        f"{feature}_code", F.coalesce(f"{feature}_code", F.lit(C.PAD_CODE)))


def oversized(vocabulary: DataFrame, declared: DataFrame) -> DataFrame:
    """Features whose vocabulary outgrew its declared ``voc_size``."""
    return (vocabulary.groupBy("feature").agg(F.count("*").alias("n_values"))
            .join(declared, "feature").where(F.col("n_values") > F.col("voc_size")))
