"""Stored tables: inputs, extracts, sequences, value lists, the feature spec, predictions, explanations.

Dated tables are partitioned by their date. A rewrite replaces only the dates it contains, so a failed or
repeated run leaves the others as they are, and reads of a list of dates prune to those folders. Value lists are kept in
versions: each is a new folder that counts once its commit record is in place.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from propensight import constants as C
from propensight.config import Params
from propensight.operators.extract import category_values, vocabulary_sizes
from propensight.operators.features import distinct_normalized
from propensight.sources import schemas


def scan_source(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One of the four input tables, with its declared schema and naive timestamps read as UTC."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{path}/{name}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder of the shared file system is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def write_dated(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions present in ``df``.

    Rebalancing on the partition columns gives each date few files and splits a date that is too big for one.
    """
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(path))


def read_dated(spark: SparkSession, path: str, dates: list[dt.date] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if dates is None else df.where(F.col("data_date").isin(dates))


def write_extract(df: DataFrame, path: str) -> None:
    write_dated(df, path, ["data_date"])


def read_extract(spark: SparkSession, path: str, dates: list[dt.date] | None = None) -> DataFrame:
    return read_dated(spark, path, dates)


def write_sequences(examples: DataFrame, path: str, purpose: str = "training") -> None:
    """Sequence records. Those for ``training`` and those for ``prediction`` are kept apart."""
    write_dated(examples.withColumn("purpose", F.lit(purpose)), path, ["purpose", "data_date"])


def read_sequences(spark: SparkSession, path: str, dates: list[dt.date] | None = None,
                   purpose: str = "training") -> DataFrame:
    df = read_dated(spark, path, dates).where(F.col("purpose") == purpose)
    return df.select(*schemas.SEQUENCES.names)


def written_dates(spark: SparkSession, path: str, purpose: str | None = None) -> DataFrame:
    """Dates that have data, from the partition columns."""
    df = spark.read.parquet(path)
    if purpose:
        df = df.where(F.col("purpose") == purpose)
    return df.select("data_date").distinct()


COMMITS = "_commits"

# Blanks, quotes, tabs and line breaks come back as they were.
EXACT_TEXT = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a value list whose commit record is there, oldest first."""
    root, fs = _file_system(spark, f"{path}/{COMMITS}")
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n) for n in names if n.isdigit())


def newest_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest committed version."""
    versions = committed_versions(spark, path)
    if not versions:
        return None
    record, fs = _file_system(spark, f"{path}/{COMMITS}/{versions[-1]:08d}")
    with_lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(record), "UTF-8"))
    try:
        return f"{path}/{with_lines.readLine()}"
    finally:
        with_lines.close()


def _commit(spark: SparkSession, path: str, version: int, folder: str) -> None:
    """Put the record of a version in place by a rename; a version that another writer has committed meanwhile is an error."""
    record, fs = _file_system(spark, f"{path}/{COMMITS}/{version:08d}")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{COMMITS}/_{folder}")
    out = fs.create(draft, True)
    out.write(bytearray(folder.encode()))
    out.close()
    if fs.exists(record) or not fs.rename(draft, record):
        fs.delete(draft, False)
        raise RuntimeError(f"version {version} of {path} was written by another job")


def _write_version(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write to a new folder, then commit. Whatever stops in between, readers keep the version before."""
    version = (committed_versions(spark, path) or [0])[-1] + 1
    root, fs = _file_system(spark, f"{path}/{COMMITS}")
    fs.mkdirs(root)
    folder = f"version-{version:08d}-{uuid.uuid4().hex[:12]}"
    write(f"{path}/{folder}")
    _commit(spark, path, version, folder)


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    """A new version: tab-separated text with a header, one folder per feature."""
    value, code = C.VOCABULARY_FILE_COLUMNS

    def write(folder: str) -> None:
        (vocabulary.select("feature", F.col("value").alias(value), F.col("code").alias(code))
         .hint("rebalance", "feature").write.mode("errorifexists").partitionBy("feature")
         .options(**EXACT_TEXT).option("encoding", "UTF-8").option("emptyValue", "").option("quoteAll", True)
         .csv(folder))

    _write_version(vocabulary.sparkSession, path, write)


def _newest(spark: SparkSession, path: str) -> str:
    folder = newest_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no committed version in {path}")
    return folder


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version."""
    value, code = C.VOCABULARY_FILE_COLUMNS
    df = (spark.read.options(**EXACT_TEXT).option("multiLine", True)
          .schema(f"{value} string, {code} int, feature string").csv(_newest(spark, path)))
    return df.select("feature", F.col(value).alias("value"), F.col(code).alias("code"))


def write_slot_map(slots: DataFrame, path: str) -> None:
    """A new version: one folder of JSON lines per feature."""
    _write_version(slots.sparkSession, path, lambda folder: slots.hint("rebalance", "feature").write.mode("errorifexists")
                   .partitionBy("feature").json(folder))


def read_slot_map(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version."""
    df = spark.read.schema("value string, code int, feature string").json(_newest(spark, path))
    return df.select("feature", "value", "code")


def feature_spec(events: DataFrame, visits: DataFrame, products: DataFrame) -> DataFrame:
    """One row: block widths, value lists, vocabulary sizes and first day of the data.

    The value lists are distinct values, bounded by the catalogue and the slots, not by the events.
    """
    sizes = vocabulary_sizes(products).groupBy().pivot("feature", C.CODED_COLUMNS).agg(F.first("voc_size"))
    sizes = sizes.select(*[F.col(c).alias(f"voc_{c}") for c in C.CODED_COLUMNS])
    first = events.agg(F.to_date(F.min("event_timestamp")).alias("min_date"))
    spec = first.select(
        F.lit(len(C.EVENT_NUMERIC + C.VISIT_NUMERIC + C.PRODUCT_NUMERIC)).alias("n_numeric"),
        F.lit(len(C.ENGINEERED)).alias("n_engineered"),
        F.lit(len(C.WEEK_DAYS)).alias("n_week_days"), F.lit(len(C.MONTHS)).alias("n_months"),
        *[F.lit(C.INDICATOR_SLOTS).alias(f"n_{c}") for c in C.INDICATOR_COLUMNS], "min_date")
    parts = [sizes]
    parts += [distinct_normalized(events, visits, c).agg(F.sort_array(F.collect_list("value")).alias(f"values_{c}"))
              for c in C.INDICATOR_COLUMNS]
    parts += [category_values(products, c).agg(F.sort_array(F.collect_list("value")).alias(f"values_{c}"))
              for c in C.CODED_COLUMNS]
    for one_row in parts:  # each side is a global aggregate, so exactly one row
        spec = spec.join(F.broadcast(one_row), F.lit(True))
    return spec


def freeze_feature_spec(events: DataFrame, visits: DataFrame, products: DataFrame, path: str) -> DataFrame:
    """The stored spec; computed and written once if there is none."""
    spark = events.sparkSession
    if not path_exists(spark, path):
        feature_spec(events, visits, products).write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def write_predictions(scored: DataFrame, path: str, execution_date: dt.date) -> None:
    """Predictions of one execution date, replacing earlier ones of the same date."""
    typed = scored.select(*[F.col(f.name).cast(f.dataType) for f in schemas.PREDICTIONS.fields],
                          F.lit(execution_date).alias("execution_date"))
    write_dated(typed, path, ["execution_date"])


def read_predictions(spark: SparkSession, path: str, execution_date: dt.date) -> DataFrame:
    df = spark.read.parquet(path).where(F.col("execution_date") == F.lit(execution_date))
    return df.select(*schemas.PREDICTIONS.names)


def write_explanations(explained: DataFrame, path: str) -> None:
    """Explanations, perturbed samples or Shapley values, per date and parameter set."""
    by = ["data_date"] + (["kernel_width"] if "kernel_width" in explained.columns else [])
    write_dated(explained, path, by)


def purge_old(df: DataFrame, execution_date: dt.date, days: int = Params.retention) -> DataFrame:
    """Rows that stay when dates older than ``days`` before the execution date go."""
    return df.where(F.col("data_date") >= F.lit(execution_date - dt.timedelta(days=days)))


def drop_old_dates(spark: SparkSession, path: str, execution_date: dt.date, days: int = Params.retention) -> list[str]:
    """Delete the date folders that ``purge_old`` would not keep; returns their names."""
    oldest = (execution_date - dt.timedelta(days=days)).isoformat()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    dropped = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("data_date=") and name.split("=", 1)[1] < oldest:
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)
