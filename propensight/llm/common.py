"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from propensight.session import configure

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Rows handed to a Python worker at once; long texts make larger rows, so this is kept far below Spark's default.
BATCH_ROWS = 500
BATCH_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive execution with skew handling, and Arrow batches that stay small when texts are long."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def discard(df: DataFrame) -> None:
    """Remove a table that `materialize` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def utf8(text: Column) -> Column:
    """The bytes of a text, none for null."""
    return F.coalesce(text, F.lit("")).cast("binary")


def shielded(df: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``df`` with all columns but ``used`` under neutral names, so that no name of theirs meets one of the operator's, and a
    function that gives a result its columns back, in their order, followed by the named ones."""
    names = df.columns
    neutral = [n if n in used else f"other_{i}_column" for i, n in enumerate(names)]

    def restored(out: DataFrame, *added: str) -> DataFrame:
        return out.select(*[F.col(c).alias(n) for c, n in zip(neutral, names, strict=True)], *added)

    return df.toDF(*neutral), restored
