"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Fused code above this size is not compiled to machine code by the JVM; operators then run one by one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on: UTC and adaptive execution with skew handling."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shuffle_width(df: DataFrame) -> int:
    """Number of shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach. A private one is made only in local mode, where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        require_local(spark.sparkContext.master)
        named = tempfile.mkdtemp(prefix="propensight-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def require_local(master: str) -> None:
    """Executors of a cluster do not see the driver's folders."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("name a folder all executors share in spark.checkpoint.dir")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: short lineage that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
