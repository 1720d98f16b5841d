"""Registration of a query together with its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from harness.ctes import with_ctes
from harness.stage import Stage, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Fractional columns to six digits, so that the order of a sum does not show."""
    return df.select(*[F.round(F.col(c).cast("double"), digits).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def query(name: str, sql: str | None = None):
    """Register a function of a ``Stage`` as query ``name``, with ``sql`` over the sub-queries as its twin."""
    def add(fn: Callable[[Stage], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(stage(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return fn
    return add
