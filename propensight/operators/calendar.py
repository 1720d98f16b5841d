"""Date planning on small tables: which days have data, which cutoffs to process, which to train on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window as W, functions as F

from propensight import constants as C
from propensight.config import Params


def _dates(available: DataFrame) -> DataFrame:
    return available.select(F.to_date("table_date", C.DATE_FORMAT).alias("day"))


def _one_row_per_day(df: DataFrame, first, last) -> DataFrame:
    """Days from ``first`` to ``last`` of a one-row table; no row where the range is empty."""
    return df.where(first <= last).select(F.explode(F.sequence(first, last)).alias("data_date"))


def effective_execution_date(available: DataFrame, execution_date: dt.date) -> DataFrame:
    """The execution date, moved back to the last day with data if that is yesterday; no row if data is older."""
    wanted = F.lit(execution_date)
    span = _dates(available).agg(F.min("day").alias("min_date"), F.max("day").alias("max_date"))
    return (span.where(wanted <= F.date_add("max_date", 1))
            .select("min_date", "max_date", F.least(wanted, F.col("max_date")).alias("execution_date")))


def missing_days(available: DataFrame, execution_date: dt.date, history: int = Params.training_history,
                 max_missing: float = Params.max_missing) -> DataFrame:
    """Days of the training history without data, and whether they are too many to go on."""
    effective = effective_execution_date(available, execution_date)
    days = _one_row_per_day(effective, F.date_sub("execution_date", history - 1), F.col("execution_date"))
    gone = days.join(_dates(available).withColumnRenamed("day", "data_date"), "data_date", "left_anti")
    total = F.count("*").over(W.partitionBy(F.lit(0)))
    return gone.select("data_date", total.alias("n_missing"), (total > int(max_missing * history)).alias("abort"))


def _first_training_date(history: int, horizon: int):
    return F.greatest(F.date_add("min_date", horizon),
                      F.date_add(F.date_sub("execution_date", history), horizon))


def training_calendar(available: DataFrame, execution_date: dt.date, action: str = "train",
                      history: int = Params.training_history, horizon: int = Params.horizon,
                      last_only: bool = False) -> DataFrame:
    """Cutoff dates of an action: all training days, the execution date, or the last day with full labels.

    There is no row when the data does not yet hold one training day.
    """
    effective = effective_execution_date(available, execution_date)
    first = _first_training_date(history, horizon)
    last = F.date_sub("execution_date", horizon)
    enough = effective.withColumns({"first": first, "last": last}).where(F.col("first") <= F.col("last"))
    if action == "train":
        start = F.col("last") if last_only else F.col("first")
        return _one_row_per_day(enough, start, F.col("last"))
    return enough.select(F.col("execution_date" if action == "predict" else "last").alias("data_date"))


def dates_to_process(calendar: DataFrame, sequences: DataFrame, extracts: DataFrame) -> DataFrame:
    """Dates without finished sequences, and whether they also lack an extract."""
    todo = calendar.join(sequences, "data_date", "left_anti")
    have = extracts.select("data_date").distinct().withColumn("_have", F.lit(True))
    return todo.join(have, "data_date", "left").select("data_date", F.col("_have").isNull().alias("needs_extract"))


def _first_share(calendar: DataFrame, share: float) -> DataFrame:
    order = W.partitionBy(F.lit(0)).orderBy("data_date")
    total = F.count("*").over(W.partitionBy(F.lit(0)))
    return calendar.withColumn("is_first", F.row_number().over(order) <= F.floor(total * F.lit(share)))


def split_by_date(calendar: DataFrame, share: float = Params.train_share) -> DataFrame:
    """The first share of the days trains, the remainder evaluates."""
    return _first_share(calendar, share).select(
        "data_date", F.when(F.col("is_first"), "train").otherwise("evaluate").alias("part"))


def evaluation_dates(available: DataFrame, execution_date: dt.date, horizon: int = Params.horizon) -> DataFrame:
    """The ``horizon`` most recent cutoffs whose labels are complete at the execution date."""
    effective = effective_execution_date(available, execution_date)
    return _one_row_per_day(effective, F.date_sub("execution_date", 2 * horizon - 1),
                            F.date_sub("execution_date", horizon))


def explainer_calendar(available: DataFrame, execution_date: dt.date, share: float = Params.train_share,
                       history: int = Params.training_history, horizon: int = Params.horizon) -> DataFrame:
    """Days the explainer statistics are taken from: the first share of the days since the data began."""
    span = effective_execution_date(available, execution_date)
    n = F.date_diff("execution_date", F.date_add("min_date", horizon - 1))
    first = _first_training_date(history, horizon)
    kept = F.floor(n * F.lit(share)).cast("int")
    counted = span.withColumns({"first": first, "kept": kept}).where(F.col("kept") > 0)
    return _one_row_per_day(counted, F.col("first"), F.expr("date_add(first, kept - 1)"))


def needs_retrain(runs: DataFrame, execution_date: dt.date, max_age: int) -> DataFrame:
    """Whether no model run is recorded, or the newest is older than ``max_age`` days."""
    stamp = F.regexp_extract("name", "([0-9]{8})", 1)
    latest = F.max(F.when(stamp != "", F.to_date(stamp, C.DATE_FORMAT)))
    found = runs.agg(latest.alias("latest_run"))
    age = F.date_diff(F.lit(execution_date), F.col("latest_run"))
    return found.select("latest_run", (F.col("latest_run").isNull() | (age > max_age)).alias("retrain"))
