"""Training statistics of the explainer space.

Everything is taken per step on wide rows: one aggregation with partial sums gives at most one row per step,
which is then turned into one row per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from propensight import constants as C
from propensight.operators.space import kind, to_long

FIXED_STEP = -1


def _stats(grouped, features: list[str], step) -> DataFrame:
    wide = grouped.agg(*[F.struct(F.count(f).alias("n"), F.avg(f).alias("mean"), F.stddev_pop(f).alias("std"),
                                  F.min(f).alias("min"), F.max(f).alias("max")).alias(f) for f in features])
    if step is not None:
        wide = wide.withColumn("step", step)
    return (wide.unpivot("step", features, "feature", "s")
            .select("step", "feature", kind(F.col("feature")).alias("kind"), "s.*"))


def column_stats(space: DataFrame) -> DataFrame:
    """Count, mean, population deviation, smallest and largest value of every flat column, padding excluded.

    The fixed feature is one column of the flat layout and stands under step -1.
    """
    real = space.where(~F.col("is_pad"))
    fixed = _stats(real.where(F.col("step") == 0).groupBy(), C.SPACE_FIXED, F.lit(FIXED_STEP))
    return _stats(real.groupBy("step"), C.SPACE_STEP, None).unionByName(fixed)


def column_stats_per_step(space: DataFrame) -> DataFrame:
    """The same per step and feature, the fixed feature repeated at every step."""
    return _stats(space.where(~F.col("is_pad")).groupBy("step"), C.SPACE_ALL, None)


def value_frequencies(space: DataFrame) -> DataFrame:
    """Values of every categorical column with counts and shares, value 0 removed.

    ``c_lo`` and ``c_hi`` are running counts, so a draw is a comparison of integers.
    """
    cells = to_long(space.where(~F.col("is_pad")), C.SPACE_CATEGORICAL).where(F.col("value") != 0)
    return with_running_counts(cells.groupBy("step", "feature", "value").agg(F.count("*").alias("cnt")))


def with_running_counts(counts: DataFrame) -> DataFrame:
    """Counts of values with their running sums, totals and shares per column."""
    column = W.partitionBy("step", "feature")
    running = F.sum("cnt").over(column.orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    total = F.sum("cnt").over(column)
    return counts.select("step", "feature", "value", "cnt", (running - F.col("cnt")).alias("c_lo"),
                         running.alias("c_hi"), total.alias("total"), (F.col("cnt") / total).alias("share"))


# ---- the same from partial states stored per day

def daily_moments(space: DataFrame) -> DataFrame:
    """Partial states of the columns of each day: count, mean, sum of squared deviations, smallest and largest value."""
    real = space.where(~F.col("is_pad"))
    parts = []
    for rows, by, features in ((real, ["data_date", "step"], C.SPACE_STEP), (real.where(F.col("step") == 0), ["data_date"], C.SPACE_FIXED)):
        wide = rows.groupBy(*by).agg(*[F.struct(
            F.count(f).alias("n"), F.avg(f).alias("mean"), (F.var_pop(f) * F.count(f)).alias("squares"), F.min(f).alias("min"),
            F.max(f).alias("max")).alias(f) for f in features])
        wide = wide if "step" in by else wide.withColumn("step", F.lit(FIXED_STEP))
        parts.append(wide.unpivot(["data_date", "step"], features, "feature", "s").select("data_date", "step", "feature", "s.*"))
    return parts[0].unionByName(parts[1])


def merged_moments(states: DataFrame) -> DataFrame:
    """The rows of `column_stats` from the states of any days. Squared deviations are taken from the mean of all days, so nothing cancels."""
    n, total = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    whole = states.groupBy("step", "feature").agg(n.alias("_n"), (total / n).alias("_mean"))
    apart = F.col("squares") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), F.lit(2.0))
    return states.join(whole, ["step", "feature"]).groupBy("step", "feature").agg(
        n.alias("n"), F.first("_mean").alias("mean"), F.sqrt(F.sum(apart) / n).alias("std"), F.min("min").alias("min"), F.max("max").alias("max")).select(
        "step", "feature", kind(F.col("feature")).alias("kind"), "n", "mean", "std", "min", "max")


def daily_value_counts(space: DataFrame) -> DataFrame:
    """Counts of the values of every categorical column per day, value 0 removed."""
    cells = to_long(space.where(~F.col("is_pad")), C.SPACE_CATEGORICAL).where(F.col("value") != 0)
    return cells.groupBy("data_date", "step", "feature", "value").agg(F.count("*").alias("cnt"))


def merged_frequencies(counts: DataFrame) -> DataFrame:
    """The rows of `value_frequencies` from the counts of any days."""
    return with_running_counts(counts.groupBy("step", "feature", "value").agg(F.sum("cnt").alias("cnt")))


def categorical_unit_scale(stats: DataFrame) -> DataFrame:
    """Mean 0 and scale 1 for categorical columns; a constant numeric column gets scale 1."""
    cat = F.col("kind") == "cat"
    return (stats.withColumn("mean", F.when(cat, 0.0).otherwise(F.col("mean")))
            .withColumn("std", F.when(cat | (F.col("std") == 0), 1.0).otherwise(F.col("std"))))


def product_hierarchy(space: DataFrame) -> DataFrame:
    """Department, category and the sorted set of sub-categories seen together."""
    dept, cat, sub = C.CODED_COLUMNS
    seen = space.where(~F.col("is_pad")).select(*[F.col(c).cast("int").alias(a) for c, a in
                                                  ((dept, "dept"), (cat, "cat"), (sub, "subcat"))]).distinct()
    return seen.groupBy("dept", "cat").agg(F.sort_array(F.collect_set("subcat")).alias("subcats"))
