"""Consecutive numbers over a whole table, without bringing a group to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from propensight.session import materialize, shuffle_width


def global_numbers(df: DataFrame, by: list[str], order: list[str], name: str = "number") -> DataFrame:
    """``df`` with the place of each row, from 0, within ``by`` in ascending ``order``.

    Rows are cut into ranges, sorted there and written with their place in the range; a place in the group is that place plus what
    earlier ranges hold of the group. A group may span any number of ranges; only one row per range and group is summed up in order.
    """
    keys = [*by, *order]
    ranged = df.repartitionByRange(shuffle_width(df), *keys).sortWithinPartitions(*keys)
    placed = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges").withColumn("_range", F.shiftright("_at", 33))
    held = placed.groupBy("_range", *by).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    earlier = F.sum("_n").over(W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    own = [f"_by_{i}" for i in range(len(by))]
    start = held.select(F.col("_range").alias("_of"), *[F.col(c).alias(o) for c, o in zip(by, own, strict=True)],
                        (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift"))
    same = [F.col("_range") == F.col("_of"), *[F.col(c).eqNullSafe(F.col(o)) for c, o in zip(by, own, strict=True)]]
    return placed.join(start, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))
