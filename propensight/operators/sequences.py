"""Per-id facts, bounded event sequences and their batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from propensight import constants as C
from propensight.config import Params
from propensight.functions import rng
from propensight.operators.features import ID_KEYS, TIEBREAK, TS, seconds
from propensight.operators.numbering import global_numbers


def _label(horizon: int, label_start: str) -> Column:
    start = F.col("data_date").cast("timestamp_ntz")
    ts = F.col(TS)
    after = ts > start if label_start == "cutoff" else ts >= F.date_add("data_date", 1).cast("timestamp_ntz")
    within = ts <= F.date_add("data_date", horizon).cast("timestamp_ntz")
    hit = (F.col("event_env") == C.PURCHASE) & after & within
    return F.coalesce(F.max(F.when(hit, 1).otherwise(0)), F.lit(0)).cast("int").alias("label")


def labels(df: DataFrame, horizon: int = Params.horizon, label_start: str = "cutoff") -> DataFrame:
    """1 for ids that purchase after cutoff midnight (or from the ``next_day``) within the horizon, else 0."""
    return df.groupBy(*ID_KEYS).agg(_label(horizon, label_start))


def label_prevalence(labelled: DataFrame) -> DataFrame:
    return labelled.agg((100 * F.avg("label")).alias("percentage_win"))


def _inactivity() -> Column:
    last = F.max(F.when(F.to_date(TS) <= F.col("data_date"), F.col(TS)))
    end = F.date_add("data_date", 1).cast("timestamp_ntz")
    return ((seconds(end) - seconds(last)) / F.lit(86400.0)).alias("inactivity")


def inactivity(df: DataFrame) -> DataFrame:
    """Days from the last event up to the cutoff day until the end of that day."""
    return df.groupBy(*ID_KEYS).agg(_inactivity()).where(F.col("inactivity").isNotNull())


def inactivity_mean(idle: DataFrame) -> DataFrame:
    return idle.agg(F.avg("inactivity").alias("mean_inactivity"))


def last_k_events(df: DataFrame, k: int = Params.max_len, tiebreak: list[str] = TIEBREAK) -> DataFrame:
    """The last ``k`` events of each id up to the cutoff day.

    The rank limit is applied inside each map task as well, so a hot id sends at most ``k`` rows per task.
    """
    latest = W.partitionBy(*ID_KEYS).orderBy(F.col(TS).desc(), *[F.col(c).desc() for c in tiebreak])
    return (df.where(F.to_date(TS) <= F.col("data_date"))
            .withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= k).drop("_rank"))


def build_sequences(df: DataFrame, k: int = Params.max_len) -> DataFrame:
    """One row per id with its ordered numeric vectors and code vectors; at most ``k`` of each."""
    step = F.struct(TS, *TIEBREAK, "num", "cat")
    grouped = (last_k_events(df, k).groupBy(*ID_KEYS)
               .agg(F.sort_array(F.collect_list(step)).alias("steps")))
    return grouped.select(*ID_KEYS, F.size("steps").alias("seq_length"),
                          F.col("steps.num").alias("inputs_num"), F.col("steps.cat").alias("inputs_cat"))


def sequence_examples(df: DataFrame, k: int = Params.max_len, horizon: int = Params.horizon,
                      label_start: str = "cutoff") -> DataFrame:
    """Sequence, inactivity and label of every id with history, joined by id."""
    facts = df.groupBy(*ID_KEYS).agg(_inactivity(), _label(horizon, label_start))
    return (build_sequences(df, k).join(facts, ID_KEYS)
            .select(*ID_KEYS, "seq_length", "inputs_num", "inputs_cat", "inactivity", "label"))


def step_rows(examples: DataFrame) -> DataFrame:
    """One row per step, with the sequence length and the label as two indicators."""
    return (examples.select("*", F.posexplode(F.arrays_zip("inputs_num", "inputs_cat")).alias("step", "_s"))
            .select(*ID_KEYS, "step", F.col("_s.inputs_num").alias("num"), F.col("_s.inputs_cat").alias("cat"),
                    "seq_length", "inactivity", "label",
                    F.array(*[(F.col("label") == i).cast("int") for i in range(2)]).alias("label_vec")))


def length_bucket(examples: DataFrame, bounds: list[int] = C.LENGTH_BOUNDS) -> DataFrame:
    """Index of the first bound that is at least the length; the last index for longer sequences."""
    length = F.col("seq_length")
    chain = F.when(length <= bounds[0], 0)
    for i, b in enumerate(bounds[1:-1], start=1):
        chain = chain.when(length <= b, i)
    return examples.withColumn("bucket", chain.otherwise(len(bounds) - 1).cast("int"))


def _padded(col: str, missing: Column, pad: Column) -> Column:
    return F.concat(F.col(col), F.array_repeat(pad, missing))


def pad_batches(examples: DataFrame, batch_size: int = Params.batch_size, bounds: list[int] = C.LENGTH_BOUNDS) -> DataFrame:
    """Batches of similar length, each padded to its longest sequence.

    The sequences of a date and bucket are numbered by id over ranges of rows, so a popular bucket is spread over the tasks and all its
    batches but the last are full.
    """
    group = ["data_date", "bucket"]
    narrow = length_bucket(examples, bounds).select(*ID_KEYS, "bucket", "seq_length")
    numbered = global_numbers(narrow, group, ["id"]).withColumn("batch_no", F.floor(F.col("number") / batch_size).cast("int"))
    longest = F.max("seq_length").over(W.partitionBy(*group, "batch_no"))  # at most batch_size rows
    sized = examples.join(numbered.select(*ID_KEYS, "bucket", "batch_no", longest.alias("padded_length")), ID_KEYS)
    missing = F.col("padded_length") - F.col("seq_length")
    pad_num = F.array_repeat(F.lit(C.PAD_NUMERIC).cast("float"), C.N_INPUT)
    pad_cat = F.array_repeat(F.lit(C.PAD_CODE), len(C.CODED_COLUMNS))
    return sized.withColumns({"inputs_num": _padded("inputs_num", missing, pad_num),
                              "inputs_cat": _padded("inputs_cat", missing, pad_cat)})


def shuffle_examples(examples: DataFrame, seed: int = Params.seed) -> DataFrame:
    """Examples in a random order that depends on the seed only, with their place in it."""
    keyed = examples.withColumn("order_key", rng.key(seed, F.col("data_date"), F.col("id")))
    return global_numbers(keyed, [], ["order_key", "id"], "place").orderBy("order_key", "id")
