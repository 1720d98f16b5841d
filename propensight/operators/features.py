"""Event-level features: time gaps, missing values, categories, indicator blocks, the numeric vector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from propensight import constants as C
from propensight.functions.categories import normalize_category as normalized

TS = "event_timestamp"
ID_KEYS = ["data_date", "id"]
TIEBREAK = ["event_id", "visit_timestamp"]


def normalize_timestamp(df: DataFrame, column: str = TS) -> DataFrame:
    """Whole seconds. Text is read from its first 19 characters."""
    if dict(df.dtypes)[column] == "string":
        value = F.to_timestamp(F.substring(column, 1, 19), "yyyy-MM-dd HH:mm:ss")
    else:
        value = F.date_trunc("second", column)
    return df.withColumn(column, value.cast("timestamp_ntz"))


def seconds(col: Column) -> Column:
    return F.unix_timestamp(col.cast("timestamp"))


def delta_time(df: DataFrame, keys: list[str] = ID_KEYS, tiebreak: list[str] = TIEBREAK,
               bucket: str = "hour") -> DataFrame:
    """Seconds since the previous event of the same key, 0 for the first.

    A plain ``lag`` would sort all events of an id in one task. Events are sorted per id and time bucket
    instead; the first event of a bucket takes the last timestamp of the id's previous bucket, found on a
    table with one row per bucket.
    """
    bucketed = df.withColumn("_bucket", F.date_trunc(bucket, TS))
    part = keys + ["_bucket"]
    ends = bucketed.groupBy(*part).agg(F.max(TS).alias("_end"))
    before = ends.select(*part, F.lag("_end").over(W.partitionBy(*keys).orderBy("_bucket")).alias("_before"))
    previous = F.coalesce(F.lag(TS).over(W.partitionBy(*part).orderBy(TS, *tiebreak)), F.col("_before"))
    return (bucketed.join(before, part)
            .withColumn("delta_time", F.coalesce(seconds(F.col(TS)) - seconds(previous), F.lit(0)))
            .drop("_bucket", "_before"))


def event_date(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date(TS))


def fill_missing(df: DataFrame) -> DataFrame:
    """Nulls become 0 (numeric), ``''`` (indicator) or ``'0'`` (coded); rows without an id are dropped."""
    defaults = {c: 0 for c in C.EVENT_NUMERIC + C.VISIT_NUMERIC + C.PRODUCT_NUMERIC}
    defaults |= {c: "" for c in C.INDICATOR_COLUMNS + ["week_day", "month"]}
    defaults |= {c: C.VOCABULARY_SEED[0] for c in C.CODED_COLUMNS}
    return df.where(F.col("id").isNotNull()).fillna({c: v for c, v in defaults.items() if c in df.columns})


def normalize_category(df: DataFrame, columns: list[str] = C.INDICATOR_COLUMNS) -> DataFrame:
    return df.withColumns({c: normalized(F.col(c)) for c in columns})


def distinct_normalized(events: DataFrame, visits: DataFrame, column: str) -> DataFrame:
    """Distinct clean values of an indicator column, taken from the table that has it."""
    source = events if column in events.columns else visits
    raw = source.select(F.lower(F.trim(column)).alias("value")).distinct()
    kept = raw.where(F.col("value").isNotNull() & ~F.col("value").isin(C.MISSING_CATEGORIES))
    return kept.select(normalized(F.col("value")).alias("value")).distinct()


def indicator(value: Column, categories: list) -> Column:
    """0/1 vector over fixed categories; all 0 for any other value."""
    return F.array(*[F.coalesce((value == F.lit(c)).cast("float"), F.lit(0.0).cast("float"))
                     for c in categories])


def one_hot_calendar(df: DataFrame) -> DataFrame:
    return (df.withColumn("week_day_vec", indicator(F.col("week_day"), C.WEEK_DAYS))
            .withColumn("month_vec", indicator(F.col("month").cast("int"), C.MONTHS)))


def with_slot(df: DataFrame, column: str, slots: DataFrame, unknown: str = "error") -> DataFrame:
    """Slot of a clean category. A value without a slot is an error, or slot 0 with ``unknown='slot0'``."""
    named = slots.where(F.col("feature") == column).select(
        F.col("value").alias(column), F.col("code").alias(f"{column}_slot"))
    missing = F.lit(C.SLOT_SEED[1])
    if unknown == "error":
        missing = F.raise_error(F.concat(F.lit(f"no slot in {column} for "), F.col(column))).cast("int")
    joined = df.join(named, column, "left")
    return joined.withColumn(f"{column}_slot", F.coalesce(f"{column}_slot", missing))


def one_hot_fixed(df: DataFrame, column: str, slots: DataFrame, width: int = C.INDICATOR_SLOTS,
                  unknown: str = "error") -> DataFrame:
    """Indicator vector of a fixed width; a slot beyond the width is an error."""
    placed = with_slot(df, column, slots, unknown)
    slot = F.col(f"{column}_slot")
    vector = F.when(slot < width, indicator(slot, list(range(width)))).otherwise(
        F.raise_error(F.concat(F.lit(f"slot of {column} beyond width: "), slot.cast("string"))))
    return placed.withColumn(f"{column}_vec", vector)


def slot_names(slots: DataFrame, column: str, width: int = C.INDICATOR_SLOTS) -> DataFrame:
    """Name of every slot; spare ones are called ``Na_k``."""
    spark = slots.sparkSession
    used = slots.where(F.col("feature") == column).select("value", F.col("code").alias("slot"))
    n_used = used.agg(F.count("*").alias("n"))
    every = spark.range(width).select(F.col("id").cast("int").alias("slot"))
    spare = F.concat(F.lit("Na_"), (F.col("slot") - F.col("n")).cast("string"))
    return (every.join(F.broadcast(n_used), F.lit(True)).join(used, "slot", "left")
            .select("slot", F.concat(F.lit(f"{column}_"), F.coalesce("value", spare)).alias("name")))


def assemble_features(df: DataFrame) -> DataFrame:
    """The numeric vector of an event: calendar, event and device indicators, then numeric columns."""
    numeric = F.array(*[F.col(c).cast("float") for c in C.NUMERIC_COLUMNS])
    return df.withColumn("num", F.concat("week_day_vec", "month_vec", "event_env_vec", "device_vec", numeric))


def feature_spec_size(spec: DataFrame) -> DataFrame:
    """Width of the numeric vector as the sum of the block widths of a feature spec."""
    return spec.select((F.col("n_numeric") + F.col("n_engineered") + F.col("n_week_days") + F.col("n_months")
                        + F.col("n_event_env") + F.col("n_device")).alias("n_input"))


def event_features(extract: DataFrame, vocabulary: DataFrame, slots: DataFrame,
                   unknown: str = "error") -> DataFrame:
    """All event-level features of an extract: ``num`` vector, ``cat`` codes and ``event_date``."""
    from propensight.operators.vocabulary import encode_vocabulary

    df = normalize_category(fill_missing(event_date(delta_time(normalize_timestamp(extract)))))
    df = one_hot_calendar(df)
    for c in C.INDICATOR_COLUMNS:
        df = one_hot_fixed(df, c, slots, unknown=unknown)
    for c in C.CODED_COLUMNS:
        df = encode_vocabulary(df, vocabulary, c)
    df = assemble_features(df).withColumn("cat", F.array(*[F.col(f"{c}_code") for c in C.CODED_COLUMNS]))
    return df.select(*ID_KEYS, TS, *TIEBREAK, "event_date", "event_env", "num", "cat")
