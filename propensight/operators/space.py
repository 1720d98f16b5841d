"""Explainer space: 17 readable features per step and one per sequence.

Rows are ``(data_date, id, step)`` with one column per feature, which keeps a step on one row instead of 17;
``to_long`` gives one row per cell. Padded steps are marked by ``is_pad`` rather than by a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from propensight import constants as C
from propensight.operators.sequences import ID_KEYS
from propensight.operators.vocabulary import constant_table

QTY = "product_qty"


def max_sequence_length(examples: DataFrame) -> DataFrame:
    return examples.agg(F.max("seq_length").alias("max_length"))


def pad_steps(examples: DataFrame, length: int) -> DataFrame:
    """One row per step up to ``length``; missing steps hold -1 and code 0 and are marked."""
    missing = F.greatest(F.lit(length) - F.col("seq_length"), F.lit(0))
    num = F.concat("inputs_num", F.array_repeat(F.array_repeat(F.lit(C.PAD_NUMERIC).cast("float"), C.N_INPUT), missing))
    cat = F.concat("inputs_cat", F.array_repeat(F.array_repeat(F.lit(C.PAD_CODE), len(C.CODED_COLUMNS)), missing))
    return (examples.select(*ID_KEYS, "seq_length", "inactivity", "label",
                            F.posexplode(F.arrays_zip(num.alias("num"), cat.alias("cat"))).alias("step", "_s"))
            .select(*ID_KEYS, "step", (F.col("step") >= F.col("seq_length")).alias("is_pad"), "seq_length",
                    "inactivity", "label", "_s.num", "_s.cat"))


def _position(block: str) -> Column:
    offset, width = C.INDICATOR_BLOCKS[block]
    return F.array_position(F.slice("num", offset + 1, width), F.lit(1.0).cast("float")).cast("double")


def _number(column: str) -> Column:
    return F.get("num", F.lit(C.NUMERIC_POSITION[column])).cast("double")


def to_explainer_space(steps: DataFrame) -> DataFrame:
    """Readable features of step rows ``(num, cat)``.

    Indicator blocks become the index of their 1, counted from 1; counts are moved up by one so that 0 is free
    for padding, and negative quantities down by two.
    """
    if "is_pad" not in steps.columns:
        steps = steps.withColumn("is_pad", F.lit(False))
    pad = F.col("is_pad")
    cols = {c: F.when(pad, F.lit(C.PAD_NUMERIC)).otherwise(_number(c)) for c in C.SPACE_NUMERIC}
    cols |= {c: _position(c) for c in C.SPACE_INDICATOR}
    for c in C.SPACE_SHIFTED:
        value = _number(c)
        moved = F.when(value < 0, value - 2).otherwise(value + 1) if c == QTY else value + 1
        cols[c] = F.when(pad, F.lit(0.0)).otherwise(moved)
    cols |= {c: F.get("cat", F.lit(i)).cast("double") for i, c in enumerate(C.CODED_COLUMNS)}
    return steps.select(*ID_KEYS, "step", "is_pad", "seq_length", *[cols[c].alias(c) for c in C.SPACE_STEP],
                        F.col("inactivity").cast("float").cast("double").alias("inactivity"), "label")


def kind(feature: Column) -> Column:
    return (F.when(feature.isin(C.SPACE_NUMERIC), "num").when(feature.isin(C.SPACE_FIXED), "fixed").otherwise("cat"))


def to_long(space: DataFrame, features: list[str] = C.SPACE_STEP) -> DataFrame:
    """One row per cell."""
    return (space.unpivot([*ID_KEYS, "step", "is_pad"], features, "feature", "value")
            .withColumn("kind", kind(F.col("feature"))))


def flatten_steps(space: DataFrame) -> DataFrame:
    """Cells under their flat names ``feature_t<step>``, with the position of the column in the flat layout."""
    long = to_long(space)
    n_num, n_cat = len(C.SPACE_NUMERIC), len(C.SPACE_CATEGORICAL)
    place = F.array_position(F.array(*[F.lit(c) for c in C.SPACE_STEP]), F.col("feature")).cast("int") - 1
    length = F.lit(0) + F.col("_length")
    position = F.when(F.col("kind") == "num", F.col("step") * n_num + place).otherwise(
        length * n_num + F.col("step") * n_cat + place - n_num)
    longest = space.agg((F.max("step") + 1).alias("_length"))
    cells = long.join(F.broadcast(longest), F.lit(True)).select(
        *ID_KEYS, F.concat("feature", F.lit("_t"), F.col("step").cast("string")).alias("name"),
        position.cast("int").alias("position"), "value")
    fixed = (space.where(F.col("step") == 0).join(F.broadcast(longest), F.lit(True)).select(
        *ID_KEYS, F.lit("inactivity_time").alias("name"),
        (F.col("_length") * (n_num + n_cat)).cast("int").alias("position"), F.col("inactivity").alias("value")))
    return cells.unionByName(fixed)


def flat_names(length: int) -> list[str]:
    """Flat column names in order: numeric of every step, categorical of every step, fixed."""
    blocks = [C.SPACE_NUMERIC, C.SPACE_CATEGORICAL]
    return [f"{c}_t{t}" for block in blocks for t in range(length) for c in block] + ["inactivity_time"]


def flatten_wide(space: DataFrame, length: int) -> DataFrame:
    """One row per sequence with all flat columns; an output format only.

    The steps of a sequence are put side by side as they are: no row is made per cell, and a task holds one sequence at a time.
    """
    known = F.when(F.col("step") < length, True).otherwise(F.raise_error(F.lit("a step beyond the length of the flat form")).cast("boolean"))
    at = lambda t, columns: F.first(F.when(F.col("step") == t, F.struct(*columns)), ignorenulls=True)
    steps = [at(t, C.SPACE_STEP).alias(f"_{t}") for t in range(length)]
    wide = space.where(known).groupBy(*ID_KEYS).agg(*steps, at(0, C.SPACE_FIXED).alias("_fixed"))
    cells = [F.col(f"_{t}.{c}").alias(f"{c}_t{t}") for block in (C.SPACE_NUMERIC, C.SPACE_CATEGORICAL) for t in range(length) for c in block]
    return wide.select(*ID_KEYS, *cells, F.col(f"_fixed.{C.SPACE_FIXED[0]}").alias("inactivity_time"))


def flatten_per_step(space: DataFrame) -> DataFrame:
    """The 18 columns of a step, the fixed value repeated."""
    return space.select(*ID_KEYS, "step", *C.SPACE_ALL)


def _label_table(spark, vocabulary: DataFrame, slots: DataFrame) -> DataFrame:
    fixed = {"week_day": C.WEEK_DAYS, "month": C.MONTH_NAMES}
    rows = [(f, 0, "PAD") for f in (*fixed, *C.INDICATOR_COLUMNS)]
    rows += [(f, i + 1, n) for f, names in fixed.items() for i, n in enumerate(names)]
    table = constant_table(spark, rows, ["feature", "code", "text"])
    none = F.concat(F.lit("None_"), F.col("feature"))
    table = table.unionByName(slots.select("feature", (F.col("code") + 1).alias("code"), F.when(
        F.col("value") == C.SLOT_SEED[0], none).otherwise(F.col("value")).alias("text")))
    return table.unionByName(vocabulary.select("feature", "code", F.col("value").alias("text")))


def category_labels(space: DataFrame, vocabulary: DataFrame, slots: DataFrame) -> DataFrame:
    """Readable value and display name of every named category cell.

    Event and device names come from the slot map.
    """
    named = to_long(space, C.SPACE_INDICATOR + C.CODED_COLUMNS)
    table = _label_table(space.sparkSession, vocabulary, slots)
    text = F.coalesce("text", F.col("code").cast("string"))
    return (named.withColumn("code", F.col("value").cast("int")).join(table, ["feature", "code"], "left")
            .select(*ID_KEYS, "step", "feature", "code", text.alias("text"),
                    F.concat_ws("=", "feature", text).alias("display_name")))


def _inverse(column: str) -> Column:
    value = F.col(column)
    if column in C.POSITIVE + C.SPACE_FIXED:
        return F.abs(value)
    if column == QTY:
        return F.when(value < 0, value + 2).otherwise(value - 1)
    if column in C.SPACE_INDICATOR + C.SPACE_SHIFTED:
        return value - 1
    return value


def model_inputs(space: DataFrame, number: str = "float") -> DataFrame:
    """Step rows as the classifier reads them: ``num`` vector, ``cat`` codes and inactivity."""
    pieces = []
    for block in C.SPACE_INDICATOR:
        index = _inverse(block)
        pieces += [(index == i).cast("double") for i in range(C.INDICATOR_BLOCKS[block][1])]
    pieces += [_inverse(c) for c in C.NUMERIC_COLUMNS]
    pad = F.coalesce(F.col("is_pad"), F.lit(False)) if "is_pad" in space.columns else F.lit(False)
    num = F.when(pad, F.array_repeat(F.lit(C.PAD_NUMERIC), C.N_INPUT)).otherwise(F.array(*pieces)).cast(f"array<{number}>")
    return space.withColumns({"num": num, "cat": F.array(*[F.col(c).cast("int") for c in C.CODED_COLUMNS]),
                              "inactivity": _inverse("inactivity")})


def from_explainer_space(space: DataFrame, keys: list[str] = ID_KEYS) -> DataFrame:
    """Sequence records of explainer rows: the inverse of ``to_explainer_space``. Padded steps are left out."""
    rows = model_inputs(space)
    if "is_pad" in space.columns:
        rows = rows.where(~F.col("is_pad"))
    return (rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("step", "num", "cat"))).alias("_s"),
                                    F.first("inactivity").alias("inactivity"))
            .select(*keys, F.size("_s").alias("seq_length"), F.col("_s.num").alias("inputs_num"),
                    F.col("_s.cat").alias("inputs_cat"), "inactivity"))


def roundtrip_mismatches(steps: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """Cells of each model input that change on the way to explainer space and back."""
    there = steps.select(*ID_KEYS, "step", F.col("num").alias("num0"), F.col("cat").alias("cat0"),
                         "num", "cat", "seq_length", "inactivity", "label")
    space = to_explainer_space(there.drop("num0", "cat0"))
    both = (model_inputs(space).select(*ID_KEYS, "step", F.col("num").alias("num1"), F.col("cat").alias("cat1"))
            .join(there, [*ID_KEYS, "step"]))
    names = [f"{b}_{i}" for b, (_, n) in C.INDICATOR_BLOCKS.items() for i in range(n)] + C.NUMERIC_COLUMNS
    differ = {n: F.count_if(F.abs(F.get("num0", F.lit(i)) - F.get("num1", F.lit(i))) > tolerance)
              for i, n in enumerate(names)}
    differ |= {c: F.count_if(F.get("cat0", F.lit(i)) != F.get("cat1", F.lit(i)))
               for i, c in enumerate(C.CODED_COLUMNS)}
    return (both.agg(*[e.alias(n) for n, e in differ.items()])
            .unpivot([], list(differ), "feature", "mismatches"))
