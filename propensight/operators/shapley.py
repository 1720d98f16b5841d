"""Shapley values of every step of a sequence, over groups of readable features."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from propensight import constants as C
from propensight.config import Params
from propensight.functions.prefix import PrefixScorer, prefix_scorer
from propensight.functions.scoring import MeanPoolScorer, logit, sigmoid
from propensight.operators.sequences import ID_KEYS
from propensight.operators.space import model_inputs
from propensight.session import shuffle_width

STEP_KEYS = ID_KEYS + ["step"]
CELLS = 1 << 22  # cells of masked steps made at once

# Feature groups small enough in number for exact enumeration: 2^7 coalitions.
GROUPS = {
    "calendar": ["week_day", "month"],
    "event": ["event_env", "product_qty", "product_price"],
    "device": ["device"],
    "geo_loc": ["latitude", "longitude"],
    "visit": ["duration", "nb_pages", "unique_pages"],
    "product": ["product_rating", "product_nb_of_ratings", *C.CODED_COLUMNS],
    "time": ["delta_time", "inactivity"],
}
SINGLE = {f: [f] for f in C.SPACE_ALL}


def shapley_kernel(m: int, size: int) -> float:
    """Weight of a coalition of ``size`` out of ``m`` in the least-squares form; infinite at both ends."""
    if size in (0, m):
        return math.inf
    return (m - 1) / (math.comb(m, size) * size * (m - size))


def coalitions(rows: DataFrame, m: int) -> DataFrame:
    """Every coalition of ``m`` groups for every row, as a bit mask with its size and kernel weight."""
    weights = F.array(*[F.lit(shapley_kernel(m, s) if 0 < s < m else None).cast("double") for s in range(m + 1)])
    return (rows.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(2 ** m - 1))))
            .withColumn("size", F.bit_count("coalition"))
            .withColumn("kernel_weight", F.get(weights, F.col("size"))))


def unranked(rank: int, m: int, size: int) -> int:
    """The ``rank``-th of the bit masks with ``size`` of ``m`` bits, in ascending order."""
    mask = 0
    for bit in reversed(range(m)):
        if not size:
            break
        without = math.comb(bit, size)
        if rank >= without:
            rank -= without
            mask |= 1 << bit
            size -= 1
    return mask


def largest_remainder(weights: list[float], total: int, most: list[int]) -> list[int]:
    """``total`` units in proportion to the weights, at most ``most`` each; what does not fit goes to the others."""
    got = [0] * len(weights)
    total = min(total, sum(most))
    while total:
        open_ = [i for i in range(len(weights)) if got[i] < most[i]]
        all_ = sum(weights[i] for i in open_)
        wish = {i: total * weights[i] / all_ for i in open_}
        add = {i: min(int(wish[i]), most[i] - got[i]) for i in open_}
        if not any(add.values()):  # less than one each: by the largest remainders
            for i in sorted(open_, key=lambda i: (-wish[i], i))[:total]:
                got[i] += 1
            break
        for i in open_:
            got[i] += add[i]
        total -= sum(add.values())
    return got


def coalition_plan(m: int, budget: int, seed: int = Params.seed) -> list[tuple[int, int, float]]:
    """``budget`` coalitions of ``m`` groups with weights that sum to 1: (mask, size, weight).

    Sizes are taken from both ends inwards as long as all coalitions of a size fit. The rest of the budget goes to the sizes left in
    proportion to their kernel weight, by largest remainder, as pairs of a coalition and its complement, which makes games of pairs of groups
    exact; ranks are drawn without
    repetition and unranked, so nothing is listed that is not used.
    """
    budget = min(budget, 2 ** m - 2)
    weight = {s: shapley_kernel(m, s) * math.comb(m, s) for s in range(1, m)}
    total, out, left = sum(weight.values()), [], budget
    full = 2 ** m - 1
    sizes = list(range(1, m // 2 + 1))
    pairs = lambda s: math.comb(m - 1, s - 1) if 2 * s == m else math.comb(m, s)
    both = lambda s: weight[s] if 2 * s == m else weight[s] + weight[m - s]
    while sizes and 2 * pairs(sizes[0]) <= left:
        s = sizes.pop(0)
        left -= 2 * pairs(s)
        for size in {s, m - s}:
            out += [(unranked(r, m, size), size, weight[size] / total / math.comb(m, size)) for r in range(math.comb(m, size))]
    if not sizes or not left:
        scale = sum(w for _, _, w in out)
        return [(mask, size, w / scale) for mask, size, w in out]
    rest, draw = sum(both(s) for s in sizes) / total, random.Random(f"{seed}|{m}|{budget}")
    most = [pairs(s) for s in sizes]
    quota = largest_remainder([both(s) for s in sizes], left // 2, most)
    # Of an odd budget one coalition stays without its complement.
    alone = next(i for i, n in enumerate(quota) if n < most[i]) if left % 2 else -1
    drawn = []
    for i, (s, n) in enumerate(zip(sizes, quota, strict=True)):
        number = 2 * n + (i == alone)
        for j, rank in enumerate(draw.sample(range(most[i]), n + (i == alone))):
            # Of size m / 2 a coalition and its complement have one size: the one without the last group stands for both.
            mask = unranked(rank, m - 1 if 2 * s == m else m, s)
            drawn += [(mask, s, both(s) / number), (full ^ mask, m - s, both(s) / number)][:1 if j == n else 2]
    scale = rest / sum(w for _, _, w in drawn)
    return out + [(mask, size, w * scale) for mask, size, w in drawn]


def sampled_coalitions(spark, m: int, budget: int, seed: int = Params.seed) -> DataFrame:
    """The planned coalitions as a table of at most ``budget`` rows."""
    return spark.createDataFrame(coalition_plan(m, budget, seed), "coalition bigint, size int, kernel_weight double")


def _present(groups: dict[str, list[str]], feature: str) -> Column:
    bit = next(i for i, fs in enumerate(groups.values()) if feature in fs)
    return F.shiftright("coalition", bit).bitwiseAND(F.lit(1)) == 1


def spread_steps(space: DataFrame, keep: list[str]) -> DataFrame:
    """Instance steps spread over the tasks: the table is small and what is unfolded from it is not."""
    real = space.where(~F.col("is_pad")) if "is_pad" in space.columns else space
    return real.select(*STEP_KEYS, *keep).repartition(shuffle_width(space), *STEP_KEYS)


def _every_step(joined: DataFrame) -> DataFrame:
    """Rows of a left join on the step; a step without background is an error, not a lost row."""
    there = F.when(F.col("_there"), True).otherwise(
        F.raise_error(F.concat(F.lit("the background has no rows for step "), F.col("step").cast("string"))).cast("boolean"))
    return joined.where(there).drop("_there")


def mask_expand(instances: DataFrame, background: DataFrame, groups: dict[str, list[str]] = GROUPS,
                chosen: DataFrame | None = None) -> DataFrame:
    """Every instance step under every coalition and background row of its step.

    Features of present groups come from the instance, the others from the background row. The background has
    ``rows per step * max_len`` rows, whatever the data size, and is broadcast; so is a table of chosen coalitions.
    """
    m = len(groups)
    if chosen is None:
        rows = instances.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(2 ** m - 1))))
    else:
        masks = chosen.agg(F.sort_array(F.collect_list("coalition")).alias("_masks"))
        both_ends = F.concat(F.col("_masks"), F.array(F.lit(0), F.lit(2 ** m - 1)))
        rows = (instances.join(F.broadcast(masks), F.lit(True))
                .withColumn("coalition", F.explode(both_ends)).drop("_masks"))
    other = background.select("step", F.col("sample").alias("background_row"),
                              *[F.col(f).alias(f"_b_{f}") for f in C.SPACE_ALL])
    joined = _every_step(rows.join(F.broadcast(other.withColumn("_there", F.lit(True))), "step", "left"))
    values = {f: F.when(_present(groups, f), F.col(f)).otherwise(F.col(f"_b_{f}")) for f in C.SPACE_ALL}
    return joined.withColumns(values).drop(*[f"_b_{f}" for f in C.SPACE_ALL])


def step_context(space: DataFrame, chronological: bool = True) -> DataFrame:
    """Scoring input of each step: the step itself and all earlier steps of its sequence, ``step + 1`` in all.

    A sequence has at most ``max_len`` steps, so the context is bounded.
    """
    row = F.struct("step", *C.SPACE_ALL)
    before = W.partitionBy(*ID_KEYS).orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    past = F.collect_list(row).over(before)
    whole = F.concat(past, F.array(row)) if chronological else F.concat(F.array(row), past)
    return space.where(~F.col("is_pad")).select(*STEP_KEYS, whole.alias("context"))


def with_past_score(rows: DataFrame, scorer: MeanPoolScorer, keys: list[str] = ID_KEYS) -> DataFrame:
    """Sum of the step scores before each step: all a mean-pooling scorer needs of the context."""
    before = W.partitionBy(*keys).orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    past = F.coalesce(F.sum(scorer.step_score()).over(before), F.lit(0.0))
    return rows.withColumn("past_score", past)


def contextual_probability(scorer: MeanPoolScorer) -> Column:
    """Probability of the sequence that ends in the (masked) step of the row."""
    mean = (F.col("past_score") + scorer.step_score()) / (F.col("step") + 1)
    return sigmoid(mean + scorer.fixed_score())


def masked_probabilities(space: DataFrame, background: DataFrame, model: MeanPoolScorer, groups: dict[str, list[str]] = GROUPS,
                         chosen: DataFrame | None = None) -> DataFrame:
    """Probability of every real step under every coalition and background row; the past of a step is one number."""
    rows = spread_steps(with_past_score(space.where(~F.col("is_pad")), model), [*C.SPACE_ALL, "past_score"])
    return mask_expand(rows, background, groups, chosen).withColumn("purchase_proba", contextual_probability(model))


def input_groups(groups: dict[str, list[str]]) -> tuple[np.ndarray, np.ndarray, int]:
    """The group that each position of the numeric inputs, of the codes, and inactivity belong to."""
    num, cat, fixed = np.zeros(C.N_INPUT, int), np.zeros(len(C.CODED_COLUMNS), int), 0
    for g, features in enumerate(groups.values()):
        for f in features:
            if f in C.INDICATOR_BLOCKS:
                offset, width = C.INDICATOR_BLOCKS[f]
                num[offset:offset + width] = g
            elif f in C.CODED_COLUMNS:
                cat[C.CODED_COLUMNS.index(f)] = g
            elif f in C.SPACE_FIXED:
                fixed = g
            else:
                num[C.NUMERIC_POSITION[f]] = g
    return num, cat, fixed


def _arrays(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.stack(rows["num"].to_numpy()).astype(float), np.stack(rows["cat"].to_numpy()).astype(int), rows["inactivity"].to_numpy(float)


def background_inputs(background: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Model inputs of the background rows of each step: ``rows per step * max_len`` in all, whatever the data size."""
    rows = model_inputs(background, "double").select("step", "sample", "num", "cat", "inactivity").toPandas().sort_values(["step", "sample"])
    return {int(step): _arrays(own) for step, own in rows.groupby("step")}


def prefix_values(space: DataFrame, background: DataFrame, scorer: PrefixScorer, groups: dict[str, list[str]] = GROUPS,
                  chosen: DataFrame | None = None, label: int = 1) -> DataFrame:
    """Value of every coalition of every real step for a scorer that goes step by step.

    A group is one sequence, at most ``max_len`` steps, and is read once in order: the state after the steps so far goes on with the step
    under every coalition and background row, made inside the task a bounded number of cells at a time. Only values leave it, as one row per step.
    """
    spark, m = space.sparkSession, len(groups)
    masks = [0, 2 ** m - 1] + [r["coalition"] for r in chosen.select("coalition").collect()] if chosen is not None else list(range(2 ** m))
    present = np.array([[mask >> g & 1 for g in range(m)] for mask in masks], bool)
    in_num, in_cat, in_fixed = input_groups(groups)
    shared = spark.sparkContext.broadcast(background_inputs(background))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("step")
        num, cat, inactivity = _arrays(group)
        state, out = scorer.start(), []
        for t, step in enumerate(group["step"].tolist()):
            if step not in shared.value:
                raise ValueError(f"the background has no rows for step {step}")
            other_num, other_cat, other_inactivity = shared.value[step]
            n = len(other_num)
            at_once = max(1, CELLS // (n * (len(in_num) + len(in_cat))))
            for i in range(0, len(present), at_once):
                there = present[i:i + at_once]
                mixed = [np.where(there[:, None, where], own, other).reshape(len(there) * n, -1)
                         for where, own, other in ((in_num, num[t], other_num), (in_cat, cat[t], other_cat))]
                fixed = np.where(there[:, in_fixed, None], inactivity[t], other_inactivity).ravel()
                p = scorer.finish(scorer.step(state, *mixed), step + 1, fixed).reshape(len(there), n).mean(axis=1)
                out.append(p if label == 1 else 1 - p)
            state = scorer.step(state, num[t:t + 1], cat[t:t + 1])
        means = np.concatenate(out).reshape(len(group), -1)
        return pd.DataFrame({"data_date": group["data_date"].iloc[0], "id": group["id"].iloc[0], "step": group["step"],
                             "coalition": [np.array(masks)] * len(group), "mean_proba": list(means)})

    rows = model_inputs(space.where(~F.col("is_pad")), "double").select(*STEP_KEYS, "num", "cat", "inactivity")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*STEP_KEYS).schema)
    scored = rows.repartition(shuffle_width(space), *ID_KEYS).groupBy(*ID_KEYS).applyInPandas(run, f"{schema}, coalition array<bigint>, mean_proba array<double>")
    values = scored.select(*STEP_KEYS, F.inline(F.arrays_zip("coalition", "mean_proba")))
    return values.withColumn("value", logit(F.col("mean_proba")))


def coalition_value(expanded: DataFrame, keys: list[str] = STEP_KEYS, label: int = 1) -> DataFrame:
    """Mean probability of each coalition over the background rows, on the logit scale."""
    p = F.col("purchase_proba") if label == 1 else 1 - F.col("purchase_proba")
    mean = expanded.groupBy(*keys, "coalition").agg(F.avg(p).alias("mean_proba"))
    return mean.withColumn("value", logit(F.col("mean_proba")))


def background_value(background: DataFrame, model, label: int = 1) -> DataFrame:
    """Logit of the mean probability of the background itself, with the background's own earlier steps."""
    if isinstance(model, MeanPoolScorer):
        scored = with_past_score(background, model, ["sample"]).withColumn("purchase_proba", contextual_probability(model))
    else:
        scorer = prefix_scorer(model)

        def run(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("step")
            num, cat, inactivity = _arrays(group)
            state, p = scorer.start(), []
            for t, step in enumerate(group["step"].tolist()):
                state = scorer.step(state, num[t:t + 1], cat[t:t + 1])
                p.append(float(scorer.finish(state, step + 1, inactivity[t:t + 1])[0]))
            return pd.DataFrame({"step": group["step"], "purchase_proba": p})

        rows = model_inputs(background, "double").select("sample", "step", "num", "cat", "inactivity")
        scored = rows.groupBy("sample").applyInPandas(run, "step int, purchase_proba double")
    p = F.col("purchase_proba") if label == 1 else 1 - F.col("purchase_proba")
    return scored.groupBy("step").agg(logit(F.avg(p)).alias("base_value"))


def with_background_base(values: DataFrame, base: DataFrame) -> DataFrame:
    """Take the value of the empty coalition from the background with its own context (one row per step)."""
    return (_every_step(values.join(F.broadcast(base.withColumn("_there", F.lit(True))), "step", "left"))
            .withColumn("value", F.when(F.col("coalition") == 0, F.col("base_value")).otherwise(F.col("value")))
            .drop("base_value"))


def shapley_values(values: DataFrame, groups: dict[str, list[str]] = GROUPS, keys: list[str] = STEP_KEYS) -> DataFrame:
    """Exact Shapley values from the values of all coalitions.

    A value enters the sum of a group with a factor that depends on the coalition's size and on whether it holds
    the group, so one aggregation with partial sums replaces the pairing of coalitions.
    """
    m = len(groups)
    size = F.bit_count("coalition")
    share = [math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)]
    gain = F.get(F.array(*[F.lit(w) for w in [0.0] + share]), size)
    loss = F.get(F.array(*[F.lit(w) for w in share + [0.0]]), size)
    bit = lambda i: F.shiftright("coalition", i).bitwiseAND(F.lit(1)) == 1
    sums = [F.sum(F.when(bit(i), F.col("value") * gain).otherwise(-F.col("value") * loss)).alias(g)
            for i, g in enumerate(groups)]
    return values.groupBy(*keys).agg(*sums).unpivot(keys, list(groups), "feature", "phi")


def regression_shares(plan: dict[int, float], m: int) -> dict[int, list[float]]:
    """What the value of each coalition of a plan (mask: weight), of none and of all groups adds to the Shapley value of each group.

    Least squares that meets the values of the empty and the full coalition is linear in the values, and its matrix depends on the plan alone.
    """
    full = 2 ** m - 1
    masks = [mask for mask in plan if mask not in (0, full)]
    z = np.array([[mask >> g & 1 for g in range(m)] for mask in masks], float).reshape(-1, m)
    w, last = np.sqrt([plan[mask] for mask in masks]), z[:, -1]
    head = np.linalg.pinv(w[:, None] * (z[:, :-1] - last[:, None]), rcond=np.finfo(float).eps * max(len(masks), m - 1)) * w
    shares = {mask: head[:, i] for i, mask in enumerate(masks)} | {0: head @ (last - 1), full: -(head @ last)}
    rest = {0: -1.0, full: 1.0}
    return {mask: [*map(float, own), float(rest.get(mask, 0.0) - own.sum())] for mask, own in shares.items()}


def shapley_regression(values: DataFrame, weights: DataFrame, groups: dict[str, list[str]] = SINGLE) -> DataFrame:
    """Shapley values by constrained weighted least squares over chosen coalitions.

    The values of the empty and the full coalition are met exactly. The weights are a plan of bounded size and are collected; every value then
    enters the sum of a group with the share that the plan gives it, so one aggregation with partial sums solves all steps. A step that
    lacks a coalition of the plan, or has another one, is an error.
    """
    plan = {r["coalition"]: r["kernel_weight"] for r in weights.select("coalition", "kernel_weight").collect()}
    shares = regression_shares(plan, len(groups))
    table = values.sparkSession.createDataFrame([(mask, own) for mask, own in shares.items()], "coalition bigint, _shares array<double>")
    sums = [F.sum(F.col("value") * F.get("_shares", F.lit(i))).alias(g) for i, g in enumerate(groups)]
    solved = values.join(F.broadcast(table), "coalition", "left").groupBy(*STEP_KEYS).agg(F.count("_shares").alias("_n"), F.count("*").alias("_all"), *sums)
    whole = F.when((F.col("_n") == len(shares)) & (F.col("_all") == len(shares)), True).otherwise(
        F.raise_error(F.lit("the values of a step are not those of the planned coalitions")).cast("boolean"))
    return solved.where(whole).unpivot(STEP_KEYS, list(groups), "feature", "phi")


def shap_values_of(space: DataFrame, background: DataFrame, model, groups: dict[str, list[str]] = GROUPS,
                   base: str = "instance", label: int = 1, chosen: DataFrame | None = None) -> DataFrame:
    """Values of all coalitions of every real step, or of the chosen ones.

    The model is a scorer with given coefficients, a fitted pipeline, a function of batches of records, or a scorer that goes
    step by step.
    """
    if isinstance(model, MeanPoolScorer):
        values = coalition_value(masked_probabilities(space, background, model, groups, chosen), label=label)
    else:
        values = prefix_values(space, background, prefix_scorer(model), groups, chosen, label)
    if base == "background":
        values = with_background_base(values, background_value(background, model, label))
    return values


def shap_instances(space: DataFrame, background: DataFrame, model, groups: dict[str, list[str]] = GROUPS,
                   base: str = "instance", label: int = 1) -> DataFrame:
    """Shapley values of every step of every instance in one job, exact over feature groups."""
    return shapley_values(shap_values_of(space, background, model, groups, base, label), groups)


def shap_instances_sampled(space: DataFrame, background: DataFrame, model, budget: int, seed: int = Params.seed,
                           label: int = 1) -> DataFrame:
    """Shapley values per single feature, over a budget of coalitions."""
    chosen = sampled_coalitions(space.sparkSession, len(SINGLE), budget, seed)
    return shapley_regression(shap_values_of(space, background, model, SINGLE, label=label, chosen=chosen), chosen)
