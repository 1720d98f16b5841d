"""Perturbed neighbours of sequences and synthetic background rows.

All draws are functions of ``(seed, owner, sample, step, feature)``. A frame of draws has one row per
``(owner, sample, step)``; ``owner`` names the explained instance, or is a constant for background rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from propensight import constants as C
from propensight.config import Params
from propensight.functions import rng
from propensight.operators.sequences import ID_KEYS
from propensight.operators.stats import FIXED_STEP
from propensight.session import shuffle_width

DEPT, CAT, SUB = C.CODED_COLUMNS
BLOCK = 250


def draw_key(seed: int, feature: str, step: Column | None = None) -> Column:
    return rng.key(seed, F.col("owner"), F.col("sample"), F.col("step") if step is None else step, feature)


def _wide(stats: DataFrame, features: list[str]) -> DataFrame:
    """Mean and deviation of each feature on one row per step: at most ``max_len`` rows."""
    pick = lambda f, c: F.max(F.when(F.col("feature") == f, F.col(c))).alias(f"{f}_{c}")
    return stats.where(F.col("feature").isin(features)).groupBy("step").agg(
        *[pick(f, c) for f in features for c in ("mean", "std")])


def with_stats(frame: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach ``<feature>_mean`` and ``<feature>_std`` of the step's numeric columns and of the fixed one.

    The statistics become one row per step, at most ``max_len`` rows, and are broadcast.
    """
    fixed = C.SPACE_FIXED[0]
    steps = _wide(stats.where(F.col("step") != FIXED_STEP), C.SPACE_NUMERIC)
    whole = _wide(stats.where(F.col("step") == FIXED_STEP), [fixed]).drop("step")
    return frame.join(F.broadcast(steps.join(F.broadcast(whole), F.lit(True))), "step", "left")


def expand_samples(instances: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """``n`` sample rows per instance step.

    Blocks of samples are spread over the tasks before they are unfolded: the input is small and the output is
    not, and all steps of one sample stay in one task; ``block`` stays in the rows, so later work by block needs no shuffle.
    """
    blocks = F.explode(F.sequence(F.lit(0), F.lit((n - 1) // block))).alias("block")
    spread = instances.select("*", blocks).repartition(shuffle_width(instances), *ID_KEYS, "block")
    first = F.col("block") * block
    last = F.least(first + block - 1, F.lit(n - 1))
    return spread.withColumn("sample", F.explode(F.sequence(first, last))).withColumn("owner", F.concat_ws("|", *ID_KEYS))


def draw_normal(frame: DataFrame, stats: DataFrame, around: str | None = None, seed: int = Params.seed) -> DataFrame:
    """Normal draws for the numeric features and the fixed one, around the training mean.

    With ``around`` naming a struct column of instance values, around these. Features that cannot be negative
    are folded at 0. A step without statistics keeps the value it has.
    """
    features = C.SPACE_NUMERIC + C.SPACE_FIXED
    hashed = with_stats(frame, stats).select("*", *[
        draw_key(seed, f, F.lit(FIXED_STEP) if f in C.SPACE_FIXED else None).alias(f"_h_{f}") for f in features])
    out = {}
    for f in features:
        centre = F.col(f"{around}.{f}") if around else F.col(f"{f}_mean")
        value = rng.normal(F.col(f"_h_{f}")) * F.col(f"{f}_std") + centre
        value = F.abs(value) if f in C.POSITIVE else value
        out[f] = F.when(F.col(f"{f}_std").isNotNull(), value).otherwise(F.col(f)) if f in frame.columns else value
    kept = [c for c in frame.columns if c not in out]
    return hashed.select(*kept, *[v.alias(f) for f, v in out.items()])


def alias_tables(counts: DataFrame, by: list[str]) -> DataFrame:
    """Walker's tables of the distributions ``by``: as many cells as values, each of equal size, cell ``cell`` being its own ``value`` up to the
    share ``keep`` and ``other`` beyond, so that a draw is one look at one cell.

    With ``n`` values of total count ``t``, a value of count ``c`` lacks ``t - n c`` of a cell or has the opposite to spare. Both kinds
    stand in order of their values on one axis of running sums. A light value's rest is filled by the first heavy one whose sum is
    beyond what lighter ones have used; a heavy value keeps what the first light value to pass its sum leaves of it, and the next heavy one
    fills its own rest. All numbers are integers; a group is the values of one distribution.
    """
    whole, ordered = W.partitionBy(*by), W.partitionBy(*by).orderBy("value")
    n, t = F.count("*").over(whole), F.sum("cnt").over(whole)
    spare = F.col("cnt") * F.col("_n") - F.col("_t")
    kinds = W.partitionBy(*by, "_heavy").orderBy("value")
    rows = (counts.select(*by, "value", "cnt").withColumns({"_n": n, "_t": t, "cell": F.row_number().over(ordered) - 1})
            .withColumn("_spare", spare).withColumn("_heavy", F.col("_spare") > 0)
            .withColumns({"_end": F.sum(F.abs("_spare")).over(kinds.rowsBetween(W.unboundedPreceding, 0)),
                          "_next": F.lead("value").over(kinds)}))
    # From the far end of the axis the last one seen is the next one; the frames only grow, so a row costs the same in any group.
    heavy, light = F.col("_heavy"), ~F.col("_heavy")
    start = F.when(heavy, F.col("_end")).otherwise(F.col("_end") + F.col("_spare"))
    back = W.partitionBy(*by).orderBy(start.desc(), heavy.cast("int").asc(), F.col("value").desc()).rowsBetween(W.unboundedPreceding, 0)
    past = W.partitionBy(*by).orderBy(F.col("_end").desc(), heavy.cast("int").asc(), F.col("value").desc()).rowsBetween(W.unboundedPreceding, 0)
    filled = rows.withColumns({"_by": F.last(F.when(heavy, F.col("value")), ignorenulls=True).over(back),
                               "_used": F.last(F.when(light, F.col("_end")), ignorenulls=True).over(past)})
    kept = F.when(heavy, F.col("_t") - (F.col("_used") - F.col("_end"))).otherwise(F.col("_t") + F.col("_spare"))
    return filled.select(*by, "cell", "value", (kept / F.col("_t")).alias("keep"), F.when(heavy, F.col("_next")).otherwise(F.col("_by")).alias("other"))


def alias_arrays(counts: DataFrame, by: list[str]) -> DataFrame:
    """One row per distribution with its ``cells`` in order, an array per column: joined rows copy them, so they hold nothing but the numbers."""
    listed = alias_tables(counts, by).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("cell", "value", "keep", "other"))).alias("_cells"))
    return listed.select(*by, F.struct(*[F.col(f"_cells.{c}").alias(c) for c in ("value", "keep", "other")]).alias("cells"))


def _drawn(cells: str, u: str) -> Column:
    """The value at a position in [0, 1) of a distribution; null where there is none."""
    place = F.col(u) * F.size(f"{cells}.value")
    cell = lambda column: F.get(f"{cells}.{column}", F.floor(place).cast("int"))
    return F.when(place - F.floor(place) < cell("keep"), cell("value")).otherwise(cell("other"))


def draw_categorical(frame: DataFrame, freq: DataFrame, features: list[str] = C.SPACE_CATEGORICAL,
                     seed: int = Params.seed) -> DataFrame:
    """Draws by training frequency, independently per column. A step without values keeps the value it has.

    The distributions of a step are one row, so all columns are drawn after one join, which finds one row for each of the frame.
    """
    kept = [c for c in frame.columns if c not in features]
    cells = alias_arrays(freq.where(F.col("feature").isin(features)), ["step", "feature"])
    steps = cells.groupBy("step").agg(*[F.first(F.when(F.col("feature") == f, F.col("cells")), ignorenulls=True).alias(f"_c_{f}") for f in features])
    drawn = frame.select("*", *[rng.uniform(draw_key(seed, f)).alias(f"_u_{f}") for f in features]).join(steps, "step", "left")
    new = {f: _drawn(f"_c_{f}", f"_u_{f}") for f in features}
    return drawn.select(*kept, *[(F.coalesce(v, F.col(f)) if f in frame.columns else v).alias(f) for f, v in new.items()])


def _any_of(values: str, u: str) -> Column:
    return F.get(values, F.floor(F.col(u) * F.size(values)).cast("int")).cast("double")


def _under(frame: DataFrame, column: str, known: DataFrame, parents: list[str], freq: DataFrame, u: str) -> DataFrame:
    """Descend one level of the tree: a value of ``column`` that its parents do not have is drawn among their children, by the
    children's frequencies at the step, or evenly where they have none.

    ``known`` has one row per node (``parents`` and the sorted ``children``). All joins are equalities that find at most one row: the node, the edge to
    the value, and the node's distribution at the step.
    """
    rest = [c for c in frame.columns if c != column]
    to = [f"_to_{p}" for p in parents]
    renamed = known.select(*[F.col(p).alias(t) for p, t in zip(parents, to, strict=True)], "children")
    edges = renamed.select(*to, F.explode("children").alias("_child"))
    seen = freq.where(F.col("feature") == column).select("step", F.col("value").alias("_child"), "cnt")
    nodes = alias_arrays(edges.join(seen, "_child").select("step", *to, F.col("_child").alias("value"), "cnt"), ["step", *to])
    same = lambda table: [F.col(p) == table[t] for p, t in zip(parents, to, strict=True)]
    edges = edges.withColumn("_is_child", F.lit(True))
    nodes = nodes.withColumnRenamed("step", "_step")
    found = (frame.join(renamed, same(renamed), "left").drop(*to)
             .join(edges, [*same(edges), F.col(column) == F.col("_child")], "left").drop(*to))
    found = found.join(nodes, [*same(nodes), F.col("step") == F.col("_step"), F.col("children").isNotNull(), F.col("_is_child").isNull()], "left")
    new = F.coalesce(_drawn("cells", u), _any_of("children", u))
    wrong = F.col("children").isNotNull() & F.col("_is_child").isNull()
    return found.select(*rest, F.when(wrong, new).otherwise(F.col(column)).alias(column))


def resample_hierarchy(frame: DataFrame, hierarchy: DataFrame, freq: DataFrame, seed: int = Params.seed) -> DataFrame:
    """Make department, category and sub-category of every row one that occurs together.

    An unseen department is drawn again by frequency, a category outside its department among the allowed ones
    with their frequencies at the step, a sub-category likewise; where no allowed value has a frequency at the
    step, all are equally likely. Rows that are consistent keep their values.
    """
    columns = frame.columns
    rest = [c for c in columns if c not in C.CODED_COLUMNS]
    us = [f"_u_{f}" for f in C.CODED_COLUMNS]
    pairs = hierarchy.select(F.col("dept").cast("double").alias(DEPT), F.col("cat").cast("double").alias(CAT),
                             F.col("subcats").cast("array<double>").alias("children"))
    depts = pairs.groupBy(DEPT).agg(F.sort_array(F.collect_set(CAT)).alias("children"))

    known = depts.select(F.col(DEPT).alias("_own"))
    seen = freq.where(F.col("feature") == DEPT).join(known, F.col("value") == F.col("_own"), "left_semi")
    cells = alias_arrays(seen, ["step"])
    drawn = frame.select("*", *[rng.uniform(draw_key(seed, f), 1).alias(f"_u_{f}") for f in C.CODED_COLUMNS])
    drawn = drawn.join(known, F.col(DEPT) == F.col("_own"), "left").join(cells, "step", "left")
    again = F.when(F.col("_own").isNull(), F.coalesce(_drawn("cells", f"_u_{DEPT}"), F.col(DEPT))).otherwise(F.col(DEPT))
    drawn = drawn.select(*rest, *us, CAT, SUB, again.alias(DEPT))
    drawn = _under(drawn, CAT, depts, [DEPT], freq, f"_u_{CAT}")
    drawn = _under(drawn, SUB, pairs, [DEPT, CAT], freq, f"_u_{SUB}")
    return drawn.select(*columns)


def resample_pages(frame: DataFrame, seed: int = Params.seed) -> DataFrame:
    """Unique pages never above pages. Both columns are moved up by one, so 1 stands for no page."""
    pages, unique = F.col("nb_pages"), F.col("unique_pages")
    u = rng.uniform(draw_key(seed, "unique_pages"), 1)
    drawn = F.floor(u * (pages - 1)) + 2
    return frame.withColumn("unique_pages", F.when(pages == 1, F.lit(1.0)).when(
        (pages > 1) & ((unique > pages) | (unique == 1)), drawn.cast("double")).otherwise(unique))


def neighborhood(instances: DataFrame, stats: DataFrame, freq: DataFrame, hierarchy: DataFrame,
                 n: int = Params.samples, seed: int = Params.seed, around: bool = False) -> DataFrame:
    """``n`` perturbed copies of every instance (explainer rows); sample 0 is the instance.

    Only real steps are drawn: a padded cell is the same in every copy and cannot carry weight. ``origin`` keeps
    the instance's own values next to the drawn ones, so that nothing has to be joined back.
    """
    real = instances.where(~F.col("is_pad")).select(
        *ID_KEYS, "step", "seq_length", *C.SPACE_ALL, F.struct(*C.SPACE_ALL).alias("origin"))
    frame = expand_samples(real, n)
    frame = draw_normal(frame, stats, "origin" if around else None, seed)
    frame = draw_categorical(frame, freq, seed=seed)
    frame = resample_pages(resample_hierarchy(frame, hierarchy, freq, seed), seed)
    first = F.col("sample") == 0
    return frame.select(*ID_KEYS, "block", "sample", "step", "seq_length", "origin", *[
        F.when(first, F.col(f"origin.{f}")).otherwise(F.col(f)).alias(f) for f in C.SPACE_ALL])


def interpretable_form(samples: DataFrame, stats: DataFrame) -> DataFrame:
    """Categorical: 1 where the sample has the instance's value. Numeric: standardised by the training columns."""
    known = with_stats(samples, stats)
    out = {f: (F.col(f) == F.col(f"origin.{f}")).cast("double") for f in C.SPACE_CATEGORICAL}
    for f in C.SPACE_NUMERIC + C.SPACE_FIXED:
        scale = F.when(F.col(f"{f}_std") > 0, F.col(f"{f}_std")).otherwise(F.lit(1.0))
        out[f] = (F.col(f) - F.coalesce(f"{f}_mean", F.lit(0.0))) / scale
    return known.select(*ID_KEYS, "sample", "step", "seq_length", *[out[f].alias(f) for f in C.SPACE_ALL])


def background_set(stats_per_step: DataFrame, freq: DataFrame, hierarchy: DataFrame, n: int = Params.background,
                   seed: int = Params.seed) -> DataFrame:
    """``n`` synthetic rows per step from the training columns, consistent in products and pages."""
    steps = stats_per_step.select("step").distinct()
    frame = steps.select("step", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("sample"),
                         F.lit("background").alias("owner"))
    wide = _wide(stats_per_step, C.SPACE_NUMERIC + C.SPACE_FIXED)  # one row per step
    frame = frame.repartition(shuffle_width(stats_per_step), "step", "sample").join(F.broadcast(wide), "step")
    features = C.SPACE_NUMERIC + C.SPACE_FIXED
    frame = frame.select("*", *[draw_key(seed, f).alias(f"_h_{f}") for f in features])
    value = {f: rng.normal(F.col(f"_h_{f}")) * F.col(f"{f}_std") + F.col(f"{f}_mean") for f in features}
    frame = frame.select("step", "sample", "owner", *[
        (F.abs(v) if f in C.POSITIVE else v).alias(f) for f, v in value.items()])
    frame = draw_categorical(frame, freq, seed=seed)
    frame = resample_pages(resample_hierarchy(frame, hierarchy, freq, seed), seed)
    return frame.select("step", "sample", *[F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in C.SPACE_ALL])
