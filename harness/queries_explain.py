"""Registered queries: explainer space, training statistics, perturbation, surrogates, Shapley values."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from harness.ctes import CUT, FIXED_SCORE, M, MAX_STEPS, P, SEED, STEP_SCORE, r6
from harness.queries_sequences import _text
from harness.registry import query
from harness.stage import Stage
from propensight import constants as C
from propensight.functions.prefix import of_steps
from propensight.operators import model as Mo, moments as Mm, perturb as Pe, shapley as Sh, space as Sp, stats as St, surrogate as Su
from propensight.sources import tables as T

KEYS = "data_date, id"
SPACE = C.SPACE_ALL


def cells(columns: list[str] = SPACE, digits: int = 6) -> str:
    return ", ".join(f"{r6(c, digits)} AS {c}" for c in columns)


def coarse(df: DataFrame) -> DataFrame:
    """Draws of up to six integer digits, to three decimals: the engines' logarithms differ in the last bit."""
    return df.withColumns({c: F.round(c, 3) for c in C.SPACE_NUMERIC + C.SPACE_FIXED if c in df.columns})


# ---- explainer space

@query("max_sequence_length", "SELECT max(seq_length) AS max_length FROM seqs")
def _(s: Stage) -> DataFrame:
    return Sp.max_sequence_length(s.examples)


_pad = lambda c: r6(f"CASE WHEN t.step IS NULL THEN {'-1e0' if c in C.SPACE_NUMERIC else '0e0'} ELSE t.{c} END")


@query("pad_steps", f"""
SELECT q.data_date, q.id, CAST(i AS INTEGER) AS step, t.step IS NULL AS is_pad, {', '.join(f'{_pad(c)} AS {c}' for c in C.SPACE_STEP)}
FROM seqs q CROSS JOIN generate_series(0, {MAX_STEPS + 1}) g(i)
LEFT JOIN space t ON t.data_date = q.data_date AND t.id = q.id AND t.step = i""")
def _(s: Stage) -> DataFrame:
    padded = Sp.to_explainer_space(Sp.pad_steps(s.examples, MAX_STEPS + 2))
    return padded.select("data_date", "id", "step", "is_pad", *C.SPACE_STEP)


@query("to_explainer_space", f"SELECT {KEYS}, step, {cells()} FROM space")
def _(s: Stage) -> DataFrame:
    return s.space.select("data_date", "id", "step", *SPACE)


_n, _c = len(C.SPACE_NUMERIC), len(C.SPACE_CATEGORICAL)
_LENGTH = "(SELECT max(step) + 1 FROM space)"


def _flat(f: str) -> str:
    if f in C.SPACE_NUMERIC:
        place = f"step * {_n} + {C.SPACE_NUMERIC.index(f)}"
    else:
        place = f"{_LENGTH} * {_n} + step * {_c} + {C.SPACE_CATEGORICAL.index(f)}"
    return (f"SELECT {KEYS}, '{f}_t' || CAST(step AS VARCHAR) AS name, CAST({place} AS INTEGER) AS position, "
            f"{r6(f)} AS value FROM space")


@query("flatten_steps", " UNION ALL ".join(_flat(f) for f in C.SPACE_STEP) + f"""
UNION ALL SELECT {KEYS}, 'inactivity_time', CAST({_LENGTH} * {_n + _c} AS INTEGER), {r6('inactivity')} FROM space WHERE step = 0""")
def _(s: Stage) -> DataFrame:
    return Sp.flatten_steps(s.space)


def _at(f: str, t: int) -> str:
    return f"{r6(f'max(CASE WHEN step = {t} THEN {f} END)')} AS {f}_t{t}"


@query("flatten_wide", f"""
SELECT {KEYS}, {', '.join(_at(f, t) for f in C.SPACE_STEP for t in range(MAX_STEPS))},
       {r6('max(inactivity)')} AS inactivity_time FROM space GROUP BY {KEYS}""")
def _(s: Stage) -> DataFrame:
    return Sp.flatten_wide(s.space, MAX_STEPS)


@query("flatten_per_step", f"SELECT {KEYS}, step, {cells()} FROM space")
def _(s: Stage) -> DataFrame:
    return Sp.flatten_per_step(s.space)


def _fixed_label(f: str) -> str:
    names = C.WEEK_DAYS if f == "week_day" else C.MONTH_NAMES
    return f"CASE CAST({f} AS INTEGER) WHEN 0 THEN 'PAD' " + " ".join(
        f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(names)) + " END"


def _label(f: str) -> str:
    if f in ("week_day", "month"):
        return f"SELECT {KEYS}, step, '{f}' AS feature, CAST({f} AS INTEGER) AS code, {_fixed_label(f)} AS text FROM space"
    if f in C.INDICATOR_COLUMNS:
        return (f"SELECT {KEYS}, step, '{f}' AS feature, CAST({f} AS INTEGER) AS code, "
                f"CASE WHEN value = '' THEN 'None_{f}' ELSE value END AS text FROM space "
                f"JOIN slots ON feature = '{f}' AND code + 1 = {f}")
    return (f"SELECT {KEYS}, step, '{f}' AS feature, CAST({f} AS INTEGER) AS code, value AS text FROM space "
            f"JOIN vocab ON feature = '{f}' AND code = {f}")


@query("category_labels", f"SELECT *, feature || '=' || text AS display_name FROM ("
       + " UNION ALL ".join(_label(f) for f in C.SPACE_INDICATOR + C.CODED_COLUMNS) + ")")
def _(s: Stage) -> DataFrame:
    return Sp.category_labels(s.space, s.vocabulary, s.slots)


@query("from_explainer_space", f"""
SELECT {KEYS}, seq_length, {r6('inactivity')} AS inactivity,
       string_agg(array_to_string(list_transform(num, lambda x: CAST(CAST(round(x * 100e0) AS BIGINT) AS VARCHAR)), ','), ';' ORDER BY step) AS inputs_num,
       string_agg(array_to_string(list_transform(cat, lambda x: CAST(x AS VARCHAR)), ','), ';' ORDER BY step) AS inputs_cat
FROM (SELECT * REPLACE (CAST(CAST(inactivity AS FLOAT) AS DOUBLE) AS inactivity) FROM steps) GROUP BY {KEYS}, seq_length, inactivity""")
def _(s: Stage) -> DataFrame:
    back = Sp.from_explainer_space(s.space)
    return back.select("data_date", "id", "seq_length", "inactivity", _text("inputs_num", 100.0), _text("inputs_cat"))


_blocks = [(f"{b}_{i}", "week_index" if b == "week_day" else "month_index" if b == "month" else f"{b}_slot", i, b)
           for b, (_, n) in C.INDICATOR_BLOCKS.items() for i in range(n)]


def _mismatch() -> str:
    """Forward and backward mapping written out per model input."""
    out = []
    for name, index, i, b in _blocks:
        slot = i if b in C.INDICATOR_COLUMNS else i + 1
        out.append((name, f"CAST({index} = {slot} AS INTEGER) <> CAST(space_{b} - 1 = {i} AS INTEGER)"))
    for c in C.NUMERIC_COLUMNS:
        back = f"CASE WHEN space_{c} < 0 THEN space_{c} + 2 ELSE space_{c} - 1 END" if c == "product_qty" else \
            f"space_{c} - 1" if c in C.SPACE_SHIFTED else f"space_{c}"
        out.append((c, f"abs(CAST(CAST({c} AS FLOAT) AS DOUBLE) - ({back})) > 1e-8"))
    out += [(c, f"{c}_code <> space_{c}") for c in C.CODED_COLUMNS]
    pairs = ("SELECT s.*, " + ", ".join(f"x.{f} AS space_{f}" for f in C.SPACE_STEP)
             + " FROM steps s JOIN space x ON s.data_date = x.data_date AND s.id = x.id AND s.step = x.step")
    return " UNION ALL ".join(f"SELECT '{n}' AS feature, count(*) FILTER ({e}) AS mismatches FROM ({pairs})" for n, e in out)


@query("roundtrip_mismatches", _mismatch())
def _(s: Stage) -> DataFrame:
    return Sp.roundtrip_mismatches(s.steps)


# ---- training statistics

_STATS = f"step, feature, kind, n, {r6('mean')} AS mean, {r6('std')} AS std, {r6('min')} AS min, {r6('max')} AS max"


@query("column_stats", f"SELECT {_STATS} FROM stats")
def _(s: Stage) -> DataFrame:
    return St.column_stats(s.space)


@query("column_stats_per_step", f"SELECT {_STATS} FROM stats_step")
def _(s: Stage) -> DataFrame:
    return St.column_stats_per_step(s.space)


@query("value_frequencies", f"SELECT step, feature, value, cnt, CAST(c_lo AS BIGINT) AS c_lo, CAST(c_hi AS BIGINT) AS c_hi, "
                            f"CAST(total AS BIGINT) AS total, {r6('cnt / total')} AS share FROM freq")
def _(s: Stage) -> DataFrame:
    return St.value_frequencies(s.space)


def _days(s: Stage) -> DataFrame:
    """The sequences dealt to five days, so that partial states of several days are merged."""
    return s.space.withColumn("data_date", F.date_sub("data_date", F.pmod(F.col("id").cast("int"), F.lit(5))))


@query("column_stats_by_day", f"SELECT {_STATS} FROM stats")
def _(s: Stage) -> DataFrame:
    return St.merged_moments(St.daily_moments(_days(s)))


@query("value_frequencies_by_day", f"SELECT step, feature, value, cnt, CAST(c_lo AS BIGINT) AS c_lo, CAST(c_hi AS BIGINT) AS c_hi, "
                                   f"CAST(total AS BIGINT) AS total, {r6('cnt / total')} AS share FROM freq")
def _(s: Stage) -> DataFrame:
    return St.merged_frequencies(St.daily_value_counts(_days(s)))


@query("daily_moments", f"""
SELECT CAST(d AS DATE) AS data_date, step, feature, count(*) AS n, {r6('avg(x)')} AS mean, {r6('var_pop(x) * count(*)', 3)} AS squares, {r6('min(x)')} AS min, {r6('max(x)')} AS max
FROM (SELECT data_date - CAST(CAST(id AS INTEGER) % 5 AS INTEGER) AS d, step, 'product_price' AS feature, product_price AS x FROM space UNION ALL
      SELECT data_date - CAST(CAST(id AS INTEGER) % 5 AS INTEGER), -1, 'inactivity', inactivity FROM space WHERE step = 0) GROUP BY 1, 2, 3""")
def _(s: Stage) -> DataFrame:
    states = St.daily_moments(_days(s)).where(F.col("feature").isin("product_price", "inactivity"))
    return states.withColumn("squares", F.round("squares", 3))


@query("categorical_unit_scale", f"""
SELECT step, feature, kind, {r6("CASE WHEN kind = 'cat' THEN 0 ELSE mean END")} AS mean,
       {r6("CASE WHEN kind = 'cat' OR std = 0 THEN 1 ELSE std END")} AS std FROM stats""")
def _(s: Stage) -> DataFrame:
    return St.categorical_unit_scale(s.stats).select("step", "feature", "kind", "mean", "std")


@query("product_hierarchy", "SELECT dept, cat, array_to_string(list_transform(subcats, lambda x: CAST(x AS VARCHAR)), ',') AS subcats FROM hier")
def _(s: Stage) -> DataFrame:
    return St.product_hierarchy(s.space).select("dept", "cat", F.array_join(F.col("subcats").cast("array<string>"), ",").alias("subcats"))


# ---- perturbation

def _frame(s: Stage) -> DataFrame:
    real = s.space.select("data_date", "id", "step", "seq_length", *SPACE)
    return Pe.expand_samples(real, P.samples)


_SAMPLE = ["data_date", "id", "sample", "step"]


@query("draw_normal", f"SELECT {', '.join(_SAMPLE)}, {cells(C.SPACE_NUMERIC + C.SPACE_FIXED, 3)} FROM nb_num")
def _(s: Stage) -> DataFrame:
    return coarse(Pe.draw_normal(_frame(s), s.stats, seed=SEED).select(*_SAMPLE, *C.SPACE_NUMERIC, *C.SPACE_FIXED))


@query("draw_categorical", f"SELECT {', '.join(_SAMPLE)}, {cells(C.SPACE_CATEGORICAL)} FROM nb_drawn")
def _(s: Stage) -> DataFrame:
    return Pe.draw_categorical(_frame(s), s.frequencies, seed=SEED).select(*_SAMPLE, *C.SPACE_CATEGORICAL)


@query("alias_tables", f"SELECT step, feature, CAST(cell AS INTEGER) AS cell, value, {r6('keep')} AS keep, CASE WHEN keep < 1 THEN other END AS other FROM alias")
def _(s: Stage) -> DataFrame:
    cells = Pe.alias_tables(s.frequencies, ["step", "feature"])
    return cells.select("step", "feature", "cell", "value", "keep", F.when(F.col("keep") < 1, F.col("other")).alias("other"))


@query("resample_hierarchy", f"SELECT {', '.join(_SAMPLE)}, {cells(C.CODED_COLUMNS)} FROM nb_prod")
def _(s: Stage) -> DataFrame:
    drawn = Pe.draw_categorical(_frame(s), s.frequencies, C.CODED_COLUMNS, SEED)
    return Pe.resample_hierarchy(drawn, s.hierarchy, s.frequencies, SEED).select(*_SAMPLE, *C.CODED_COLUMNS)


@query("resample_pages", f"SELECT {', '.join(_SAMPLE)}, {cells(['nb_pages', 'unique_pages'])} FROM nb_pages")
def _(s: Stage) -> DataFrame:
    drawn = Pe.draw_categorical(_frame(s), s.frequencies, ["nb_pages", "unique_pages"], SEED)
    return Pe.resample_pages(drawn, SEED).select(*_SAMPLE, "nb_pages", "unique_pages")


@query("neighborhood", f"SELECT {', '.join(_SAMPLE)}, {cells(digits=3)} FROM samples")
def _(s: Stage) -> DataFrame:
    return coarse(s.samples_lazy.select(*_SAMPLE, *SPACE))


@query("interpretable_form", f"SELECT {', '.join(_SAMPLE)}, {cells()} FROM interp")
def _(s: Stage) -> DataFrame:
    return s.interpretable.select(*_SAMPLE, *SPACE)


@query("background_set", f"SELECT step, sample, {cells(digits=3)} FROM background")
def _(s: Stage) -> DataFrame:
    return coarse(Pe.background_set(s.stats_per_step, s.frequencies, s.hierarchy, P.background, SEED))


# ---- surrogate

@query("score_samples", f"SELECT {KEYS}, sample, {r6('1 - p1')} AS p0, {r6('p1')} AS p1 FROM scored_samples")
def _(s: Stage) -> DataFrame:
    return Su.score_samples(s.samples, s.scorer)


@query("score_samples_fitted")
def _(s: Stage) -> DataFrame:
    return Su.score_samples(s.samples, Mo.fit_classifier(s.examples), Mo.score)


@query("sample_distances", f"SELECT {KEYS}, sample, {r6('distance')} AS distance FROM distances")
def _(s: Stage) -> DataFrame:
    return Su.sample_distances(s.interpretable)


@query("kernel_weights", f"SELECT {KEYS}, sample, {r6('distance')} AS distance, {r6('weight')} AS weight FROM kernel")
def _(s: Stage) -> DataFrame:
    return Su.kernel_weights(Su.sample_distances(s.interpretable), s.max_length, P.kernel_width)


@query("design_rows", f"""
SELECT {KEYS}, sample, {r6('any_value(k.distance)')} AS distance, {r6('any_value(p.p1)')} AS p1,
       {r6('sum(' + ' + '.join('i.' + f for f in C.SPACE_STEP) + ') + any_value(i.inactivity)')} AS total, count(*) * 17 + 1 AS width
FROM interp i JOIN kernel k USING (data_date, id, sample) JOIN scored_samples p USING (data_date, id, sample) GROUP BY {KEYS}, sample""")
def _(s: Stage) -> DataFrame:
    total = F.aggregate("x", F.lit(0.0), lambda acc, x: acc + x)
    return s.design.select("data_date", "id", "sample", "distance", "p1", total.alias("total"),
                           F.size("x").cast("long").alias("width"))


@query("local_linear_fit")
def _(s: Stage) -> DataFrame:
    return Su.local_linear_fit(s.design, s.max_length, [(P.kernel_width, None, P.samples)])


@query("single_feature_fit", f"SELECT {KEYS}, step, feature, {r6('weight')} AS weight, {r6('x0')} AS x0, {r6('intercept')} AS intercept FROM slopes")
def _(s: Stage) -> DataFrame:
    return Su.single_feature_fit(s.design, s.max_length, P.kernel_width)


_PLACED = ("row_number() OVER (PARTITION BY data_date, id ORDER BY round(abs({w}), 9) DESC, {t})")


@query("select_features", f"""
SELECT {KEYS}, step, feature, {r6('weight')} AS weight, {r6('x0')} AS x0,
       CAST({_PLACED.format(w='weight * x0', t='step, feature')} AS INTEGER) AS place FROM refit""")
def _(s: Stage) -> DataFrame:
    chosen = Su.select_features(s.design, s.max_length, 6, P.kernel_width)
    return chosen.select("data_date", "id", "step", "feature", "weight", "x0", "place")


@query("top_labels", f"""
SELECT {KEYS}, label, {r6('proba')} AS proba, CAST(row_number() OVER (PARTITION BY {KEYS} ORDER BY proba DESC, label DESC) AS INTEGER) AS place
FROM (SELECT {KEYS}, CAST(1 AS INTEGER) AS label, p1 AS proba FROM scored_samples WHERE sample = 0
      UNION ALL SELECT {KEYS}, CAST(0 AS INTEGER), 1 - p1 FROM scored_samples WHERE sample = 0)""")
def _(s: Stage) -> DataFrame:
    return Su.top_labels(Su.score_samples(s.samples, s.scorer), 2)


@query("regression_mode", f"""
SELECT {KEYS}, {r6('max(CASE WHEN sample = 0 THEN p1 END)')} AS predicted_value, {r6('min(p1)')} AS min_value,
       {r6('max(p1)')} AS max_value FROM scored_samples GROUP BY {KEYS}""")
def _(s: Stage) -> DataFrame:
    return Su.regression_mode(Su.score_samples(s.samples, s.scorer))


@query("both_labels", f"""
SELECT {KEYS}, CAST(1 AS INTEGER) AS label, step, feature, {r6('weight')} AS weight FROM slopes
UNION ALL SELECT {KEYS}, CAST(0 AS INTEGER), step, feature, {r6('-weight')} FROM slopes""")
def _(s: Stage) -> DataFrame:
    return Su.both_labels(s.slopes).select("data_date", "id", "label", "step", "feature", "weight")


@query("explain_top", f"""
SELECT {KEYS}, step, feature, {r6('weight')} AS weight, CAST(place AS INTEGER) AS place,
       CASE WHEN weight > 0 THEN 'positive' ELSE 'negative' END AS sign FROM (
  SELECT *, {_PLACED.format(w='weight', t='step, feature')} AS place FROM slopes) WHERE place <= 10""")
def _(s: Stage) -> DataFrame:
    return Su.explain_top(s.slopes, 10)


@query("explain_by_feature", f"""
SELECT {KEYS}, feature, {r6('weight')} AS weight, CAST({_PLACED.format(w='weight', t='feature')} AS INTEGER) AS place
FROM (SELECT {KEYS}, feature, sum(weight) AS weight FROM slopes GROUP BY {KEYS}, feature)""")
def _(s: Stage) -> DataFrame:
    return Su.explain_by_feature(s.slopes)


_FAMILY = "CASE feature " + " ".join(f"WHEN '{f}' THEN '{g}'" for f, g in C.FAMILIES.items()) + " ELSE feature END"


@query("explain_by_family", f"""
SELECT {KEYS}, family, {r6('weight')} AS weight, CAST({_PLACED.format(w='weight', t='family')} AS INTEGER) AS place
FROM (SELECT {KEYS}, {_FAMILY} AS family, sum(weight) AS weight FROM slopes GROUP BY 1, 2, 3)""")
def _(s: Stage) -> DataFrame:
    return Su.explain_by_family(s.slopes)


@query("explain_summary")
def _(s: Stage) -> DataFrame:
    return Su.explain_summary(Su.local_linear_fit(s.design, s.max_length, [(P.kernel_width, None, P.samples)]))


@query("explain_sweep")
def _(s: Stage) -> DataFrame:
    return Su.explain_summary(Su.explain_sweep(s.space, s.stats, s.frequencies, s.hierarchy, s.scorer, s.max_length,
                                               [0.25, 0.5, 0.75], [5, 10, 20, 40, 80], [10, 15, 20], seed=SEED))


@query("fit_each_column", f"""
SELECT {KEYS}, CAST(label AS INTEGER) AS label, step, feature, {r6('CASE WHEN label = 1 THEN weight ELSE -weight END')} AS weight, {r6('x0')} AS x0
FROM slopes CROSS JOIN (VALUES (0), (1)) l(label)""")
def _(s: Stage) -> DataFrame:
    """A second regressor, both labels from one pass over merged moments."""
    fits = Su.local_linear_fit(s.design, s.max_length, [(P.kernel_width, None, P.samples)], label=(1, 0), regressor=Mm.marginal())
    return fits.select("data_date", "id", "label", "step", "feature", "weight", "x0")


@query("fit_top_label", f"""
SELECT {KEYS}, CAST(CASE WHEN p.p1 >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS label, step, feature,
       {r6('CASE WHEN p.p1 >= 0.5 THEN weight ELSE -weight END')} AS weight, {r6('greatest(p.p1, 1 - p.p1)')} AS real_pred
FROM slopes JOIN (SELECT {KEYS}, p1 FROM scored_samples WHERE sample = 0) p USING ({KEYS})""")
def _(s: Stage) -> DataFrame:
    fits = Su.local_linear_fit(s.design, s.max_length, [(P.kernel_width, None, P.samples)], regressor=Mm.marginal(), top_labels=1)
    return fits.select("data_date", "id", "label", "step", "feature", "weight", "real_pred")


@query("fit_regression", f"""
SELECT {KEYS}, CAST(label AS INTEGER) AS label, step, feature, {r6('CASE WHEN label = 1 THEN weight ELSE -weight END')} AS weight,
       {r6('predicted_value')} AS predicted_value, {r6('min_value')} AS min_value, {r6('max_value')} AS max_value
FROM slopes CROSS JOIN (VALUES (0), (1)) l(label) JOIN (
  SELECT {KEYS}, max(CASE WHEN sample = 0 THEN p1 END) AS predicted_value, min(p1) AS min_value, max(p1) AS max_value
  FROM scored_samples GROUP BY {KEYS}) r USING ({KEYS})""")
def _(s: Stage) -> DataFrame:
    fits = Su.local_linear_fit(s.design, s.max_length, [(P.kernel_width, None, P.samples)], regressor=Mm.marginal(), mode="regression")
    return fits.select("data_date", "id", "label", "step", "feature", "weight", "predicted_value", "min_value", "max_value")


_products = lambda a, b: " + ".join(f"{a}.{f} * {b}.{f}" for f in C.SPACE_STEP)
_dot = lambda a, b: f"(sum({_products(a, b)}) + any_value({a}.inactivity * {b}.inactivity))"


@query("design_rows_cosine", f"""
SELECT i.data_date, i.id, i.sample, {r6(f"CASE WHEN {_dot('i', 'i')} * {_dot('o', 'o')} > 0 THEN 1 - {_dot('i', 'o')} / sqrt({_dot('i', 'i')} * {_dot('o', 'o')}) ELSE 1e0 END")} AS distance
FROM interp i JOIN interp o ON o.data_date = i.data_date AND o.id = i.id AND o.step = i.step AND o.sample = 0
GROUP BY i.data_date, i.id, i.sample""")
def _(s: Stage) -> DataFrame:
    return Su.design_rows(s.samples, s.stats, s.scorer, metric="cosine").select("data_date", "id", "sample", "distance")


@query("write_explanations", f"SELECT {KEYS}, step, feature, {r6('weight')} AS weight FROM slopes")
def _(s: Stage) -> DataFrame:
    path = s.path("explanations")
    T.write_explanations(s.slopes.withColumn("kernel_width", F.lit(P.kernel_width)), path)
    stored = s.spark.read.parquet(path).where((F.col("data_date") == F.lit(CUT)) & (F.col("kernel_width") == P.kernel_width))
    return stored.select("data_date", "id", "step", "feature", "weight")


# ---- Shapley values

_share = lambda k: Sh.shapley_kernel(M, k)
_KERNEL = "CASE bit_count(c) " + " ".join(f"WHEN {k} THEN {_share(k)!r}e0" for k in range(1, M)) + " END"


@query("coalitions", f"""
SELECT {KEYS}, step, CAST(c AS INTEGER) AS coalition, CAST(bit_count(c) AS INTEGER) AS size, {r6(_KERNEL)} AS kernel_weight
FROM space CROSS JOIN generate_series(0, {2 ** M - 1}) g(c)""")
def _(s: Stage) -> DataFrame:
    return Sh.coalitions(s.space.select("data_date", "id", "step"), M)


@query("mask_expand", f"""
SELECT step, coalition, count(*) AS n, {', '.join(f'{r6(f"sum({f})", 4)} AS {f}' for f in SPACE)}
FROM masked GROUP BY step, coalition""")
def _(s: Stage) -> DataFrame:
    return s.masked.groupBy("step", "coalition").agg(
        F.count("*").alias("n"), *[F.round(F.sum(f), 4).alias(f) for f in SPACE])


@query("step_context", f"""
SELECT {KEYS}, step, CAST(step + 1 AS INTEGER) AS length,
       {r6('sum(product_price) OVER (PARTITION BY data_date, id ORDER BY step)')} AS price_so_far, step AS last_step FROM space""")
def _(s: Stage) -> DataFrame:
    price = F.aggregate("context", F.lit(0.0), lambda acc, x: acc + x["product_price"])
    return Sh.step_context(s.space).select("data_date", "id", "step", F.size("context").alias("length"),
                                           price.alias("price_so_far"), F.element_at("context", -1)["step"].alias("last_step"))


@query("coalition_value", f"SELECT {KEYS}, step, coalition, {r6('mean_proba')} AS mean_proba, {r6('value')} AS value FROM coalition_values")
def _(s: Stage) -> DataFrame:
    return s.coalition_values


@query("background_value", f"""
SELECT step, {r6('ln(p / (1 - p))')} AS base_value FROM (
  SELECT step, avg(1e0 / (1e0 + exp(-((past + ({STEP_SCORE})) / (step + 1) + ({FIXED_SCORE}))))) AS p FROM (
    SELECT *, coalesce(sum({STEP_SCORE}) OVER (PARTITION BY sample ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS past
    FROM background) GROUP BY step)""")
def _(s: Stage) -> DataFrame:
    return Sh.background_value(s.background, s.scorer)


@query("shapley_values", f"SELECT {KEYS}, step, feature, {r6('phi')} AS phi FROM phi")
def _(s: Stage) -> DataFrame:
    return Sh.shapley_values(s.coalition_values)


@query("shap_instances", f"SELECT {KEYS}, step, feature, {r6('phi')} AS phi FROM phi")
def _(s: Stage) -> DataFrame:
    return Sh.shap_instances(s.space, s.background, s.scorer)


@query("shap_instances_sampled")
def _(s: Stage) -> DataFrame:
    return Sh.shap_instances_sampled(s.space, s.background, s.scorer, budget=100, seed=SEED)


# ---- any model: the given coefficients as a function of sequence records

_AT = C.NUMERIC_POSITION | {f"{b}_{i}": offset + i for b, (offset, n) in C.INDICATOR_BLOCKS.items() for i in range(n)}
_LINEAR = {"product_price": 0.03, "event_env_3": 0.6, "event_env_0": -0.4, "nb_pages": 0.02, "unique_pages": -0.03, "delta_time": -0.000002,
           "duration": 0.00001, "week_day_6": 0.15, "latitude": 0.002, "longitude": -0.001, "device_3": 0.2, "product_rating": 0.04}
_USED, _WEIGHTS = [_AT[c] for c in _LINEAR], np.array(list(_LINEAR.values()))
_SHIFT = sum(_LINEAR[c] for c in ("nb_pages", "unique_pages", "product_rating"))  # the explainer cells of these are one more


def _step_score(x: np.ndarray) -> np.ndarray:
    quantity = x[:, _AT["product_qty"]]
    return x[:, _USED] @ _WEIGHTS + 0.05 * (quantity + np.where(quantity < 0, -2.0, 1.0)) + _SHIFT


def given_function(batch: pd.DataFrame) -> pd.Series:
    """What the scorer with given coefficients says, from the records alone."""
    lengths = batch["seq_length"].to_numpy()
    score = (of_steps(batch["inputs_num"], _step_score, float)
             + of_steps(batch["inputs_cat"], lambda codes: 0.1 * (codes[:, 0] == 2) - 0.01 * codes[:, 1]))
    mean = np.add.reduceat(score, np.cumsum(lengths) - lengths) / lengths
    return pd.Series(1 / (1 + np.exp(-(mean + 0.1 - 0.35 * batch["inactivity"].to_numpy()))), batch.index)


@query("shap_with_function", f"SELECT {KEYS}, step, feature, {r6('phi')} AS phi FROM phi")
def _(s: Stage) -> DataFrame:
    return Sh.shap_instances(s.space, s.background, given_function)
