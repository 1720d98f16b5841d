"""Registered queries: per-id facts and sequences, date planning, model fit and evaluation."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import DataFrame, functions as F

from harness import fixtures as X
from harness.ctes import CUT, FIXED_SCORE, P, SEED, STEP_SCORE, _pbin, d, effective, r6
from harness.registry import query
from harness.stage import Stage
from propensight import constants as C
from propensight.operators import calendar as Cal, evaluate as Ev, extract as E, model as M, sequences as S
from propensight.sources import tables as T

BOUNDS = list(P.bounds)


# ---- per id

@query("labels", "SELECT data_date, id, label FROM label")
def _(s: Stage) -> DataFrame:
    return S.labels(s.features, P.horizon)


@query("labels_next_day", f"""
SELECT data_date, id, max(CASE WHEN event_env = 'purchase' AND event_timestamp >= CAST(data_date + 1 AS timestamp)
       AND event_timestamp <= CAST(data_date + {P.horizon} AS timestamp) THEN 1 ELSE 0 END) AS label
FROM vectors GROUP BY data_date, id""")
def _(s: Stage) -> DataFrame:
    return S.labels(s.features, P.horizon, label_start="next_day")


@query("label_prevalence", f"SELECT {r6('100e0 * avg(label)')} AS percentage_win FROM label")
def _(s: Stage) -> DataFrame:
    return S.label_prevalence(S.labels(s.features, P.horizon))


@query("inactivity", f"SELECT data_date, id, {r6('inactivity')} AS inactivity FROM idle")
def _(s: Stage) -> DataFrame:
    return S.inactivity(s.features)


@query("inactivity_mean", f"SELECT {r6('avg(inactivity)')} AS mean_inactivity FROM idle")
def _(s: Stage) -> DataFrame:
    return S.inactivity_mean(S.inactivity(s.features))


@query("last_k_events", "SELECT data_date, id, event_id, event_timestamp FROM last_k")
def _(s: Stage) -> DataFrame:
    return S.last_k_events(s.features, P.max_len).select("data_date", "id", "event_id", "event_timestamp")


_NUM = "list_transform(num, lambda x: CAST(CAST(round(x * 100e0) AS BIGINT) AS VARCHAR))"
_CAT = "list_transform(cat, lambda x: CAST(x AS VARCHAR))"
_SEQ = (f"seq_length, string_agg(array_to_string({_NUM}, ','), ';' ORDER BY step) AS inputs_num, "
        f"string_agg(array_to_string({_CAT}, ','), ';' ORDER BY step) AS inputs_cat")


def _text(column: str, scale: float | None = None):
    cell = (lambda x: F.round(x.cast("double") * scale).cast("long").cast("string")) if scale else (
        lambda x: x.cast("string"))
    return F.array_join(F.transform(column, lambda row: F.array_join(F.transform(row, cell), ",")), ";").alias(column)


@query("build_sequences", f"SELECT data_date, id, {_SEQ} FROM steps GROUP BY data_date, id, seq_length")
def _(s: Stage) -> DataFrame:
    return S.build_sequences(s.features, P.max_len).select(
        "data_date", "id", "seq_length", _text("inputs_num", 100.0), _text("inputs_cat"))


@query("sequence_examples", f"SELECT data_date, id, {_SEQ}, label, {r6('inactivity')} AS inactivity FROM steps "
                            "GROUP BY data_date, id, seq_length, label, inactivity")
def _(s: Stage) -> DataFrame:
    return S.sequence_examples(s.features, P.max_len, P.horizon).select(
        "data_date", "id", "seq_length", _text("inputs_num", 100.0), _text("inputs_cat"), "label", "inactivity")


@query("step_rows", f"SELECT data_date, id, step, seq_length, {r6('CAST(num[41] AS DOUBLE)')} AS product_price, "
                    f"{r6('CAST(num[49] AS DOUBLE)')} AS delta_time, cat[1] AS department, cat[3] AS sub_category, "
                    "CAST(1 - label AS VARCHAR) || ',' || CAST(label AS VARCHAR) AS label_vec FROM steps")
def _(s: Stage) -> DataFrame:
    return s.steps.select("data_date", "id", "step", "seq_length", F.get("num", F.lit(40)).alias("product_price"),
                          F.get("num", F.lit(48)).alias("delta_time"), F.get("cat", F.lit(0)).alias("department"),
                          F.get("cat", F.lit(2)).alias("sub_category"),
                          F.array_join(F.col("label_vec").cast("array<string>"), ",").alias("label_vec"))


_BUCKET = ("CASE " + " ".join(f"WHEN seq_length <= {b} THEN {i}" for i, b in enumerate(BOUNDS[:-1]))
           + f" ELSE {len(BOUNDS) - 1} END")


@query("length_bucket", f"SELECT data_date, id, seq_length, {_BUCKET} AS bucket FROM seqs")
def _(s: Stage) -> DataFrame:
    return S.length_bucket(s.examples, BOUNDS).select("data_date", "id", "seq_length", "bucket")


@query("pad_batches", f"""
SELECT data_date, id, bucket, batch_no, max(seq_length) OVER (PARTITION BY data_date, bucket, batch_no) AS padded_length,
       max(seq_length) OVER (PARTITION BY data_date, bucket, batch_no) - seq_length AS n_pad
FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY data_date, bucket ORDER BY id) - 1) / {P.batch_size}) AS INTEGER) AS batch_no
      FROM (SELECT *, {_BUCKET} AS bucket FROM seqs))""")
def _(s: Stage) -> DataFrame:
    padded = S.pad_batches(s.examples, P.batch_size, BOUNDS)
    n_pad = F.size(F.filter("inputs_num", lambda v: F.forall(v, lambda x: x == C.PAD_NUMERIC)))
    return padded.select("data_date", "id", "bucket", "batch_no", F.size("inputs_num").alias("padded_length"), n_pad.alias("n_pad"))


@query("shuffle_examples", f"SELECT data_date, id, md5(concat_ws('|', '{SEED}', data_date, id)) AS order_key, "
                           f"row_number() OVER (ORDER BY md5(concat_ws('|', '{SEED}', data_date, id)), id) - 1 AS place FROM seqs")
def _(s: Stage) -> DataFrame:
    return S.shuffle_examples(s.examples, SEED).select("data_date", "id", "order_key", "place")


# ---- date planning

LATE = X.EXEC_DATE + dt.timedelta(days=1)


@query("effective_execution_date", effective(LATE))
def _(s: Stage) -> DataFrame:
    return Cal.effective_execution_date(E.available_dates(s.events), LATE)


_LONG = 40


@query("missing_days", f"""
SELECT data_date, count(*) OVER () AS n_missing, count(*) OVER () > {int(0.1 * _LONG)} AS abort
FROM (SELECT CAST(unnest(generate_series(execution_date - {_LONG - 1}, execution_date, INTERVAL 1 DAY)) AS date) AS data_date
      FROM effective) WHERE data_date NOT IN (SELECT day FROM days)""")
def _(s: Stage) -> DataFrame:
    return Cal.missing_days(E.available_dates(s.events), X.EXEC_DATE, _LONG)


def _calendar(s: Stage, action: str = "train", last_only: bool = False) -> DataFrame:
    return Cal.training_calendar(E.available_dates(s.events), X.EXEC_DATE, action, P.training_history, P.horizon, last_only)


@query("training_calendar", f"""
SELECT 'train' AS action, data_date FROM calendar
UNION ALL SELECT 'predict', execution_date FROM first_day WHERE first_date <= execution_date - {P.horizon}
UNION ALL SELECT 'evaluate', execution_date - {P.horizon} FROM first_day WHERE first_date <= execution_date - {P.horizon}
UNION ALL SELECT 'test', max(data_date) FROM calendar""")
def _(s: Stage) -> DataFrame:
    every = None
    for action in ("train", "predict", "evaluate", "test"):
        one = _calendar(s, "train" if action == "test" else action, action == "test").select(
            F.lit(action).alias("action"), "data_date")
        every = one if every is None else every.unionByName(one)
    return every


@query("dates_to_process", f"""
SELECT data_date, data_date NOT IN (SELECT data_date FROM extract_many) AS needs_extract
FROM calendar WHERE data_date NOT IN (SELECT data_date FROM seqs)""")
def _(s: Stage) -> DataFrame:
    path = s.path("store")
    T.write_sequences(s.examples, f"{path}/sequences")
    T.write_extract(s.extract_many, f"{path}/extracts")
    return Cal.dates_to_process(_calendar(s), T.written_dates(s.spark, f"{path}/sequences", "training"),
                                T.written_dates(s.spark, f"{path}/extracts"))


@query("split_by_date", f"""
SELECT data_date, CASE WHEN row_number() OVER (ORDER BY data_date) <= floor(count(*) OVER () * {P.train_share}e0)
       THEN 'train' ELSE 'evaluate' END AS part FROM calendar""")
def _(s: Stage) -> DataFrame:
    return Cal.split_by_date(_calendar(s), P.train_share)


@query("evaluation_dates", f"SELECT execution_date - {P.horizon} - CAST(unnest(range({P.horizon})) AS INTEGER) AS data_date FROM effective")
def _(s: Stage) -> DataFrame:
    return Cal.evaluation_dates(E.available_dates(s.events), X.EXEC_DATE, P.horizon)


@query("explainer_calendar", " UNION ALL ".join(f"""
SELECT '{name}' AS method, first_date + CAST(unnest(range(CAST(floor((execution_date - (min_date + {P.horizon - 1})) * {share}e0) AS INTEGER))) AS INTEGER) AS data_date
FROM first_day""" for name, share in (("surrogate", 0.8), ("shapley", 0.1))))
def _(s: Stage) -> DataFrame:
    every = None
    for name, share in (("surrogate", 0.8), ("shapley", 0.1)):
        one = Cal.explainer_calendar(E.available_dates(s.events), X.EXEC_DATE, share, P.training_history, P.horizon)
        one = one.select(F.lit(name).alias("method"), "data_date")
        every = one if every is None else every.unionByName(one)
    return every


@query("needs_retrain", f"""
SELECT age AS max_age, latest_run, {d(X.EXEC_DATE)} - latest_run > age AS retrain
FROM (SELECT max(CAST(event_timestamp AS date)) AS latest_run FROM fx_events WHERE event_env = 'purchase') CROSS JOIN (SELECT CAST(unnest([-9, 7]) AS INTEGER) AS age)""")
def _(s: Stage) -> DataFrame:
    day = F.date_format("event_timestamp", C.DATE_FORMAT)
    runs = (s.events.where(F.col("event_env") == C.PURCHASE)
            .select(F.concat(F.lit("run_"), day).alias("name")).distinct())
    one, two = (Cal.needs_retrain(runs, X.EXEC_DATE, age).select(F.lit(age).alias("max_age"), "*") for age in (-9, 7))
    return one.unionByName(two)


@query("purge_old", f"SELECT data_date, count(*) AS n FROM extract_many WHERE data_date >= {d(X.EXEC_DATE - dt.timedelta(days=15))} GROUP BY data_date")
def _(s: Stage) -> DataFrame:
    kept = T.purge_old(s.extract_many, X.EXEC_DATE, 15)
    return kept.groupBy("data_date").agg(F.count("*").alias("n"))


# ---- model

def _sum(i: int) -> str:
    return f"sum(CAST(num[{i + 1}] AS DOUBLE))"


@query("pool_sequences", f"""
SELECT data_date, id, label, CAST(seq_length AS DOUBLE) AS n, {r6('inactivity')} AS inactivity,
       {', '.join(f'{r6(f"max(CASE WHEN step = seq_length - 1 THEN CAST(num[{i + 1}] AS DOUBLE) END)")} AS last_{i}, {r6(_sum(i))} AS total_{i}, {r6(f"{_sum(i)} / seq_length")} AS mean_{i}' for i in range(C.N_INPUT))}
FROM steps GROUP BY data_date, id, label, seq_length, inactivity""")
def _(s: Stage) -> DataFrame:
    at = lambda i: F.get("pooled", F.lit(i))
    n = C.N_INPUT
    return M.pool_sequences(s.examples).select(
        "data_date", "id", "label", at(3 * n).alias("n"), at(3 * n + 1).alias("inactivity"),
        *[at(k * n + i).alias(f"{name}_{i}") for k, name in enumerate(("last", "mean", "total")) for i in range(n)])


@query("fit_classifier")
def _(s: Stage) -> DataFrame:
    scored = M.score(M.fit_classifier(s.examples), s.examples).withColumnRenamed("purchase_proba", "proba")
    return Ev.classification_losses(scored)


_FIXED_SCORED = (f"SELECT data_date, id, {r6(f'1e0 / (1e0 + exp(-(avg({STEP_SCORE}) + any_value({FIXED_SCORE}))))')} "
                 "AS purchase_proba FROM space GROUP BY data_date, id")


@query("score", _FIXED_SCORED)
def _(s: Stage) -> DataFrame:
    return M.score(s.scorer, s.space)


@query("score_fitted")
def _(s: Stage) -> DataFrame:
    return M.score(M.fit_classifier(s.examples), s.examples)


@query("score_with_function", f"SELECT data_date, id, {r6('1e0 / (1e0 + exp(-inactivity))')} AS purchase_proba FROM seqs")
def _(s: Stage) -> DataFrame:
    return M.score_with_function(s.examples, lambda batch: 1.0 / (1.0 + np.exp(-batch["inactivity"])))


@query("write_predictions", f"SELECT id, purchase_proba FROM ({_FIXED_SCORED})")
def _(s: Stage) -> DataFrame:
    path = s.path("predictions")
    T.write_predictions(M.score(s.scorer, s.space), path, X.EXEC_DATE)
    T.write_predictions(M.score(s.scorer, s.space), path, X.EXEC_DATE)  # a second run replaces the first
    return T.read_predictions(s.spark, path, X.EXEC_DATE)


@query("hyperparameter_sweep")
def _(s: Stage) -> DataFrame:
    """Fitted on the first share of the cutoffs, ranked on the others."""
    parts = Cal.split_by_date(s.examples_many.select("data_date").distinct(), 0.8)
    part = lambda name: s.examples_many.join(F.broadcast(parts.where(F.col("part") == name)), "data_date", "left_semi")
    return M.hyperparameter_sweep(part("train"), part("evaluate"), [{"reg_param": 0.01}, {"reg_param": 1.0}, {"reg_param": -1.0}])


@query("classification_losses", f"""
SELECT {r6("avg(-ln(greatest(CASE WHEN label = 1 THEN proba ELSE 1 - proba END, 1e-15)))")} AS cross_entropy,
       {r6("avg(CAST(CAST(proba > 0.5e0 AS INTEGER) <> label AS INTEGER))")} AS error,
       {r6("avg(1 - CAST(CAST(proba > 0.5e0 AS INTEGER) <> label AS INTEGER))")} AS accuracy FROM fx_scored""")
def _(s: Stage) -> DataFrame:
    return Ev.classification_losses(s.scored)


# ---- evaluation

@query("probability_bin", f"SELECT id, {_pbin(10)} AS bin FROM fx_scored")
def _(s: Stage) -> DataFrame:
    return Ev.with_probability_bin(s.scored, 10).select("id", "bin")


def _bins(n: int) -> str:
    return (f"SELECT CAST(i AS INTEGER) AS bin, coalesce(n, 0) AS count, round(round(t, 6), 2) AS proba_true, "
            f"round(round(p, 6), 2) AS proba_pred, {r6('s')} AS std_err FROM generate_series(0, {n - 1}) g(i) LEFT JOIN ("
            f"SELECT {_pbin(n)} AS bin, count(*) AS n, avg(label) AS t, avg(proba) AS p, stddev_pop(proba) AS s "
            f"FROM fx_scored GROUP BY 1) ON bin = i")


@query("calibration_bins", _bins(10))
def _(s: Stage) -> DataFrame:
    return Ev.calibration_bins(s.scored, 10)


@query("calibration_curve", f"SELECT bin, count, proba_true, proba_pred, {r6('proba_pred + s')} AS upper, "
                            f"{r6('proba_pred - s')} AS lower FROM (" + _bins(10).replace(f"{r6('s')} AS std_err", "s")
                            + ") WHERE count > 10")
def _(s: Stage) -> DataFrame:
    return Ev.calibration_curve(s.scored, 10)


@query("brier_score", f"SELECT {r6('avg((proba - label) * (proba - label))')} AS brier FROM fx_scored")
def _(s: Stage) -> DataFrame:
    return Ev.brier_score(s.scored)


@query("class_counts", "SELECT count(*) FILTER (label = 1) AS ones, count(*) FILTER (label = 0) AS zeros FROM fx_scored")
def _(s: Stage) -> DataFrame:
    return Ev.class_counts(s.scored)


@query("roc_curve", f"SELECT {r6('threshold')} AS threshold, {r6('fp / nt')} AS fpr, {r6('tp / pt')} AS tpr FROM thresholds")
def _(s: Stage) -> DataFrame:
    return Ev.roc_curve(s.scored)


@query("roc_auc", f"""
SELECT {r6("sum((fpr - coalesce(f0, 0)) * (tpr + coalesce(t0, 0)) / 2e0)")} AS roc_auc FROM (
  SELECT fpr, tpr, lag(fpr) OVER (ORDER BY threshold DESC) AS f0, lag(tpr) OVER (ORDER BY threshold DESC) AS t0
  FROM (SELECT threshold, fp / nt AS fpr, tp / pt AS tpr FROM thresholds))""")
def _(s: Stage) -> DataFrame:
    return Ev.roc_auc(s.scored)


@query("pr_curve", f"SELECT {r6('threshold')} AS threshold, {r6('tp / (tp + fp)')} AS precision, {r6('tp / pt')} AS recall FROM thresholds "
                   "UNION ALL SELECT NULL, 1e0, 0e0")
def _(s: Stage) -> DataFrame:
    return Ev.pr_curve(s.scored)


@query("pr_thresholds", f"""
SELECT {r6('k / 19e0')} AS threshold, {r6('CASE WHEN n > 0 THEN tp / n END')} AS precision, {r6('tp / pt')} AS recall FROM (
  SELECT k, count(*) FILTER (label = 1 AND proba * 19 >= k) AS tp, count(*) FILTER (proba * 19 >= k) AS n,
         count(*) FILTER (label = 1) AS pt FROM generate_series(0, 19) g(k) CROSS JOIN fx_scored GROUP BY k)""")
def _(s: Stage) -> DataFrame:
    return Ev.pr_thresholds(s.scored)


@query("probability_histogram", f"""
SELECT e.subset, CAST(i AS INTEGER) AS bin, {r6('e.lo + (e.hi - e.lo) * i / 15')} AS left, coalesce(n, 0) AS count
FROM (SELECT subset, min(proba) AS lo, max(proba) AS hi FROM (SELECT 'all' AS subset, proba FROM fx_scored UNION ALL
      SELECT 'label' || CAST(label AS VARCHAR), proba FROM fx_scored) GROUP BY subset) e CROSS JOIN generate_series(0, 14) g(i)
LEFT JOIN (SELECT m.subset, CAST(least(floor((proba - lo) / (hi - lo) * 15), 14) AS INTEGER) AS bin, count(*) AS n
  FROM (SELECT 'all' AS subset, proba FROM fx_scored UNION ALL SELECT 'label' || CAST(label AS VARCHAR), proba FROM fx_scored) m
  JOIN (SELECT subset, min(proba) AS lo, max(proba) AS hi FROM (SELECT 'all' AS subset, proba FROM fx_scored UNION ALL
      SELECT 'label' || CAST(label AS VARCHAR), proba FROM fx_scored) GROUP BY subset) r ON m.subset = r.subset GROUP BY 1, 2) c
ON c.subset = e.subset AND c.bin = i""")
def _(s: Stage) -> DataFrame:
    return Ev.probability_histogram(s.scored)
