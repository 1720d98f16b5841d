"""Local linear surrogates: what a classifier does around one sequence, as weights of readable features."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from propensight import constants as C
from propensight.config import Params
from propensight.functions.scoring import MeanPoolScorer, sigmoid
from propensight.operators import model as M, moments as M_
from propensight.operators.perturb import neighborhood, with_stats
from propensight.operators.sequences import ID_KEYS
from propensight.operators.space import from_explainer_space
from propensight.operators.stats import FIXED_STEP
from propensight.session import materialize, shuffle_width

SAMPLE_KEYS = ID_KEYS + ["sample"]
BLOCK_KEYS = ID_KEYS + ["block"]
WIDTH = len(C.SPACE_STEP)

FIT_SCHEMA = ("data_date date, id string, label int, kernel_width double, complexity int, n_samples int, step int, "
              "feature string, weight double, x0 double, intercept double, r2 double, local_pred double, "
              "real_pred double")


def score_samples(samples: DataFrame, model, score: Callable = M.score) -> DataFrame:
    """Probabilities ``(p0, p1)`` of every perturbed sequence; they must sum to 1.

    A scorer with given coefficients reads the sample rows; any other model is called by ``score(model, records)``
    on the sequence records made of them.
    """
    if isinstance(model, MeanPoolScorer):
        scored = model.score_steps(samples, SAMPLE_KEYS)
    else:
        scored = score(model, from_explainer_space(samples, SAMPLE_KEYS), SAMPLE_KEYS)
    p0, p1 = 1 - F.col("purchase_proba"), F.col("purchase_proba")
    return with_probability_check(scored.select(*SAMPLE_KEYS, p0.alias("p0"), p1.alias("p1")))


def with_probability_check(scored: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Fail on rows whose probabilities do not sum to 1."""
    ok = F.abs(F.col("p0") + F.col("p1") - 1) < tolerance
    return scored.withColumn("p1", F.when(ok, F.col("p1")).otherwise(
        F.raise_error(F.lit("class probabilities do not sum to 1")).cast("double")))


def _squared_step_distance() -> Column:
    """Distance of an interpretable step to the instance: its categorical cells are all 1."""
    cat = sum((F.lit(1.0) - F.col(f) for f in C.SPACE_CATEGORICAL), F.lit(0.0))
    num = sum((F.pow(F.col(f) - F.col(f"origin.{f}"), F.lit(2.0)) for f in C.SPACE_NUMERIC), F.lit(0.0))
    return cat + num


def with_origin(interpretable: DataFrame) -> DataFrame:
    """Attach the interpretable numeric values of sample 0 to every sample of the same instance and step."""
    numeric = C.SPACE_NUMERIC + C.SPACE_FIXED
    own = interpretable.where(F.col("sample") == 0).select(*ID_KEYS, "step", F.struct(*numeric).alias("origin"))
    return interpretable.join(own, [*ID_KEYS, "step"])


def sample_distances(interpretable: DataFrame) -> DataFrame:
    """Euclidean distance of each sample to sample 0 over all flat columns; the fixed column counts once."""
    rows = with_origin(interpretable)
    fixed = C.SPACE_FIXED[0]
    own = F.first(F.pow(F.col(fixed) - F.col(f"origin.{fixed}"), F.lit(2.0)))
    return rows.groupBy(*SAMPLE_KEYS).agg(F.sqrt(F.sum(_squared_step_distance()) + own).alias("distance"))


def kernel(distance: Column, width: Column | float) -> Column:
    """Exponential kernel."""
    return F.sqrt(F.exp(-(distance * distance) / (F.lit(width) * F.lit(width))))


def kernel_weights(distances: DataFrame, max_length: int, width: float = Params.kernel_width) -> DataFrame:
    """Weight of every sample; the kernel widens with the root of the number of flat columns."""
    scaled = width * math.sqrt(max_length * WIDTH + 1)
    return distances.withColumn("weight", kernel(F.col("distance"), scaled))


class SumMetric:
    """A distance that is a function of sums over the columns, so that it never leaves the JVM: ``terms`` of a column's value and
    the instance's, and ``finish`` of their sums."""

    def __init__(self, terms: Callable[[Column, Column], list[Column]], finish: Callable[..., Column]):
        self.terms, self.finish = terms, finish


def _one_minus_cosine(product: Column, a: Column, b: Column) -> Column:
    return F.when(a * b > 0, 1 - product / F.sqrt(a * b)).otherwise(F.lit(1.0))


METRICS = {"euclidean": SumMetric(lambda x, o: [F.pow(x - o, F.lit(2.0))], F.sqrt),
           "manhattan": SumMetric(lambda x, o: [F.abs(x - o)], lambda total: total),
           "cosine": SumMetric(lambda x, o: [x * o, x * x, o * o], _one_minus_cosine)}
Metric = str | SumMetric | Callable[[np.ndarray, np.ndarray], np.ndarray]


def design_rows(samples: DataFrame, stats: DataFrame, model, score: Callable = M.score, metric: Metric = "euclidean") -> DataFrame:
    """One row per sample with its interpretable vector ``x``, distance and probability.

    The samples are generated once, and blocks of them stay where they were made. With given coefficients, score, distance and vector come from
    the same aggregation; any other model is called by ``score(model, records, keys)`` on the samples as written. The metric is a name,
    a function of sums over the columns, or a function of a batch of vectors and of the instances' vectors.
    """
    given = isinstance(model, MeanPoolScorer)
    if not given:
        samples = materialize(samples, "samples")
    measure = METRICS[metric] if isinstance(metric, str) else metric
    summed = isinstance(measure, SumMetric)
    fixed = C.SPACE_FIXED[0]
    known = with_stats(samples, stats)
    scale = lambda f: F.when(F.col(f"{f}_std") > 0, F.col(f"{f}_std")).otherwise(F.lit(1.0))
    std = lambda f, c: (F.col(c) - F.coalesce(f"{f}_mean", F.lit(0.0))) / scale(f)
    one = F.lit(1.0)
    pairs = [(std(f, f), std(f, f"origin.{f}")) for f in C.SPACE_NUMERIC]
    pairs += [((F.col(f) == F.col(f"origin.{f}")).cast("double"), one) for f in C.SPACE_CATEGORICAL]
    ends = (std(fixed, fixed), std(fixed, f"origin.{fixed}"))
    n_terms = len(measure.terms(one, one)) if summed else 0
    near = [sum((measure.terms(*p)[i] for p in pairs), F.lit(0.0)).alias(f"near_{i}") for i in range(n_terms)]
    gap = [measure.terms(*ends)[i].alias(f"gap_{i}") for i in range(n_terms)]
    vectors = [F.array(*[x for x, _ in pairs]).alias("x")] + ([] if summed else [F.array(*[o for _, o in pairs]).alias("o")])
    rows = known.select(*BLOCK_KEYS, "sample", "step", *vectors, *near, *gap, ends[0].alias("fixed_x"), ends[1].alias("fixed_o"),
                        *([model.step_score().alias("score"), model.fixed_score().alias("fixed_score")] if given else []))
    steps = F.sort_array(F.collect_list(F.struct("step", "x", *([] if summed else ["o"])))).alias("steps")
    distance = [measure.finish(*[F.sum(f"near_{i}") + F.first(f"gap_{i}") for i in range(n_terms)]).alias("distance")] if summed else []
    grouped = rows.groupBy(*BLOCK_KEYS, "sample").agg(
        steps, *distance, F.first("fixed_x").alias("fixed_x"), F.first("fixed_o").alias("fixed_o"),
        *([sigmoid(F.avg("score") + F.first("fixed_score")).alias("p1")] if given else []))
    if not given:
        grouped = grouped.join(score_samples(samples, model, score).select(*SAMPLE_KEYS, "p1"), SAMPLE_KEYS)
    whole = grouped.select(*BLOCK_KEYS, "sample", F.concat(F.flatten("steps.x"), F.array("fixed_x")).alias("x"), "p1", *(
        ["distance"] if summed else [F.concat(F.flatten("steps.o"), F.array("fixed_o")).alias("o")]))
    return (whole if summed else _measured(whole, measure)).select(*BLOCK_KEYS, "sample", "x", "distance", "p1")


def _measured(rows: DataFrame, metric: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Distances by a function, called for the rows of a batch that have vectors of one length."""
    def run(batches):
        for batch in batches:
            distance = np.empty(len(batch))
            for _, at in batch.groupby(batch["x"].map(len)).indices.items():
                distance[at] = metric(np.stack(batch["x"].iloc[at]), np.stack(batch["o"].iloc[at]))
            yield batch.drop(columns="o").assign(distance=distance)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("o").schema)
    return rows.mapInPandas(run, f"{schema}, distance double")


def ridge(x: np.ndarray, y: np.ndarray, w: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Weighted ridge regression with intercept."""
    xc, yc, mx, my = M_.centred(M_.factor(x, y, w), 1)
    beta = M_.ridge(alpha)(xc, yc)[:, 0]
    return beta, float(my[0] - mx @ beta)


def _column_of(index: int, width: int) -> tuple[int, str]:
    """Step and feature of a position of the design vector."""
    if index == width - 1:
        return FIXED_STEP, C.SPACE_FIXED[0]
    return index // WIDTH, C.SPACE_STEP[index % WIDTH]


@cache
def _columns(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Steps and features of all positions."""
    places = [_column_of(i, width) for i in range(width)]
    return np.array([step for step, _ in places]), np.array([feature for _, feature in places], object)


FITS = 256  # fits whose rows leave a task at once
PER_COLUMN = ("step", "feature", "weight", "x0")
ALL_SAMPLES = 2 ** 31 - 1  # a setting may ask for a prefix of the samples
PART_SCHEMA = ("data_date date, id string, first int, kernel_width double, n int, width int, data binary, origin binary, "
               "low double, high double")


def kernel_of(distance: np.ndarray, width: float) -> np.ndarray:
    """Exponential kernel."""
    return np.sqrt(np.exp(-(distance * distance) / (width * width)))


def _parts(group: pd.DataFrame, ends: list[int], widths: list[float], scale: float, kernel: Callable) -> pd.DataFrame:
    """A block of samples, cut where a setting's prefix ends, as factors: one per kernel width where the samples are more than the columns,
    else the samples themselves, which all widths share."""
    group = group.sort_values("sample")
    x, y, distance, sample = np.stack(group["x"].to_numpy()), *(group[c].to_numpy(float) for c in ("p1", "distance")), group["sample"].to_numpy()
    out = []
    for at in np.split(np.arange(len(sample)), np.searchsorted(sample, ends)):
        if not len(at):
            continue
        origin = np.append(x[at[0]], y[at[0]]).tobytes() if sample[at[0]] == 0 else None
        common = {"data_date": group["data_date"].iloc[0], "id": group["id"].iloc[0], "first": int(sample[at[0]]), "n": len(at),
                  "width": x.shape[1], "low": float(y[at].min()), "high": float(y[at].max())}
        if len(at) <= x.shape[1] + 2:
            data = [(None, np.column_stack([distance[at], x[at], y[at]]))]
        else:
            data = [(w, M_.factor(x[at], y[at], kernel(distance[at], w * scale))) for w in widths]
        out += [{**common, "kernel_width": w, "data": d.tobytes(), "origin": origin if i == 0 else None} for i, (w, d) in enumerate(data)]
    return pd.DataFrame(out)[["data_date", "id", "first", "kernel_width", "n", "width", "data", "origin", "low", "high"]]


class _Fits:
    """Moments of one instance's samples so far, and the fits of the settings whose prefix is complete."""

    def __init__(self, key: tuple, settings: list, max_length: int, kernel: Callable, options: dict):
        self.key, self.settings, self.options, self.kernel = key, settings, options, kernel
        self.scale = math.sqrt(max_length * WIDTH + 1)
        self.widths = sorted({w for w, _, _ in settings})
        self.state: dict[float, np.ndarray] = {}
        self.n, self.low, self.high, self.origin = 0, math.inf, -math.inf, None

    def add(self, row) -> None:
        if row.origin is not None:
            self.origin = np.frombuffer(row.origin)
        data = np.frombuffer(row.data).reshape(-1, row.width + 2)
        for w in self.widths if pd.isna(row.kernel_width) else [row.kernel_width]:
            new = data if not pd.isna(row.kernel_width) else M_.factor(data[:, 1:-1], data[:, -1], self.kernel(data[:, 0], w * self.scale))
            self.state[w] = M_.merged([self.state[w], new]) if w in self.state else new
        if pd.isna(row.kernel_width) or row.kernel_width == self.widths[0]:
            self.n += row.n
            self.low, self.high = min(self.low, row.low), max(self.high, row.high)

    def labels(self) -> list[int]:
        if self.options["top_labels"] is None:
            return list(self.options["labels"])
        p = self.origin[-1]
        return [label for _, label in sorted([(p, 1), (1 - p, 0)], reverse=True)][:self.options["top_labels"]]

    def fitted(self, settings: list) -> Iterator[dict]:
        """The columns of one setting and label at a time. Both labels are right-hand sides of one factorisation; settings of one kernel width
        share its centred moments and the order of its columns."""
        x0, y0, labels, o = self.origin[:-1], self.origin[-1], self.labels(), self.options
        sign = np.array([1.0 if label == 1 else -1.0 for label in labels])
        steps, features = _columns(len(x0))
        shared = {}
        for width, complexity, _ in settings:
            if width not in shared:
                x, y, mx, my = M_.centred(self.state[width], 1)
                y, my = y * sign, np.where(sign > 0, my, 1 - my)
                shared[width] = x, y, mx, my, cache(partial(M_.by_weight, x, y[:, 0], x0, o["rank_alpha"], o.get("rank_digits")))
            x, y, mx, my, order = shared[width]
            kept = M_.selected(x, y[:, 0], x0, complexity, o["selection"], o["rank_alpha"], order)
            beta = o["regressor"](x[:, kept], y)
            intercept = my - mx[kept] @ beta
            rest = y - x[:, kept] @ beta
            spread = (y * y).sum(axis=0)
            for i, label in enumerate(labels):
                yield {"data_date": self.key[0], "id": self.key[1], "label": label, "kernel_width": width, "complexity": len(kept),
                       "n_samples": self.n, "step": steps[kept], "feature": features[kept], "weight": beta[:, i], "x0": x0[kept],
                       "intercept": intercept[i], "r2": 1 - (rest[:, i] @ rest[:, i]) / spread[i] if spread[i] > 0 else 0.0,
                       "local_pred": x0[kept] @ beta[:, i] + intercept[i], "real_pred": y0 if label == 1 else 1 - y0,
                       "predicted_value": y0, "min_value": self.low, "max_value": self.high}


def _stacked(fits: list[dict], columns: list[str]) -> pd.DataFrame:
    """One frame of the columns of many fits; what a fit has once is repeated for its rows."""
    n = [len(f["weight"]) for f in fits]
    return pd.DataFrame({c: np.concatenate([f[c] for f in fits]) if c in PER_COLUMN else pd.Series([f[c] for f in fits]).repeat(n).to_numpy()
                         for c in columns})


def local_linear_fit(design: DataFrame, max_length: int, settings: list[tuple[float, int | None, int]] | None = None,
                     label: int | tuple[int, ...] = 1, alpha: float = 1.0, rank_alpha: float = 0.01, selection: str = "highest_weights",
                     regressor: M_.Regressor | None = None, kernel: Callable[[np.ndarray, float], np.ndarray] = kernel_of,
                     top_labels: int | None = None, mode: str = "classification", rank_digits: int | None = None) -> DataFrame:
    """Weighted linear fit of the probability per instance, for each ``(kernel width, complexity, samples)``.

    Blocks of samples become mergeable moments in the tasks that hold them. The parts of an instance come to one task in order of their samples and
    are merged one by one: the state is at most as many rows as columns, whatever the number of samples, and is solved wherever the
    prefix of a setting ends. Columns are chosen by ``selection`` (see ``moments.selected``; with ``rank_digits``, highest weights that are equal
    to so many decimals go by position), the weights come from ``regressor`` (ridge with ``alpha``). Labels are given, or the ``top_labels`` most probable ones of the instance; ``mode="regression"`` explains the
    value itself, with its opposite as label 0, and adds the predicted value and the range over the samples.
    """
    settings = settings or [(Params.kernel_width, None, ALL_SAMPLES)]
    labels = (1, 0) if mode == "regression" else (label,) if isinstance(label, int) else tuple(label)
    options = {"labels": labels, "top_labels": top_labels, "selection": selection, "rank_alpha": rank_alpha, "rank_digits": rank_digits,
               "regressor": regressor or M_.ridge(alpha)}
    ends = sorted({n for _, _, n in settings})
    widths, scale = sorted({w for w, _, _ in settings}), math.sqrt(max_length * WIDTH + 1)
    columns = [c.split()[0] for c in FIT_SCHEMA.split(", ")] + (["predicted_value", "min_value", "max_value"] if mode == "regression" else [])

    def parts(group: pd.DataFrame) -> pd.DataFrame:
        return _parts(group, ends, widths, scale, kernel)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, todo = None, []

        def solved(until: float) -> list[dict]:
            now = [s for s in todo if s[2] <= until]
            todo[:] = [s for s in todo if s[2] > until]
            return list(own.fitted(now)) if now else []

        out = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                key = (row.data_date, row.id)
                if own is None or own.key != key:
                    out += solved(math.inf) if own else []
                    own, todo = _Fits(key, settings, max_length, kernel, options), list(settings)
                else:
                    out += solved(row.first)
                own.add(row)
                if len(out) >= FITS:
                    yield _stacked(out, columns)
                    out = []
        out += solved(math.inf) if own else []
        if out:
            yield _stacked(out, columns)

    made = (design.where(F.col("sample") < ends[-1]).select(*BLOCK_KEYS, "sample", "x", "p1", "distance")
            .groupBy(*BLOCK_KEYS).applyInPandas(parts, PART_SCHEMA))
    ordered = made.repartition(shuffle_width(design), *ID_KEYS).sortWithinPartitions(*ID_KEYS, "first", "kernel_width")
    extra = ", predicted_value double, min_value double, max_value double" if mode == "regression" else ""
    return ordered.mapInPandas(run, FIT_SCHEMA + extra)


def _weighted_sums(batches: Iterator[pd.DataFrame], scaled: float) -> Iterator[pd.DataFrame]:
    """One row per instance of a batch: the weighted sums of its samples, and the values of sample 0 (NaN where it is elsewhere)."""
    for batch in batches:
        out = []
        for _, at in batch.groupby([*ID_KEYS, batch["x"].map(len)], dropna=False, sort=False).indices.items():
            own = batch.iloc[at]
            x, y, w = np.stack(own["x"].to_numpy()), own["p1"].to_numpy(float), kernel_of(own["distance"].to_numpy(float), scaled)
            x0 = np.append(x[own["sample"].to_numpy() == 0], np.full((1, x.shape[1]), np.nan), axis=0)
            out.append((own["data_date"].iloc[0], own["id"].iloc[0], w.sum(), w @ y,
                        np.stack([w @ x, w @ (x * x), (w * y) @ x, np.fmax.reduce(x0)]).tobytes()))
        yield pd.DataFrame(out, columns=["data_date", "id", "sw", "sy", "sums"])


def _slopes(batches: Iterator[pd.DataFrame], alpha: float) -> Iterator[pd.DataFrame]:
    """Slopes and intercepts of the instances of rows that come in order of their instance."""
    own, out = None, []

    def ended() -> tuple:
        key, sw, sy, (sx, sxx, sxy, x0) = own
        weight = (sxy - sx * sy / sw) / (sxx - sx * sx / sw + alpha)
        return *key, weight, x0, (sy - sx * weight) / sw

    frame = lambda rows: pd.DataFrame(rows, columns=["data_date", "id", "weight", "x0", "intercept"])
    for batch in batches:
        for row in batch.itertuples(index=False):
            key, sums = (row.data_date, row.id), np.frombuffer(row.sums).reshape(4, -1)
            if own is not None and own[0] == key:
                before = own[3]
                own = key, own[1] + row.sw, own[2] + row.sy, np.vstack([before[:3] + sums[:3], np.fmax(before[3:], sums[3:])])
                continue
            if own is not None:
                out.append(ended())
            own = key, row.sw, row.sy, sums
            if len(out) >= FITS:
                yield frame(out)
                out = []
    if own is not None:
        yield frame([*out, ended()])


def single_feature_fit(design: DataFrame, max_length: int, width: float = Params.kernel_width,
                       alpha: float = 1.0) -> DataFrame:
    """Weighted ridge slope of every column on its own, in closed form from moment sums.

    The sums of a column are places of one row per instance and batch of samples, so no row is made per sample and column. Only these rows are
    shuffled; a row per column is made of the instance's slopes at the end.
    """
    scaled = width * math.sqrt(max_length * WIDTH + 1)
    key = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in design.select(*ID_KEYS).schema)
    sums = (design.select(*ID_KEYS, "sample", "x", "p1", "distance")
            .mapInPandas(lambda batches: _weighted_sums(batches, scaled), f"{key}, sw double, sy double, sums binary"))
    ordered = sums.repartition(shuffle_width(design), *ID_KEYS).sortWithinPartitions(*ID_KEYS)
    fitted = ordered.mapInPandas(lambda batches: _slopes(batches, alpha), f"{key}, weight array<double>, x0 array<double>, intercept array<double>")
    long = fitted.select(*ID_KEYS, F.size("weight").alias("_n"), F.posexplode(F.arrays_zip("weight", "x0", "intercept")).alias("_i", "_s"))
    fixed = F.col("_i") == F.col("_n") - 1
    name = F.when(fixed, C.SPACE_FIXED[0]).otherwise(
        F.get(F.array(*[F.lit(f) for f in C.SPACE_STEP]), F.col("_i") % WIDTH))
    step = F.when(fixed, FIXED_STEP).otherwise(F.floor(F.col("_i") / WIDTH)).cast("int")
    known = lambda c: F.when(~F.isnan(f"_s.{c}"), F.col(f"_s.{c}")).alias(c)
    return long.select(*ID_KEYS, step.alias("step"), name.alias("feature"), known("weight"), known("x0"), known("intercept"))


def _instance_window():
    return W.partitionBy(*ID_KEYS)


def select_features(design: DataFrame, max_length: int, k: int, width: float = Params.kernel_width, alpha: float = 1.0,
                    rank_alpha: float = 0.01) -> DataFrame:
    """The ``k`` columns of each instance with the largest contribution ``|weight * x0|`` in the ridge fit of all columns together, with their
    weights in the refit on these columns alone, placed by their contribution there.

    Both fits are solved from the merged moments of the instance, so only ``k`` rows per instance leave its task.
    """
    refit = local_linear_fit(design, max_length, [(width, k, ALL_SAMPLES)], alpha=alpha, rank_alpha=rank_alpha, rank_digits=9)
    size = F.abs(F.col("weight") * F.col("x0"))
    return refit.withColumn("place", F.row_number().over(_instance_window().orderBy(F.round(size, 9).desc(), "step", "feature")))


def top_labels(scored: DataFrame, m: int) -> DataFrame:
    """Labels of the instance (sample 0) by descending probability."""
    own = scored.where(F.col("sample") == 0).unpivot(ID_KEYS, ["p0", "p1"], "_name", "proba")
    own = own.select(*ID_KEYS, F.substring("_name", 2, 1).cast("int").alias("label"), "proba")
    place = F.row_number().over(_instance_window().orderBy(F.col("proba").desc(), F.col("label").desc()))
    return own.withColumn("place", place).where(F.col("place") <= m)


def regression_mode(scored: DataFrame, target: str = "p1") -> DataFrame:
    """Predicted value of the instance, and the smallest and largest over its samples."""
    return scored.groupBy(*ID_KEYS).agg(
        F.max(F.when(F.col("sample") == 0, F.col(target))).alias("predicted_value"),
        F.min(target).alias("min_value"), F.max(target).alias("max_value"))


def both_labels(explained: DataFrame) -> DataFrame:
    """Explanations of label 1 and, with opposite weights, of label 0."""
    one = explained.withColumn("label", F.lit(1))
    return one.unionByName(one.withColumns({"label": F.lit(0), "weight": -F.col("weight")}))


def _ranked(df: DataFrame, k: int | None, *ties: str) -> DataFrame:
    size = F.round(F.abs("weight"), 9).desc()
    ranked = df.withColumn("place", F.row_number().over(_instance_window().orderBy(size, *ties)))
    return ranked if k is None else ranked.where(F.col("place") <= k)


def explain_top(explained: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest weights of each instance, with their sign."""
    sign = F.when(F.col("weight") > 0, "positive").otherwise("negative")
    return _ranked(explained.select(*ID_KEYS, "step", "feature", "weight"), k, "step", "feature").withColumn("sign", sign)


def explain_by_feature(explained: DataFrame, k: int | None = None) -> DataFrame:
    """Weights of each feature summed over the steps, largest first."""
    return _ranked(explained.groupBy(*ID_KEYS, "feature").agg(F.sum("weight").alias("weight")), k, "feature")


def explain_by_family(explained: DataFrame, k: int | None = None) -> DataFrame:
    """Weights summed over families of features, largest first."""
    family = F.col("feature")
    for name, group in C.FAMILIES.items():
        family = F.when(F.col("feature") == name, group).otherwise(family)
    summed = explained.groupBy(*ID_KEYS, family.alias("family")).agg(F.sum("weight").alias("weight"))
    return _ranked(summed, k, "family")


def explain_summary(explained: DataFrame) -> DataFrame:
    """One line per explanation: local and real prediction, bias, fit quality, samples and steps."""
    return explained.groupBy(*ID_KEYS, "label", "kernel_width", "complexity", "n_samples").agg(
        F.first("local_pred").alias("local_pred"), F.first("intercept").alias("bias"),
        F.first("real_pred").alias("real_pred"), F.first("r2").alias("r2"),
        (F.max("step") + 1).alias("n_steps"))


def explain_instances(instances: DataFrame, stats: DataFrame, freq: DataFrame, hierarchy: DataFrame,
                      model, max_length: int, params: Params = Params(), complexity: int | None = None, label: int | tuple[int, ...] = 1,
                      score: Callable = M.score, metric: Metric = "euclidean", **fit) -> DataFrame:
    """Explanations of a table of instances (explainer rows). ``fit`` goes to ``local_linear_fit``: selection, regressor, kernel,
    top_labels, mode."""
    samples = neighborhood(instances, stats, freq, hierarchy, params.samples, params.seed)
    return local_linear_fit(design_rows(samples, stats, model, score, metric), max_length,
                            [(params.kernel_width, complexity, params.samples)], label, **fit)


def explain_sweep(instances: DataFrame, stats: DataFrame, freq: DataFrame, hierarchy: DataFrame,
                  model, max_length: int, kernels: list[float], complexities: list[int], samples: list[int],
                  seed: int = Params.seed, label: int | tuple[int, ...] = 1, score: Callable = M.score, metric: Metric = "euclidean", **fit) -> DataFrame:
    """Every combination of kernel width, complexity and sample size, from one set of draws."""
    drawn = neighborhood(instances, stats, freq, hierarchy, max(samples), seed)
    return local_linear_fit(design_rows(drawn, stats, model, score, metric), max_length,
                            list(itertools.product(kernels, complexities, samples)), label, **fit)
