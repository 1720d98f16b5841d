"""The jobs of the library over one store: prepare sequences, train, predict, evaluate, explain.

A store is a folder of the shared file system. What one job writes the next reads, so every job starts from
tables on disk, can be repeated, and survives the loss of executors.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from propensight import constants as C
from propensight.config import Params
from propensight.operators import calendar as Cal, evaluate as Ev, extract as E, features as Fe, model as M
from propensight.operators import perturb as Pe, sequences as S, shapley as Sh, space as Sp, stats as St
from propensight.operators import surrogate as Su, vocabulary as V
from propensight.session import configure, materialize
from propensight.sources import tables as T

RUN_PREFIX = "run_"
DATES_PER_JOB = 20


@dataclass(frozen=True)
class Store:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


@dataclass(frozen=True)
class Inputs:
    events: DataFrame
    visits: DataFrame
    products: DataFrame
    known: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Inputs:
        return cls(*[T.scan_source(spark, path, n) for n in ("events", "visits", "products", "known_ids")])



def _no_dates(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(F.current_date().alias("data_date"))


def _written(spark: SparkSession, path: str, purpose: str | None = None) -> DataFrame:
    return T.written_dates(spark, path, purpose) if T.path_exists(spark, path) else _no_dates(spark)


def _dates(df: DataFrame) -> list[dt.date]:
    """A planned calendar as a list: at most one entry per day of the training history."""
    return sorted(r["data_date"] for r in df.select("data_date").collect())


def _grown_vocabulary(spark: SparkSession, store: Store, extract: DataFrame) -> DataFrame:
    path = store.path("vocabulary")
    old = T.read_vocabulary(spark, path) if T.newest_version(spark, path) else None
    grown = materialize(V.grow_vocabulary(old, Fe.fill_missing(extract)), "vocabulary")
    T.write_vocabulary(grown, path)
    return grown


def _grown_slots(spark: SparkSession, store: Store, spec: DataFrame) -> DataFrame:
    path = store.path("slots")
    old = T.read_slot_map(spark, path) if T.newest_version(spark, path) else None
    lists = [spec.select(F.lit(c).alias("feature"), F.explode(f"values_{c}").alias("value")) for c in C.INDICATOR_COLUMNS]
    grown = materialize(V.grow_slot_map(old, lists[0].unionByName(lists[1])), "slots")
    T.write_slot_map(grown, path)
    return grown


def prepare(inputs: Inputs, store: Store, execution_date: dt.date, action: str = "train",
            params: Params = Params(), known_only: bool = True, last_only: bool = False,
            unknown: str = "error") -> list[dt.date]:
    """Write the sequences of all dates the action needs and that are not there yet; returns these dates.

    Dates are processed in blocks, which bounds how often an event is copied within one job.
    """
    spark = configure(inputs.events.sparkSession)
    purpose = "prediction" if action == "predict" else "training"
    available = materialize(E.available_dates(inputs.events), "dates")
    gaps = Cal.missing_days(available, execution_date, params.training_history, params.max_missing).first()
    if gaps is not None and gaps["abort"]:
        raise ValueError(f"{gaps['n_missing']} days of the training history have no data")
    calendar = Cal.training_calendar(available, execution_date, action, params.training_history, params.horizon, last_only)
    todo = _dates(Cal.dates_to_process(calendar, _written(spark, store.path("sequences"), purpose),
                                       _written(spark, store.path("extracts"))))
    spec = T.freeze_feature_spec(inputs.events, inputs.visits, inputs.products, store.path("spec"))
    for start in range(0, len(todo), DATES_PER_JOB):
        block = todo[start:start + DATES_PER_JOB]
        lacking = sorted(set(block) - set(_dates(_written(spark, store.path("extracts")))))
        if lacking:
            T.write_extract(E.retrieve_features_many(inputs.events, inputs.visits, inputs.products, inputs.known,
                                                     lacking, params, known_only), store.path("extracts"))
        extract = T.read_extract(spark, store.path("extracts"), block)
        features = Fe.event_features(extract, _grown_vocabulary(spark, store, extract),
                                     _grown_slots(spark, store, spec), unknown=unknown)
        T.write_sequences(S.sequence_examples(features, params.max_len, params.horizon),
                          store.path("sequences"), purpose)
    return todo


def model_runs(spark: SparkSession, store: Store) -> DataFrame:
    """Names of the stored models."""
    path = store.path("models")
    names = []
    if T.path_exists(spark, path):
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        names = [s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    return V.constant_table(spark, [(n,) for n in names] or [("",)], ["name"])


def check_model(spark: SparkSession, store: Store, execution_date: dt.date, max_age: int) -> bool:
    """Whether a new model has to be trained."""
    return Cal.needs_retrain(model_runs(spark, store), execution_date, max_age).first()["retrain"]


def split_days(spark: SparkSession, store: Store, execution_date: dt.date, params: Params) -> tuple[list[dt.date], list[dt.date]]:
    """Days to fit on and days held out.

    Days count from the training history up to the last one whose labels were complete at the execution date, whatever
    else is stored.
    """
    day, end = F.col("data_date"), F.lit(execution_date)
    known = T.written_dates(spark, store.path("sequences"), "training").where(
        (day <= F.date_sub(end, params.horizon)) & (day > F.date_sub(end, params.training_history + 1)))
    parts = Cal.split_by_date(known, params.train_share).collect()
    first, rest = ([r["data_date"] for r in parts if r["part"] == part] for part in ("train", "evaluate"))
    if not first or not rest:
        raise ValueError(f"{len(parts)} prepared days up to {execution_date} do not give training and held-out days")
    return first, rest


def train(spark: SparkSession, store: Store, execution_date: dt.date, params: Params = Params(), **fit) -> DataFrame:
    """Fit on the first share of the prepared days, store the model, and return its losses on the others."""
    path = store.path("sequences")
    days, held_out = split_days(spark, store, execution_date, params)
    model = M.fit_classifier(T.read_sequences(spark, path, days), **fit)
    model.write().overwrite().save(store.path(f"models/{RUN_PREFIX}{execution_date:%Y%m%d}"))
    scored = M.score(model, T.read_sequences(spark, path, held_out)).withColumnRenamed("purchase_proba", "proba")
    return Ev.classification_losses(scored)


def sweep(spark: SparkSession, store: Store, execution_date: dt.date, grid: list[dict], params: Params = Params()) -> DataFrame:
    """Loss of every parameter set on the held-out days, best first; `train` takes the best as its arguments."""
    path = store.path("sequences")
    days, held_out = split_days(spark, store, execution_date, params)
    return M.hyperparameter_sweep(T.read_sequences(spark, path, days), T.read_sequences(spark, path, held_out), grid)


def latest_model(spark: SparkSession, store: Store, execution_date: dt.date) -> PipelineModel:
    """The newest model that is not later than the date."""
    stamp = F.regexp_extract("name", "([0-9]{8})$", 1)
    name = model_runs(spark, store).where((stamp != "") & (stamp <= f"{execution_date:%Y%m%d}")).agg(F.max_by("name", stamp)).first()[0]
    if name is None:
        raise FileNotFoundError(f"no model up to {execution_date}")
    return PipelineModel.load(store.path(f"models/{name}"))


def predict(spark: SparkSession, store: Store, execution_date: dt.date, data_date: dt.date | None = None) -> DataFrame:
    """Score all sequences of the date with the latest model and store the predictions.

    ``prepare`` moves the date back by a day where the data ends the day before; so does this.
    """
    wanted = [data_date] if data_date else [execution_date, execution_date - dt.timedelta(days=1)]
    stored = _written(spark, store.path("sequences"), "prediction").where(F.col("data_date").isin(wanted))
    day = stored.agg(F.max("data_date")).first()[0]
    if day is None:
        raise ValueError(f"no sequences to predict for {wanted[0]}: run prepare first")
    examples = T.read_sequences(spark, store.path("sequences"), [day], "prediction")
    path = store.path("predictions")
    T.write_predictions(M.score(latest_model(spark, store, execution_date), examples), path, execution_date)
    return T.read_predictions(spark, path, execution_date)


def evaluate(spark: SparkSession, store: Store, available: DataFrame, execution_date: dt.date,
             params: Params = Params()) -> dict[str, DataFrame]:
    """Evaluation tables over the most recent dates with complete labels."""
    days = _dates(Cal.evaluation_dates(available, execution_date, params.horizon))
    examples = T.read_sequences(spark, store.path("sequences"), days)
    scored = M.score(latest_model(spark, store, execution_date), examples).withColumnRenamed("purchase_proba", "proba")
    scored = materialize(scored.select("id", "label", "proba"), "scored")
    return {"calibration": Ev.calibration_bins(scored, params.calibration_bins),
            "calibration_curve": Ev.calibration_curve(scored, params.calibration_bins),
            "brier": Ev.brier_score(scored), "class_counts": Ev.class_counts(scored),
            "roc": Ev.roc_curve(scored), "roc_auc": Ev.roc_auc(scored), "precision_recall": Ev.pr_curve(scored),
            "histogram": Ev.probability_histogram(scored, params.histogram_bins),
            "losses": Ev.classification_losses(scored)}


def build_statistics(examples: DataFrame, store: Store) -> None:
    """Store what the explainers need of the training sequences."""
    space = Sp.to_explainer_space(S.step_rows(examples))
    tables = {"stats": St.column_stats(space), "stats_per_step": St.column_stats_per_step(space),
              "frequencies": St.value_frequencies(space), "hierarchy": St.product_hierarchy(space),
              "max_length": Sp.max_sequence_length(examples)}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(store.path(f"explainer/{name}"))


def add_daily_statistics(spark: SparkSession, store: Store, dates: list[dt.date], purpose: str = "training") -> list[dt.date]:
    """Store partial statistics of the dates that have none yet; only the sequences of these dates are read. Returns them."""
    path = store.path("daily/moments")
    lacking = sorted(set(dates) - set(_dates(_written(spark, path))))
    if lacking:
        space = Sp.to_explainer_space(S.step_rows(T.read_sequences(spark, store.path("sequences"), lacking, purpose)))
        T.write_dated(St.daily_value_counts(space), store.path("daily/values"), ["data_date"])
        T.write_dated(St.daily_moments(space), path, ["data_date"])
    return lacking


def merge_daily_statistics(spark: SparkSession, store: Store, dates: list[dt.date]) -> dict[str, DataFrame]:
    """Statistics and frequencies of the dates together, from their partial statistics alone."""
    return {"stats": St.merged_moments(T.read_dated(spark, store.path("daily/moments"), dates)),
            "frequencies": St.merged_frequencies(T.read_dated(spark, store.path("daily/values"), dates))}


def explainer_statistics(spark: SparkSession, store: Store, available: DataFrame, **calendar) -> dict[str, DataFrame]:
    """Statistics over the explainer calendar: days that came since the last call are added, older ones are not read again."""
    days = _dates(Cal.explainer_calendar(available, **calendar))
    written = set(_dates(_written(spark, store.path("sequences"), "training")))
    days = [d for d in days if d in written]
    add_daily_statistics(spark, store, days)
    return merge_daily_statistics(spark, store, days)


def _statistics(spark: SparkSession, store: Store, name: str) -> DataFrame:
    return spark.read.parquet(store.path(f"explainer/{name}"))


def explain_surrogate(examples: DataFrame, store: Store, model, params: Params = Params(),
                      complexity: int | None = None, label: int = 1) -> DataFrame:
    """Explain the model's scores of a table of sequences by local linear surrogates and store the weights.

    The model is a stored pipeline, a function of batches of records or a scorer with given coefficients.
    """
    spark = examples.sparkSession
    space = Sp.to_explainer_space(S.step_rows(examples))
    longest = _statistics(spark, store, "max_length").first()[0]
    explained = Su.explain_instances(space, *[_statistics(spark, store, n) for n in ("stats", "frequencies", "hierarchy")],
                                     model, longest, params, complexity, label)
    path = store.path("explanations")
    T.write_explanations(explained, path)
    return spark.read.parquet(path)


def build_background(spark: SparkSession, store: Store, params: Params = Params()) -> None:
    """Store the background rows Shapley values are measured against."""
    background = Pe.background_set(*[_statistics(spark, store, n) for n in ("stats_per_step", "frequencies", "hierarchy")],
                                   params.background, params.seed)
    background.write.mode("overwrite").parquet(store.path("explainer/background"))


def explain_shapley(examples: DataFrame, store: Store, model, label: int = 1) -> DataFrame:
    """Shapley values of every step of a table of sequences, for any model; needs a stored background."""
    spark = examples.sparkSession
    if not T.path_exists(spark, store.path("explainer/background")):
        raise FileNotFoundError("no background rows: run build_background first")
    space = Sp.to_explainer_space(S.step_rows(examples))
    background = _statistics(spark, store, "background")
    path = store.path("shapley")
    T.write_explanations(Sh.shap_instances(space, background, model, label=label), path)
    return spark.read.parquet(path)


def purge(spark: SparkSession, store: Store, execution_date: dt.date, days: int = Params.retention) -> list[str]:
    """Remove extracts and sequences older than the retention."""
    places = ["extracts"] + [f"sequences/purpose={p}" for p in ("training", "prediction")]
    return [d for place in places if T.path_exists(spark, store.path(place))
            for d in T.drop_old_dates(spark, store.path(place), execution_date, days)]
