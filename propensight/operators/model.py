"""Fit, score and select classifiers on pooled sequences with MLlib."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, functions as F

from propensight import constants as C
from propensight.functions.scoring import MeanPoolScorer
from propensight.operators.evaluate import classification_losses
from propensight.operators.sequences import ID_KEYS
from propensight.session import materialize

FAILED_LOSS = 1e9


def pool_sequences(examples: DataFrame, keys: list[str] = ID_KEYS) -> DataFrame:
    """A vector of fixed length per sequence: last step, means, sums, length and inactivity. Nothing is shuffled."""
    label = ["label"] if "label" in examples.columns else []
    add = lambda s, v: F.zip_with(s, v, lambda x, y: x + F.coalesce(y.cast("double"), F.lit(0.0)))
    pooled = examples.withColumn("_total", F.aggregate("inputs_num", F.array_repeat(F.lit(0.0), C.N_INPUT), add))
    last = F.element_at("inputs_num", -1).cast("array<double>")
    mean = F.transform("_total", lambda s: s / F.col("seq_length"))
    rest = F.array(F.col("seq_length").cast("double"), F.col("inactivity").cast("double"))
    return pooled.select(*keys, *label, F.concat(last, mean, "_total", rest).alias("pooled"))


def pooled_table(examples: DataFrame, keys: list[str] = ID_KEYS) -> DataFrame:
    """Pooled sequences, written once for all passes of a fit and all fits of a sweep."""
    return materialize(pool_sequences(examples, keys), "pooled")


def fit_pooled(pooled: DataFrame, reg_param: float = 0.01, elastic_net: float = 0.0, max_iter: int = 50) -> PipelineModel:
    """Two-class logistic classifier with cross-entropy loss on standardised pooled sequences."""
    stages = [StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
              LogisticRegression(featuresCol="scaled", labelCol="label", regParam=reg_param,
                                 elasticNetParam=elastic_net, maxIter=max_iter, family="binomial")]
    return Pipeline(stages=stages).fit(pooled.select(array_to_vector("pooled").alias("features"), F.col("label").cast("double").alias("label")))


def fit_classifier(examples: DataFrame, reg_param: float = 0.01, elastic_net: float = 0.0,
                   max_iter: int = 50) -> PipelineModel:
    return fit_pooled(pooled_table(examples), reg_param, elastic_net, max_iter)


def score(model: PipelineModel | MeanPoolScorer | Callable, examples: DataFrame, keys: list[str] = ID_KEYS) -> DataFrame:
    """Probability of a purchase for every sequence.

    A classifier of this module and a function of batches read sequence records; a scorer with given coefficients
    reads explainer rows.
    """
    if isinstance(model, MeanPoolScorer):
        return model.score_steps(examples, keys)
    if not isinstance(model, PipelineModel):
        return score_with_function(examples, model, keys)
    return score_pooled(model, pool_sequences(examples, keys), keys)


def score_pooled(model: PipelineModel, pooled: DataFrame, keys: list[str] = ID_KEYS) -> DataFrame:
    scored = model.transform(pooled.withColumn("features", array_to_vector("pooled")))
    label = ["label"] if "label" in pooled.columns else []
    return scored.select(*keys, *label, F.get(vector_to_array("probability"), F.lit(1)).alias("purchase_proba"))


def score_with_function(examples: DataFrame, predict: Callable[[pd.DataFrame], pd.Series],
                        keys: list[str] = ID_KEYS) -> DataFrame:
    """Probability by any function of a batch of sequence records; batches stay where Spark put them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[keys].copy()
            out["purchase_proba"] = predict(batch).astype("float64").to_numpy()
            yield out

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in examples.select(*keys).schema)
    return examples.mapInPandas(run, f"{schema}, purchase_proba double")


def hyperparameter_sweep(train: DataFrame, evaluation: DataFrame, grid: list[dict]) -> DataFrame:
    """Loss of every parameter set on sequences it was not fitted on, best first; a fit that fails counts as a huge loss.

    Both parts are pooled once.
    """
    spark, rows = train.sparkSession, []
    fitted, held_out = pooled_table(train), pooled_table(evaluation)
    for params in grid:
        try:
            scored = score_pooled(fit_pooled(fitted, **params), held_out).withColumnRenamed("purchase_proba", "proba")
            loss = classification_losses(scored).first()["cross_entropy"]
        except (IllegalArgumentException, TypeError, ValueError):  # parameters that the fit refuses; a lost cluster is an error
            loss = None
        rows.append((json.dumps(params, sort_keys=True), FAILED_LOSS if loss is None or loss != loss else float(loss)))
    return spark.createDataFrame(rows, "params string, loss double").orderBy("loss", "params")
