"""Shared inputs of the registered queries for one data folder.

Tables that the library stores between its jobs (extract, sequence records, training statistics, the design of
the samples) are written once per session and folder and read back, as its pipelines do.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from harness import fixtures as X
from harness.ctes import FIXED_SCORE, STEP_SCORE
from propensight.functions.scoring import MeanPoolScorer
from propensight.operators import extract as E, features as Fe, perturb as P, sequences as S, shapley as Sh
from propensight.operators import space as Sp, stats as St, surrogate as Su, vocabulary as V
from propensight.session import configure, materialize, shared_dir

SCORER = MeanPoolScorer(STEP_SCORE, FIXED_SCORE)
_stages: dict[tuple[str, str], Stage] = {}


def stage(spark: SparkSession, sf_dir: str) -> Stage:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stages:
        _stages[key] = Stage(spark, sf_dir)
    configure(spark)
    return _stages[key]


class Stage:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir
        self.params, self.cutoff, self.scorer = X.PARAMS, X.CUTOFF, SCORER

    def view(self, name: str) -> DataFrame:
        return X.view(self.spark, self.sf_dir, name)

    @property
    def events(self) -> DataFrame:
        return self.view("fx_events")

    @property
    def visits(self) -> DataFrame:
        return self.view("fx_visits")

    @property
    def products(self) -> DataFrame:
        return self.view("fx_products")

    @property
    def known(self) -> DataFrame:
        return self.view("fx_known")

    @property
    def scored(self) -> DataFrame:
        return self.view("fx_scored")

    def path(self, name: str) -> str:
        """A new folder for a round trip."""
        return f"{shared_dir(self.spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def extract_at(self, cutoff) -> DataFrame:
        return E.retrieve_features(self.events, self.visits, self.products, self.known, cutoff, self.params)

    @cached_property
    def extract(self) -> DataFrame:
        return materialize(self.extract_at(self.cutoff), "extract")

    @cached_property
    def extract_many(self) -> DataFrame:
        return materialize(E.retrieve_features_many(self.events, self.visits, self.products, self.known, X.CUTOFFS,
                                                    self.params), "extracts")

    @property
    def filled(self) -> DataFrame:
        return Fe.fill_missing(Fe.event_date(Fe.delta_time(Fe.normalize_timestamp(self.extract))))

    @cached_property
    def slots(self) -> DataFrame:
        found = None
        for c in ("event_env", "device"):
            values = Fe.distinct_normalized(self.events, self.visits, c).select(F.lit(c).alias("feature"), "value")
            found = values if found is None else found.unionByName(values)
        return materialize(V.grow_slot_map(None, found), "slots")

    @cached_property
    def vocabulary(self) -> DataFrame:
        return materialize(V.grow_vocabulary(None, Fe.fill_missing(self.extract)), "vocabulary")

    @cached_property
    def features(self) -> DataFrame:
        return materialize(Fe.event_features(self.extract, self.vocabulary, self.slots), "features")

    @cached_property
    def examples(self) -> DataFrame:
        return materialize(S.sequence_examples(self.features, self.params.max_len, self.params.horizon), "sequences")

    @cached_property
    def examples_many(self) -> DataFrame:
        """Sequences of all cutoffs."""
        vocabulary = materialize(V.grow_vocabulary(None, Fe.fill_missing(self.extract_many)), "vocabulary-many")
        features = Fe.event_features(self.extract_many, vocabulary, self.slots)
        return materialize(S.sequence_examples(features, self.params.max_len, self.params.horizon), "sequences-many")

    @property
    def steps(self) -> DataFrame:
        return S.step_rows(self.examples)

    @property
    def space(self) -> DataFrame:
        return Sp.to_explainer_space(self.steps)

    @cached_property
    def max_length(self) -> int:
        return Sp.max_sequence_length(self.examples).first()["max_length"]

    @cached_property
    def stats(self) -> DataFrame:
        return materialize(St.column_stats(self.space), "stats")

    @cached_property
    def stats_per_step(self) -> DataFrame:
        return materialize(St.column_stats_per_step(self.space), "stats-per-step")

    @cached_property
    def frequencies(self) -> DataFrame:
        return materialize(St.value_frequencies(self.space), "frequencies")

    @cached_property
    def hierarchy(self) -> DataFrame:
        return materialize(St.product_hierarchy(self.space), "hierarchy")

    @property
    def samples_lazy(self) -> DataFrame:
        return P.neighborhood(self.space, self.stats, self.frequencies, self.hierarchy, self.params.samples,
                              self.params.seed)

    @cached_property
    def samples(self) -> DataFrame:
        return materialize(self.samples_lazy, "samples")

    @property
    def interpretable(self) -> DataFrame:
        return P.interpretable_form(self.samples, self.stats)

    @cached_property
    def design(self) -> DataFrame:
        return materialize(Su.design_rows(self.samples_lazy, self.stats, self.scorer), "design")

    @cached_property
    def slopes(self) -> DataFrame:
        return materialize(Su.single_feature_fit(self.design, self.max_length, self.params.kernel_width), "slopes")

    @cached_property
    def background(self) -> DataFrame:
        return materialize(P.background_set(self.stats_per_step, self.frequencies, self.hierarchy,
                                            self.params.background, self.params.seed), "background")

    @property
    def masked(self) -> DataFrame:
        steps = Sh.with_past_score(self.space, self.scorer)
        rows = Sh.spread_steps(steps, [*Sp.C.SPACE_ALL, "past_score"])
        return Sh.mask_expand(rows, self.background)

    @property
    def coalition_values(self) -> DataFrame:
        return Sh.shap_values_of(self.space, self.background, self.scorer)
