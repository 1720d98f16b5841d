"""Classifiers with given coefficients, written as SQL expressions over explainer columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SATURATED = 1e-15


@dataclass(frozen=True)
class MeanPoolScorer:
    """Logistic function of the mean step score plus a score of the fixed feature."""

    step: str
    fixed: str

    def step_score(self) -> Column:
        return F.expr(self.step)

    def fixed_score(self) -> Column:
        return F.expr(self.fixed)

    def score_steps(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """``purchase_proba`` per key from one row per step; steps of a key are combined map-side."""
        logit = F.avg(self.step_score()) + F.first(self.fixed_score())
        return rows.groupBy(*keys).agg(sigmoid(logit).alias("purchase_proba"))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(p: Column) -> Column:
    """Finite also for models that return exactly 0 or 1."""
    inside = F.greatest(F.lit(SATURATED), F.least(F.lit(1.0 - SATURATED), p))
    return F.ln(inside / (F.lit(1.0) - inside))
