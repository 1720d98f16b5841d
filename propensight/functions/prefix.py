"""Scorers that read a sequence step by step, so that all its prefixes are scored in one ordered pass.

``start()`` gives the state before the first step, ``step(state, num, cat)`` the states after one more step for a batch of rows (a state of one
row goes on with each of them), ``finish(state, length, inactivity)`` the probabilities of the sequences that end there.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from functools import cached_property
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pandas.api.extensions import ExtensionArray, ExtensionDtype
from pandas.api.indexers import check_array_indexer
from pyspark.ml import PipelineModel

from propensight import constants as C


class PrefixScorer(Protocol):
    def start(self) -> Any: ...

    def step(self, state: Any, num: np.ndarray, cat: np.ndarray) -> Any: ...

    def finish(self, state: Any, length: int, inactivity: np.ndarray) -> np.ndarray: ...


class PooledPrefix:
    """A linear classifier on pooled sequences: the state is the sum so far and the last step."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = np.asarray(weights, float), float(bias)

    @classmethod
    def of(cls, model: PipelineModel) -> PooledPrefix:
        """From a fitted standardisation and logistic regression."""
        scaler, linear = model.stages
        std = scaler.std.toArray()
        weights = np.divide(linear.coefficients.toArray(), std, out=np.zeros(len(std)), where=std > 0)
        return cls(weights, linear.intercept - weights @ scaler.mean.toArray())

    def start(self):
        return np.zeros((1, C.N_INPUT)), np.zeros((1, C.N_INPUT))

    def step(self, state, num, cat):
        return state[0] + num, num

    def finish(self, state, length, inactivity):
        total, last = state
        n = C.N_INPUT
        rest = length * self.weights[3 * n] + inactivity * self.weights[3 * n + 1]
        score = last @ self.weights[:n] + total @ (self.weights[n:2 * n] / length + self.weights[2 * n:3 * n]) + rest + self.bias
        return 1 / (1 + np.exp(-score))


class MatrixDtype(ExtensionDtype):
    """Of a column of matrices."""

    name, type, na_value = "matrix", np.ndarray, None

    @classmethod
    def construct_array_type(cls):
        return Matrices


class Matrices(ExtensionArray):
    """A column of matrices of one shape: first rows that all of them share (rows x inputs), then their own (values x rows x inputs).

    The shared rows are held once. The matrices are written out as parts of one block when the first of them is asked for.
    """

    def __init__(self, shared: np.ndarray, own: np.ndarray):
        self.shared, self.own = shared, own

    @cached_property
    def block(self) -> np.ndarray:
        n = len(self.shared)
        block = np.empty((len(self.own), n + self.own.shape[1], self.own.shape[2]), self.own.dtype)
        block[:, :n], block[:, n:] = self.shared, self.own
        return block

    @classmethod
    def _from_sequence(cls, scalars, *, dtype=None, copy=False):
        block = np.stack(list(scalars))
        return cls(block[0, :0], block)

    @classmethod
    def _concat_same_type(cls, to_concat):
        return cls._from_sequence(itertools.chain.from_iterable(to_concat))

    @property
    def dtype(self):
        return MatrixDtype()

    @property
    def nbytes(self):
        return self.shared.nbytes + self.own.nbytes

    def __len__(self):
        return len(self.own)

    def __getitem__(self, item):
        item = check_array_indexer(self, item)
        return self.block[item] if isinstance(item, (int, np.integer)) else type(self)(self.shared, self.own[item])

    def __iter__(self):
        return iter(self.block)

    def __array__(self, dtype=None, copy=None):
        out = np.empty(len(self), object)
        out[:] = list(self.block)
        return out

    def isna(self):
        return np.zeros(len(self), bool)

    def take(self, indices, *, allow_fill=False, fill_value=None):
        if allow_fill and (np.asarray(indices) < 0).any():
            raise ValueError("a column of matrices has no missing values")
        return type(self)(self.shared, self.own[np.asarray(indices, int)])

    def copy(self):
        return type(self)(self.shared.copy(), self.own.copy())


def of_steps(records: pd.Series, f: Callable[[np.ndarray], np.ndarray], dtype=None) -> np.ndarray:
    """A number for each step of all records, one record after the other, by an ``f`` that goes row by row. Steps that the records of a column
    share are given to it once."""
    column = records.array
    if not isinstance(column, Matrices):
        return f(np.concatenate([np.asarray(x, dtype) for x in records]))
    shared, own = f(column.shared), f(column.own.reshape(-1, column.own.shape[2])).reshape(len(column), -1)
    return np.concatenate([np.broadcast_to(shared, (len(own), len(shared))), own], axis=1).ravel()


class FunctionPrefix:
    """Any function of a batch of sequence records, whose inputs are matrices with a row per step. The past is held once for about ``records``
    at a time, and copied for them only if the function asks for the matrices (see ``Matrices`` and ``of_steps``)."""

    def __init__(self, predict: Callable[[pd.DataFrame], pd.Series], records: int = 1_024):
        self.predict, self.records = predict, records

    def start(self):
        return [], [], None, None

    def step(self, state, num, cat):
        nums, cats, last_num, last_cat = state
        if last_num is not None:
            if len(last_num) != 1:
                raise ValueError("only a state of one row goes on")
            nums, cats = [*nums, last_num[0]], [*cats, last_cat[0]]
        return nums, cats, num, cat

    @staticmethod
    def whole(past: list[np.ndarray], last: np.ndarray) -> Matrices:
        """The past with each of the last steps: one matrix (steps x inputs) per record."""
        return Matrices(np.array(past, last.dtype).reshape(-1, last.shape[1]), last[:, None].copy())

    def finish(self, state, length, inactivity):
        nums, cats, num, cat = state
        out, n = [], len(num)
        ends = np.ceil(np.linspace(0, n, -(-n // self.records) + 1)).astype(int)  # parts of nearly one size
        for i, j in itertools.pairwise(ends):
            batch = pd.DataFrame({"seq_length": np.full(j - i, length), "inactivity": inactivity[i:j], "inputs_num": self.whole(nums, num[i:j]),
                                  "inputs_cat": self.whole(cats, cat[i:j])})
            out.append(np.asarray(self.predict(batch), float))
        return np.concatenate(out)


def prefix_scorer(model: PipelineModel | PrefixScorer | Callable) -> PrefixScorer:
    """The step-by-step form of a fitted pipeline, of a function of batches, or of a scorer that has it already."""
    if isinstance(model, PipelineModel):
        return PooledPrefix.of(model)
    return model if all(hasattr(model, m) for m in ("start", "step", "finish")) else FunctionPrefix(model)
