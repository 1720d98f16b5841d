"""Weighted moments of linear fits in a form that merges: a block of samples is a factor ``A`` with ``A'A`` the weighted sums of
products of ``(1, x, y...)``. Factors are stacked, and reduced by QR to as many rows as columns, so their size does not grow with the samples.

Regressors take the centred factor, ``x`` (rows x columns) and ``y`` (rows x labels), and return the weights (columns x labels): least
squares of its rows is least squares of all weighted samples.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

Regressor = Callable[[np.ndarray, np.ndarray], np.ndarray]


def factor(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    return reduced(np.sqrt(w)[:, None] * np.column_stack([np.ones(len(x)), x, y]))


def reduced(a: np.ndarray) -> np.ndarray:
    return np.linalg.qr(a, mode="r") if len(a) > a.shape[1] else a


def merged(factors: list[np.ndarray]) -> np.ndarray:
    return reduced(np.concatenate(factors)) if len(factors) > 1 else factors[0]


def centred(a: np.ndarray, labels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``x`` and ``y`` of a factor without their weighted means, and the means."""
    one = a[:, 0]
    mean = one @ a / (one @ one)
    rest = a[:, 1:] - np.outer(one, mean[1:])
    return rest[:, :-labels], rest[:, -labels:], mean[1:-labels], mean[-labels:]


def ridge(alpha: float = 1.0) -> Regressor:
    """Solved in the smaller of rows and columns; one factorisation for all labels."""
    def fit(x, y):
        if x.shape[1] <= len(x):
            return np.linalg.solve(x.T @ x + alpha * np.eye(x.shape[1]), x.T @ y)
        return x.T @ np.linalg.solve(x @ x.T + alpha * np.eye(len(x)), y)
    return fit


def marginal(alpha: float = 1.0) -> Regressor:
    """Each column on its own."""
    return lambda x, y: (x.T @ y) / ((x * x).sum(axis=0) + alpha)[:, None]


def lasso(penalty: float, turns: int = 500, tolerance: float = 1e-10) -> Regressor:
    """Least squares with ``penalty`` times the sum of the weights' sizes, by coordinate descent on the sums of products."""
    def one(gram, c):
        beta, fitted = np.zeros(len(c)), np.zeros(len(c))
        own = np.diag(gram)
        for _ in range(turns):
            most = 0.0
            for j in np.flatnonzero(own > 0):
                rest = c[j] - fitted[j] + own[j] * beta[j]
                new = np.sign(rest) * max(abs(rest) - penalty, 0.0) / own[j]
                if new != beta[j]:
                    fitted += gram[:, j] * (new - beta[j])
                    most, beta[j] = max(most, abs(new - beta[j])), new
            if most < tolerance:
                break
        return beta
    return lambda x, y: np.column_stack([one(x.T @ x, x.T @ c) for c in y.T])


def forward(x: np.ndarray, y: np.ndarray, k: int) -> list[int]:
    """Columns by the gain of least squares, one after another: what is chosen is projected out of the others."""
    x, y, chosen = x.copy(), y.copy(), []
    size = (x * x).sum(axis=0)
    least = 1e-12 * np.maximum(size, 1e-300)
    while len(chosen) < k:
        left = (x * x).sum(axis=0)
        gain = np.divide((y @ x) ** 2, left, out=np.full(len(left), -1.0), where=left > least)
        gain[chosen] = -1.0
        best = int(gain.argmax())
        if gain[best] < 0:
            break
        chosen.append(best)
        q = x[:, best] / np.sqrt(left[best])
        y = y - q * (q @ y)
        x -= np.outer(q, q @ x)
    return chosen


def lasso_path(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Weights at every knot of the lasso path, from none to least squares: columns enter and leave as the penalty falls."""
    d = x.shape[1]
    beta, active, out = np.zeros(d), [], [np.zeros(d)]
    usable = (x * x).sum(axis=0) > 0
    c = x.T @ y
    c[~usable] = 0.0
    penalty = float(np.abs(c).max(initial=0.0))
    start, left = penalty, -1
    if not start:
        return out
    active.append(int(np.abs(c).argmax()))
    for _ in range(8 * min(x.shape) + 8):
        signs = np.sign(c[active])
        towards = np.linalg.lstsq(x[:, active].T @ x[:, active], signs, rcond=None)[0]
        along = x.T @ (x[:, active] @ towards)
        free = usable.copy()
        free[active] = False
        if left >= 0:
            free[left] = False
        with np.errstate(divide="ignore", invalid="ignore"):
            joins = np.minimum(*(np.where((s > 1e-14) & free, s, np.inf) for s in ((penalty - c) / (1 - along), (penalty + c) / (1 + along))))
            drops = np.where(-beta[active] / towards > 1e-14, -beta[active] / towards, np.inf)
        step = min(penalty, joins.min(initial=np.inf), drops.min(initial=np.inf))
        beta[active] += step * towards
        penalty -= step
        left = -1
        if step == drops.min(initial=np.inf) and step < penalty + step:
            left = active.pop(int(drops.argmin()))
            beta[left] = 0.0
        out.append(beta.copy())
        c = np.where(usable, x.T @ (y - x @ beta), 0.0)
        if penalty <= 1e-10 * start or not active:
            break
        if left < 0:
            new = int(joins.argmin())
            rest = x[:, new] - x[:, active] @ np.linalg.lstsq(x[:, active], x[:, new], rcond=None)[0]
            if rest @ rest > 1e-12 * (x[:, new] @ x[:, new]):
                active.append(new)
            else:  # a copy of what is in already
                usable[new] = False
    return out


def last_with(path: list[np.ndarray], k: int) -> np.ndarray:
    """Columns at the last knot that has at most ``k``."""
    return next((np.flatnonzero(b) for b in reversed(path) if np.count_nonzero(b) <= k), np.empty(0, int))


def by_weight(x: np.ndarray, y: np.ndarray, origin: np.ndarray, alpha: float, digits: int | None = None) -> np.ndarray:
    """All columns by the size of their ridge weight times the instance's value, largest first. Sizes that are equal to ``digits`` decimals, as
    those of columns with the same cells, go by position."""
    size = np.abs(ridge(alpha)(x, y[:, None])[:, 0] * origin)
    return np.argsort(-(size if digits is None else np.round(size, digits)), kind="stable")


def selected(x: np.ndarray, y: np.ndarray, origin: np.ndarray, k: int | None, how: str, alpha: float,
             order: Callable[[], np.ndarray] | None = None) -> np.ndarray:
    """Columns to fit, in order of position. ``auto`` goes forward for up to six columns and takes the highest weights beyond; ``order`` gives
    the columns of ``by_weight`` where several ``k`` share them."""
    if k is None or k >= x.shape[1] or how == "none":
        return np.arange(x.shape[1])
    how = ("forward" if k <= 6 else "highest_weights") if how == "auto" else how
    if how == "forward":
        return np.sort(forward(x, y, k))
    if how == "lasso_path":
        return last_with(lasso_path(x, y), k)
    if how != "highest_weights":
        raise ValueError(f"no selection of columns is called {how}")
    return np.sort((order() if order else by_weight(x, y, origin, alpha))[:k])
