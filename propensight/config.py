"""Parameters of the jobs. Defaults are the production values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from propensight import constants as C


@dataclass(frozen=True)
class Params:
    history: int = 91             # days of history before a cutoff
    horizon: int = 28             # days after a cutoff in which a purchase counts
    pending: int = 28             # an id must have been seen in this many days up to the cutoff
    min_events: int = 5           # an id needs more history events than this
    max_len: int = 200            # events kept per sequence
    training_history: int = 210   # days of cutoffs to train on
    max_missing: float = 0.1      # share of those days that may have no data
    train_share: float = 0.8      # share of training days, the rest evaluates
    retention: int = C.RETENTION_DAYS
    bounds: tuple[int, ...] = field(default_factory=lambda: tuple(C.LENGTH_BOUNDS))
    batch_size: int = 161
    calibration_bins: int = 10
    histogram_bins: int = 15
    kernel_width: float = 0.75
    samples: int = 5000           # perturbed samples per explained instance
    background: int = 100         # background rows per step
    seed: int = 16

    def begin(self, cutoff: dt.date) -> dt.date:
        return cutoff - dt.timedelta(days=self.history)

    def end(self, cutoff: dt.date) -> dt.date:
        return cutoff + dt.timedelta(days=self.horizon)
