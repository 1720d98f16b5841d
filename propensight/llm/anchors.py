"""Content-defined anchors: of all grams inside a window the one with the least hash, the first of equals.

Equal windows have their anchor at the same offset, so windows can only be equal if their anchors' grams are. Neighbouring
windows mostly share their anchor; such a stretch of windows is one record.
"""

from __future__ import annotations

import numpy as np

from propensight.llm.shingling import mix, powers

WINDOW = 100
SPAN = 64  # grams in a window, a power of two
GRAM = WINDOW - SPAN + 1
SLICE = 1 << 20  # windows whose anchors are looked for at once
_BASE = 0x2545F4914F6CDD1D
_UP = powers(_BASE, SLICE + 2 * WINDOW)
_DOWN = powers(pow(_BASE, -1, 1 << 64), SLICE + 2 * WINDOW)


def anchors(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the texts ``data[limits[i]:limits[i + 1]]``: owner, hash of the anchor's gram, its place, the first window's start and
    the number of windows that share the anchor (places in ``data``). A stretch may be cut where a slice ends."""
    parts = []
    for first in range(0, max(0, len(data) - WINDOW + 1), SLICE):
        part = data[first:first + SLICE + WINDOW - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _UP[:len(part)], out=sums[1:])
        least = mix((sums[GRAM:] - sums[:-GRAM]) * _DOWN[:len(part) - GRAM + 1])
        hashes, place, step = least, np.arange(len(least), dtype=np.int32), 1
        while step < SPAN:
            a, b = least[:-step], least[step:]
            place = np.where(a <= b, place[:-step], place[step:])
            least = np.minimum(a, b)
            step *= 2
        starts = np.arange(len(place)) + first
        owner = np.searchsorted(limits, starts, "right") - 1
        inside = starts + WINDOW <= limits[owner + 1]
        change = np.r_[True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])]
        at = np.flatnonzero(change)
        size = np.diff(np.r_[at, len(place)])
        keep = inside[at]
        at, size = at[keep], size[keep]
        parts.append((owner[at], hashes[place[at]], place[at] + first, starts[at], size))
    if not parts:
        return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
