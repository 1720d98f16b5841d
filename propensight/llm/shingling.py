"""Sets of word shingles as sorted 64-bit hashes, for batches of texts at once."""

from __future__ import annotations

import numpy as np

WORDS = 5
SLICE = 1 << 18  # bytes whose shingles are computed at once; a longer text is taken whole, its word hashes in slices that end with words
FOLD = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
BLANK = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(_BASE, SLICE + 2)
_BACKS = powers(_BACK, SLICE + 2)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of ``data``, which begins and ends with a blank."""
    blank = BLANK[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + SLICE, "right")))
        stop = ends[last - 1]
        size = int(stop - base)
        up, down = (_POWERS, _BACKS) if size <= SLICE else (powers(_BASE, size + 1), powers(_BACK, size + 1))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((FOLD[data[base:stop]].astype(np.uint64) + np.uint64(1)) * up[:size], out=sums[1:])
        a, b = starts[first:last] - base, ends[first:last] - base
        hashes[first:last] = mix((sums[b] - sums[a]) * down[a] ^ (b - a).astype(np.uint64) << np.uint64(48))
        first = last
    return hashes, starts


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; fewer words than ``words`` are one shingle, none give an empty set."""
    out: list[np.ndarray] = []
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > SLICE:
            out += _sets_of(texts[first:i], words)
            first, size = i, 0
        size += len(t)
    return out + _sets_of(texts[first:], words)


def _sets_of(texts: list[bytes], words: int) -> list[np.ndarray]:
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    hashes, starts = word_hashes(data)
    limits = np.cumsum([1] + [len(t) + 1 for t in texts])
    at = np.searchsorted(starts, limits)
    n = len(hashes) - words + 1
    if n > 0:
        total = np.zeros(n, np.uint64)
        for j in range(words):
            total += hashes[j:j + n] * np.uint64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64))
        total = mix(total)
    out = []
    for i in range(len(texts)):
        a, b = int(at[i]), int(at[i + 1])
        if b - a >= words:
            out.append(np.unique(total[a:b - words + 1]))
        elif b > a:
            out.append(mix(np.array([sum(int(h) * pow(0xA0761D6478BD642F, j + 1, 1 << 64) for j, h in enumerate(hashes[a:b])) % (1 << 64)],
                                    np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
