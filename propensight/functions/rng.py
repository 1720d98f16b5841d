"""Random numbers as a pure function of a key, so that no draw depends on partitioning or retries."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

SPAN = 2.0 ** 32


def key(seed: int, *parts: Column | str) -> Column:
    """Hash of ``seed|part|part…``; one hash carries four independent uniforms."""
    cols = [F.lit(str(seed))] + [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def uniform(hashed: Column, part: int = 0) -> Column:
    """Uniform in [0, 1) from the ``part``-th eight hex digits."""
    return F.conv(F.substring(hashed, 8 * part + 1, 8), 16, 10).cast("bigint") / F.lit(SPAN)


def normal(hashed: Column) -> Column:
    """Standard normal by the Box-Muller transform, from the first two uniforms."""
    u = uniform(hashed, 0) + F.lit(0.5 / SPAN)
    return F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(2.0 * math.pi) * uniform(hashed, 1))
