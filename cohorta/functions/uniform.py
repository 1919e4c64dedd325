"""Random draws as column expressions of (seed, stream, key).

A draw depends on the row's key only, so it is the same under any partitioning,
after a lost executor and in any SQL engine that has md5.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 2.0 ** -53


def hash_uniform(*keys: Column | str, seed: int = 42, stream: str = "") -> Column:
    """Uniform number in [0, 1): the first 52 bits of md5('seed:[stream:]key[:key...]')."""
    prefix = f"{seed}:{stream}:" if stream else f"{seed}:"
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat(F.lit(prefix), F.concat_ws(":", *parts)))
    # 52 bits: exact as a long and as a double, and text is read much faster as a long.
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(2 ** 52))


def hash_normal(*keys: Column | str, seed: int = 42, stream: str = "") -> Column:
    """Standard normal draw: Box-Muller on two hash uniforms."""
    u = hash_uniform(*keys, seed=seed, stream=f"{stream}:u") + F.lit(TINY)
    v = hash_uniform(*keys, seed=seed, stream=f"{stream}:v")
    return F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(2 * math.pi) * v)


def choice_index(size: Column | int, *keys: Column | str, seed: int = 42, stream: str = "") -> Column:
    """Uniform integer in 0 .. size-1."""
    return F.floor(hash_uniform(*keys, seed=seed, stream=stream) * size).cast("long")
