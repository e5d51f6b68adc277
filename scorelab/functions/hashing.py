"""Seeded, repeatable randomness: a retried task draws the same numbers again."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorelab.functions.encode import as_column

BUCKET_DIGITS = 5  # 16**5 = 1,048,576 buckets of hash prefixes


def hash_key(key: Column | str, seed: int) -> Column:
    """32 hex digits, uniform over keys; equal on every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), as_column(key).cast("string")).cast("binary"))


def hash_bucket(hashed: Column | str) -> Column:
    return F.left(as_column(hashed), F.lit(BUCKET_DIGITS))


def hash_jitter(key: Column | str, seed: int, width: float = 0.45) -> Column:
    """Uniform in ``[-width, width)`` from the first 32 bits of the hash."""
    unit = F.conv(F.left(hash_key(key, seed), F.lit(8)), 16, 10).cast("double") / F.lit(4294967296.0)
    return unit * F.lit(2 * width) - F.lit(width)
