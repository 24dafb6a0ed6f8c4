"""Stable hashes: every random choice is a pure function of (seed, tag, row key).

The same row gets the same draw under any partitioning, retry or executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
BUCKET_BITS = 16


def stable_hash(key: Column, seed: int, tag: str) -> Column:
    """60-bit non-negative bigint from md5 of 'seed|tag|key'."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{tag}|"), key.cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def keep_share(key: Column, seed: int, tag: str, weight: float) -> Column:
    """True for a `weight` share of the keys. A larger weight keeps a superset."""
    if weight <= 0:
        return F.lit(False)
    if weight >= 1:
        return F.lit(True)
    return stable_hash(key, seed, tag) < F.lit(int(weight * (1 << HASH_BITS))).cast("bigint")


def pick(key: Column, seed: int, tag: str, choices: list[str]) -> Column:
    """One of `choices`, uniformly."""
    index = (stable_hash(key, seed, tag) % len(choices)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(c) for c in choices]), index)


def bucket(hashed: Column) -> Column:
    """Top 16 bits of a stable hash: at most 65,536 values, evenly filled."""
    return F.shiftright(hashed, HASH_BITS - BUCKET_BITS)
