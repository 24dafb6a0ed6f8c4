"""A Bloom filter of fixed size, to leave out rows before a join would shuffle them.

It only saves work: a row that passes by chance finds no partner in the join that follows. Its
size doesn't grow with the data (1 MB); with many millions of keys it lets more rows through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def _places(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(BITS)).cast("int") for seed in ("first", "second")]


def build(df: DataFrame, key: str) -> np.ndarray:
    """Words of 64 bits. At most 131,072 rows reach the driver. Null keys count as keys."""
    return from_places(df.select(F.explode(F.array(*_places(F.col(key)))).alias("p")))


def from_places(places: DataFrame) -> np.ndarray:
    """The filter with the bits at `p` (int) set."""
    words = (
        places.select(F.shiftright("p", 6).alias("w"), F.col("p").bitwiseAND(63).alias("b"))
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("m"))
    )
    bitmap = np.zeros(BITS // 64, np.int64)
    for w, m in words.collect():
        bitmap[w] = m
    return bitmap


def from_hashes(df: DataFrame, column: str) -> np.ndarray:
    """The filter of a column of 64-bit hashes, see `held_hashes`."""
    top, low = F.shiftrightunsigned(column, 41), F.col(column).bitwiseAND(BITS - 1)
    return from_places(df.select(F.explode(F.array(top.cast("int"), low.cast("int"))).alias("p")))


def held_hashes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    top, low = hashes >> np.uint64(41), hashes & np.uint64(BITS - 1)
    return held(bitmap, top.astype(np.int64)) & held(bitmap, low.astype(np.int64))


def held(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> 6] >> (places & 63)) & 1 != 0


def may_hold(bitmap: np.ndarray, key: Column) -> Column:
    """False only for keys that the filter was not built from."""

    @F.pandas_udf("boolean")
    def test(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series(held(bitmap, first.to_numpy()) & held(bitmap, second.to_numpy()))

    return test(*_places(key))
