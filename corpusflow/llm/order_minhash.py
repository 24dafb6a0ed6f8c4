"""Order MinHash: fingerprints of texts whose agreement follows edit distance.

Each of several hash functions picks a text's two smallest k-mers, where the n-th occurrence of a
k-mer counts as a k-mer of its own. The two stay in text order and are hashed together. Two texts
agree in a component if they share these k-mers in the same order, so moved passages count less
than with a set of k-mers.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.wordhash import mix, seeded

KMER = 6
FUNCTIONS = 64
#: Hash values computed at once.
BLOCK = 1 << 16
#: The low bits of a k-mer's hash that give way to its place; the other 40 say which k-mer it is,
#: so two of n different k-mers in a text are taken for one with a probability below n^2 / 2^41.
PLACE_BITS = 24
ROWS_PER_BUCKET = 200
MOST_BUCKETS = 1 << 16
LAST_ID = (1 << 63) - 1


@functools.lru_cache(maxsize=4)
def _multipliers(functions: int) -> np.ndarray:
    return np.array([seeded(500 + j) | np.uint64(1) for j in range(functions)])


def by_content(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of content, equal contents in text order, and the contents. What a k-mer
    counts as depends on its hash alone, not on the text it stands in."""
    if len(hashes) > 1 << PLACE_BITS:
        content = hashes >> np.uint64(PLACE_BITS)
        place = np.argsort(content, kind="stable")
        return place, content[place]
    # One sort of numbers with the place in the low bits is faster than sorting indices.
    low = np.uint64((1 << PLACE_BITS) - 1)
    ordered = np.sort((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64))
    return (ordered & low).astype(np.int64), ordered >> np.uint64(PLACE_BITS)


def sketch(text: str, kmer: int = KMER, functions: int = FUNCTIONS) -> np.ndarray:
    """One uint32 per hash function. A text shorter than a k-mer is one k-mer."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    n = max(1, len(points) - kmer + 1)
    hashes = np.full(n, np.uint64(min(len(points), kmer)), np.uint64)
    for t in range(min(kmer, len(points))):
        hashes += points[t : t + n] * seeded(t)
    place, content = by_content(mix(hashes))
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(content[1:], content[:-1], out=new[1:])
    occurrence = np.arange(n)
    occurrence -= np.maximum.accumulate(np.where(new, occurrence, 0))
    numbered = mix(content + occurrence.astype(np.uint64) * seeded(99))
    content = mix(content)
    out = np.empty(functions, np.uint64)
    factors = _multipliers(functions)
    step = max(1, BLOCK // n)
    for j in range(0, functions, step):
        values = numbered[None, :] * factors[j : j + step, None]
        rows = np.arange(len(values))
        first = values.argmin(axis=1)
        values[rows, first] = np.uint64(2**64 - 1)
        second = values.argmin(axis=1) if n > 1 else first
        swap = place[second] < place[first]
        a, b = np.where(swap, second, first), np.where(swap, first, second)
        out[j : j + step] = mix(content[a] * np.uint64(3) + mix(content[b]))
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document against the row that follows it in its bucket. Rows come in order; the last
    of a bucket is a copy of the first document of the next one. One document is kept meanwhile."""
    names = [c.strip().split(" ")[0] for c in SCHEMA.split(",")]
    held: tuple[int, int | None, str, np.ndarray] | None = None
    for batch in batches:
        out: list[tuple] = []
        for bucket, copy, key, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if copy and held is None:
                continue
            print_ = sketch(text)
            if held is not None and held[0] == bucket:
                changed = edited(held[2], text)
                changed_print = sketch(changed)
                out.append((
                    held[1], len(held[2]), hashlib.sha256(changed.encode("utf-8")).hexdigest(),
                    held[3].byteswap().tobytes().hex(), changed_print.byteswap().tobytes().hex(),
                    likeness(held[3], changed_print), likeness(held[3], print_),
                ))
            held = None if copy else (bucket, key, text, print_)
        if out:
            arrays = [pa.array(c) for c in zip(*out)]
            arrays[0] = pa.array([r[0] for r in out], pa.int64())
            yield pa.RecordBatch.from_arrays(arrays, names)


def with_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness; see `SCHEMA`.

    The next document is the one with the next larger key; equal keys follow the order of their
    texts, null keys come last, and after the last comes the first. Null texts are empty.

    Keys are cut into ranges at approximate quantiles, which are keys of the table. A range's
    first document is also sent to the range before it, so each range is worked off by itself, in
    order and one document at a time. Texts are shuffled once.
    """
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(LAST_ID))
    count = df.count()
    buckets = max(1, min(MOST_BUCKETS, count // ROWS_PER_BUCKET))
    cuts = df.select(order.alias("o")).agg(
        F.percentile_approx("o", [i / buckets for i in range(buckets)], max(10_000, 10 * buckets)).alias("c")
    )
    bounds = np.unique(np.array(cuts.first()["c"] or [0], np.int64))

    @F.pandas_udf("int")
    def bucket_of(keys: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(bounds, keys.to_numpy(), side="right") - 1).astype(np.int32))

    @F.pandas_udf("boolean")
    def is_first(keys: pd.Series) -> pd.Series:
        return pd.Series(np.isin(keys.to_numpy(), bounds))

    rows = df.select(
        order.alias("o"), F.col(key).cast("bigint").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"),
        bucket_of(order).alias("b"), is_first(order).alias("first"),
    )
    here = F.struct(F.col("b"), F.lit(False).alias("copy"))
    back = F.struct(F.pmod(F.col("b") - 1, F.lit(len(bounds))).alias("b"), F.lit(True).alias("copy"))
    sent = rows.select(F.explode(F.when(F.col("first"), F.array(here, back)).otherwise(F.array(here))).alias("at"), "o", "k", "t")
    sent = sent.select("at.b", "at.copy", "o", "k", "t").repartition("b").sortWithinPartitions("b", "copy", "o", "t")
    return sent.select("b", "copy", "k", "t").mapInArrow(compared, SCHEMA)
