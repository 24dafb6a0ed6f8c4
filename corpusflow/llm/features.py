"""Hashed indicator features of texts, training rows for the classifiers, and scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import bloom
from corpusflow.llm.runtime import is_small, slices
from corpusflow.llm.wordhash import BLOCK_BYTES, LOWER, MARK, Words, mix, ngrams, read_words, run_hashes
from corpusflow.sources.scratch import stage

#: Texts to (text number, feature) pairs, ascending and without repeats. A second argument, a
#: boolean per feature, leaves out the others before anything is sorted.
Extractor = Callable[..., tuple[np.ndarray, np.ndarray]]


def indicators(
    groups: list[tuple[np.ndarray, np.ndarray]], bits: int, known: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, bucket) pairs of hashes with their text numbers."""
    keys = []
    for hashes, owner in groups:
        found = hashes >> np.uint64(64 - bits)
        if known is not None:
            used = known[found.view(np.int64)]
            found, owner = found[used], owner[used]
        keys.append((owner.astype(np.uint64) << np.uint64(bits)) | found)
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64((1 << bits) - 1)).astype(np.int64)


def shapes(words: Words) -> np.ndarray:
    """What tokens look like: a run of marks stands for itself; a word gives its capitals, leading
    digit, and whether it repeats the token before it."""
    first, last = words.raw[words.starts], words.raw[words.ends - 1]
    upper = lambda b: (b >= 65) & (b <= 90)
    code = upper(first) + 2 * upper(last) + 4 * ((first >= 48) & (first <= 57))
    again = np.zeros(len(first), bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.owner[1:] == words.owner[:-1])
    code = mix((code + 8 * again).astype(np.uint64) + np.uint64(1))
    return np.where(words.kinds == MARK, words.hashes, code)


def quality_features(bits: int) -> Extractor:
    """Words and word pairs; single, double and triple token shapes."""

    def extract(texts: list[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        words = read_words(texts, marks=True)
        looks = shapes(words)
        groups = [ngrams(words.hashes, words.owner, o, 1 + i) for i, o in enumerate(((0,), (0, 1)))]
        groups += [ngrams(looks, words.owner, o, 11 + i) for i, o in enumerate(((0,), (0, 1), (0, 1, 2)))]
        return indicators(groups, bits, known)

    return extract


def toxicity_features(bits: int, stem_bytes: tuple[int, ...] = (4, 6, 8)) -> Extractor:
    """Words, word pairs, and pairs that skip one or two words; the words also cut to stems."""

    def extract(texts: list[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        words = read_words(texts)
        gaps = ((0,), (0, 1), (0, 2), (0, 3))
        groups = [ngrams(words.hashes, words.owner, o, 21 + i) for i, o in enumerate(gaps)]
        lower = LOWER[words.raw]
        for i, most in enumerate(stem_bytes):
            stems = run_hashes(lower, words.starts, np.minimum(words.ends, words.starts + most))
            groups.append(ngrams(stems, words.owner, (0,), 31 + i))
        return indicators(groups, bits, known)

    return extract


def encoded(texts: pd.Series) -> list[bytes]:
    return [b"" if t is None else t.encode("utf-8") for t in texts]


def scored(
    df: DataFrame, text: str, into: str, extract: Extractor, weights: np.ndarray, link, buckets: np.ndarray | None = None, bits: int = 0
) -> DataFrame:
    """Add `link(text numbers, features, weights, texts)` of every text. Row-local.

    With `buckets`, the weights are those of these features alone, of 2 ** bits; they are sent as
    pairs and spread out in the worker, and other features are not looked at.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, table = None, weights
        if buckets is not None:
            table = np.zeros(1 << bits)
            table[buckets] = weights
            known = table != 0
        for texts in batches:
            data = encoded(texts)
            out = np.zeros(len(data))
            for a, b in slices([len(t) for t in data], BLOCK_BYTES):
                owner, found = extract(data[a:b], known)
                out[a:b] = link(owner, found, table, b - a)
            yield pd.Series(out)

    return df.withColumn(into, score(F.col(text)))


def training_rows(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, taught: Column | None
) -> DataFrame:
    """(k, t, y): labelled texts. Rows with a null key or label teach nothing; a null text counts
    as empty. `taught` is a condition on `k`. A small table of labels goes to the texts; with a
    larger one, a Bloom filter of the labelled keys keeps most other texts out of the shuffle."""
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter(
        "k is not null and y in (0, 1)"
    )
    if taught is not None:
        known = known.filter(taught)
    known = stage(known, "labels")
    texts = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    if is_small(known):
        return texts.join(F.broadcast(known), "k").select("k", "t", "y")
    bitmap = bloom.build(known, "k")
    return texts.filter(bloom.may_hold(bitmap, F.col("k"))).join(known, "k").select("k", "t", "y")


def drawn(rows: DataFrame, extract: Extractor, per_class: int, sizes: dict[int, int], seed: str) -> list:
    """About `per_class` rows of each class, chosen by a hash of the key: [(label, features)].

    This is what may reach the driver: two classes of `per_class` rows in expectation.
    """
    draw = F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(1 << 30))
    share = F.lit(0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, int(min(1.0, per_class / max(1, n)) * (1 << 30))).otherwise(share)

    @F.pandas_udf("binary")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([extract([t])[1].astype(np.int32).tobytes() for t in encoded(texts)], dtype=object)

    chosen = rows.withColumn("d", draw).filter(F.col("d") < share)
    table = chosen.select("d", "k", "y", features("t").alias("f")).toArrow()
    order = np.lexsort([table[c].to_numpy() for c in ("k", "d")])
    label, found = table["y"].to_numpy(), table["f"].combine_chunks()
    found = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
    starts, data = np.frombuffer(found.buffers()[1], np.int32), np.frombuffer(found.buffers()[2] or b"", np.int32)
    return [(int(label[i]), data[starts[i + found.offset] // 4 : starts[i + found.offset + 1] // 4]) for i in order]


def class_sizes(rows: DataFrame) -> dict[int, int]:
    return {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


