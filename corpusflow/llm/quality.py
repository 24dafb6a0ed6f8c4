"""Quality classifier: naive Bayes log-count ratios scale n-gram indicators of a linear SVM.

1. Over all labelled rows, count in how many texts of each class every hashed n-gram occurs. The
   log ratio of the two (smoothed, normalised) rates is the scale r of that n-gram.
2. A text's vector is r at its n-grams, divided by its length, plus a constant.
3. A linear hinge-loss model is fitted by dual coordinate descent on a bounded sample.
4. Margins become probabilities by a logistic fit on the part of the sample the model didn't see,
   weighted back to the class shares of all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from corpusflow.llm import features
from corpusflow.llm.features import Extractor
from corpusflow.llm.runtime import slices
from corpusflow.llm.wordhash import BLOCK_BYTES
from corpusflow.sources.scratch import stage


@dataclass(frozen=True)
class QualityModel:
    bits: int
    scale: np.ndarray  # log-count ratio of each bucket
    weights: np.ndarray  # of the scaled buckets; the last is the constant's
    slope: float
    offset: float


def document_counts(rows: DataFrame, extract: Extractor, bits: int) -> np.ndarray:
    """In how many texts of each class a bucket occurs: int64 (2, 2 ** bits).

    Each task sums up its own rows first, so at most 2 ** bits rows per task are shuffled and as
    many reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            data = [t.encode("utf-8") for t in batch.column(0).to_pylist()]
            label = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in slices([len(t) for t in data], BLOCK_BYTES):
                owner, found = extract(data[a:b])
                np.add.at(counts, (label[a:b][owner], found), 1)
        bucket = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket), pa.array(counts[0][bucket]), pa.array(counts[1][bucket])], ["b", "n0", "n1"]
        )

    partial = rows.select("t", "y").mapInArrow(count, "b long, n0 long, n1 long")
    table = partial.groupBy("b").agg({"n0": "sum", "n1": "sum"}).toDF("b", "n0", "n1").toArrow()
    total = np.zeros((2, 1 << bits), np.int64)
    for i, name in enumerate(("n0", "n1")):
        total[i][table["b"].to_numpy()] = table[name].to_numpy()
    return total


def log_count_ratio(counts: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    rates = counts + smoothing
    rates = rates / rates.sum(axis=1, keepdims=True)
    return np.where(counts.any(axis=0), np.log(rates[1] / rates[0]), 0.0)


def descend(vectors: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, costs: np.ndarray, size: int, epochs: int, seed: int = 42) -> np.ndarray:
    """Dual coordinate descent for the hinge loss: one multiplier per text, from 0 to its cost."""
    weights, multipliers = np.zeros(size), np.zeros(len(vectors))
    squares = np.array([v @ v for _, v in vectors])
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in draw.permutation(len(vectors)):
            at, value = vectors[i]
            slope = signs[i] * (weights[at] @ value) - 1.0
            new = min(max(multipliers[i] - slope / squares[i], 0.0), costs[i])
            if new != multipliers[i]:
                weights[at] += (new - multipliers[i]) * signs[i] * value
                multipliers[i] = new
    return weights


def logistic_fit(margins: np.ndarray, labels: np.ndarray, shares: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of P(1 | margin), by Newton steps on weighted, smoothed targets."""
    if not len(margins):
        return 1.0, 0.0
    plus, minus = shares[labels == 1].sum(), shares[labels == 0].sum()
    target = np.where(labels == 1, (plus + 1) / (plus + 2), 1 / (minus + 2))
    design = np.stack([margins, np.ones_like(margins)], axis=1)
    fit = np.zeros(2)
    for _ in range(steps):
        p = features.sigmoid(design @ fit)
        gradient = design.T @ (shares * (p - target)) + 1e-3 * fit
        curve = (design * (shares * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        fit -= np.clip(np.linalg.solve(curve, gradient), -2.0, 2.0)
    return float(fit[0]), float(fit[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    taught: Column | None = None,
    bits: int = 18,
    sample_per_class: int = 4000,
    cost: float = 1.0,
    epochs: int = 8,
) -> QualityModel:
    """Learn from labelled texts; `taught` is a condition on the key, called k.

    The counts cover every labelled row. The linear model sees about `sample_per_class` rows of
    each class, chosen by a hash of the key; three quarters fit it, the rest its probabilities.
    Without rows of both classes the model scores every text alike, by the share of class 1.
    """
    extract = features.quality_features(bits)
    rows = stage(features.training_rows(docs, labels, key, text, label, taught), "quality-rows")
    sizes = features.class_sizes(rows)
    scale = log_count_ratio(document_counts(rows, extract, bits))
    sample = features.drawn(rows, extract, sample_per_class, sizes, "quality sample")
    vectors = [vector(found, scale) for _, found in sample]
    known = np.array([y for y, _ in sample], np.int64)
    drawn = {y: max(1, int((known == y).sum())) for y in (0, 1)}
    part = np.arange(len(sample)) % 4 != 3
    if len(set(known[part].tolist())) < 2:
        ones, rest = sizes.get(1, 0), sizes.get(0, 0)
        return QualityModel(bits, scale, np.zeros((1 << bits) + 1), 1.0, float(np.log((ones + 1) / (rest + 1))))
    weights = descend(
        [v for v, p in zip(vectors, part) if p], np.where(known[part] == 1, 1.0, -1.0),
        np.full(int(part.sum()), cost), (1 << bits) + 1, epochs,
    )
    margins = np.array([weights[at] @ value for (at, value), p in zip(vectors, part) if not p])
    shares = np.array([sizes[y] / drawn[y] for y in known[~part]])
    slope, offset = logistic_fit(margins, known[~part], shares / max(shares.mean(), 1e-9) if len(shares) else shares)
    return QualityModel(bits, scale, weights, slope, offset)


def vector(found: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of a text's vector; the constant comes last."""
    value = scale[found]
    norm = np.sqrt(value @ value)
    return np.append(found, len(scale)), np.append(value / norm if norm else value, 1.0)


def score(df: DataFrame, model: QualityModel, text: str = "text", into: str = "score") -> DataFrame:
    """Add P(label 1) from 0 to 1. Null and empty texts are scored by the constant alone.

    The weights (2 ** bits numbers, twice) go to every worker. A column called `into` is replaced.
    """
    product = (model.weights[:-1] * model.scale).astype(np.float64)
    constant, squares = model.weights[-1], model.scale.astype(np.float64) ** 2
    slope, offset = model.slope, model.offset

    def link(owner: np.ndarray, found: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
        total = np.bincount(owner, weights[0][found], texts)
        norm = np.sqrt(np.bincount(owner, weights[1][found], texts))
        margin = total / np.where(norm > 0, norm, 1.0) + constant
        return features.sigmoid(slope * margin + offset)

    both = np.stack([product, squares])
    return features.scored(df, text, into, features.quality_features(model.bits), both, link)
