"""Toxicity: logistic regression over hashed word n-grams and skip-grams, by FTRL-proximal.

Each weight has its own learning rate, from the squares of its past gradients. The L1 term keeps
a weight at zero until its evidence is strong enough, so the model is sparse and small enough to
go to every worker.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame

from corpusflow.llm import features
from corpusflow.sources.scratch import stage


@dataclass(frozen=True)
class ToxicityModel:
    bits: int
    buckets: np.ndarray  # those with a weight, ascending
    weights: np.ndarray
    constant: float


class FtrlProximal:
    """Per-coordinate follow-the-regularised-leader for the logistic loss on 0/1 features."""

    def __init__(self, size: int, rate: float, smooth: float, l1: float, l2: float):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.rate, self.smooth, self.l1, self.l2 = rate, smooth, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(
            np.abs(z) <= self.l1, 0.0,
            (np.sign(z) * self.l1 - z) / ((self.smooth + np.sqrt(n)) / self.rate + self.l2),
        )

    def learn(self, at: np.ndarray, label: int, importance: float) -> None:
        weights = self.weights(at)
        p = 1.0 / (1.0 + np.exp(-np.clip(weights.sum(), -40.0, 40.0)))
        gradient = (p - label) * importance
        n = self.n[at]
        step = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / self.rate
        self.z[at] += gradient - step * weights
        self.n[at] = n + gradient * gradient


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    taught: Column | None = None,
    bits: int = 20,
    sample_per_class: int = 6000,
    epochs: int = 3,
    rate: float = 1.0,
    smooth: float = 1.0,
    l1: float = 3.0,
    l2: float = 0.1,
) -> ToxicityModel:
    """Learn from about `sample_per_class` labelled rows of each class, the bound of the sample.

    Rows are chosen by a hash of the key (`taught`: a condition on it, called k). All count alike in
    the fit. Where the classes were drawn at different rates, the constant then moves by the log of
    their ratio: in a logistic model nothing else depends on those rates, so scores have the class
    shares of all labelled rows, whatever their number. Without labelled rows every text scores one
    half.
    """
    extract = features.toxicity_features(bits)
    rows = stage(features.training_rows(docs, labels, key, text, label, taught), "toxicity-rows")
    sizes = features.class_sizes(rows)
    sample = features.drawn(rows, extract, sample_per_class, sizes, "toxicity sample")
    leader = FtrlProximal((1 << bits) + 1, rate, smooth, l1, l2)
    draw = np.random.default_rng(42)
    for _ in range(epochs):
        for i in draw.permutation(len(sample)):
            y, found = sample[i]
            leader.learn(np.append(found, 1 << bits), y, 1.0)
    every = leader.weights(np.arange((1 << bits) + 1))
    buckets = np.flatnonzero(every[:-1])
    drawn = {y: sum(1 for s in sample if s[0] == y) for y in (0, 1)}
    odds = np.log(sizes[1] / drawn[1]) - np.log(sizes[0] / drawn[0]) if all(drawn.values()) else 0.0
    return ToxicityModel(bits, buckets, every[buckets], float(every[-1] + odds))


def score(df: DataFrame, model: ToxicityModel, text: str = "text", into: str = "score") -> DataFrame:
    """Add P(label 1) from 0 to 1. Null and empty texts are scored by the constant alone."""
    constant = model.constant

    def link(owner: np.ndarray, found: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
        return features.sigmoid(np.bincount(owner, weights[found], texts) + constant)

    extract = features.toxicity_features(model.bits)
    return features.scored(df, text, into, extract, model.weights, link, model.buckets, model.bits)
