"""Benchmark decontamination by winnowing.

Every run of `window` words of a document that an item holds too shares a fingerprint with it: in
each run of consecutive k-grams that fills a window, the one with the smallest hash (the last of
equal ones) is a fingerprint, in documents and items alike. Fingerprints are joined, and each hit
is extended word by word to both sides, over as many words as a window around it can reach. A
span of at least a window marks its words. Spans longer than that are covered by several
fingerprints. An item shorter than a window has one fingerprint, all its words.

A document's fingerprints leave their task only if a Bloom filter of the items' fingerprints (of
fixed size) lets them pass. Words are compared as text, so hashes decide nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm import bloom
from corpusflow.llm.runtime import packed, slices, unpacked
from corpusflow.llm.wordhash import BLOCK_BYTES, LOWER, Words, ngrams, read_words
from corpusflow.sources.scratch import stage

WINDOW = 10
GRAM = 5

#: One fingerprint: hash, number of words (negative: a short item's), place of its first word, the
#: words, and those before (nearest first) and after it as far as a window reaches.
MARK = "struct<h:bigint,g:int,p:int,words:array<string>,before:array<string>,after:array<string>>"
MARK_TYPE = pa.list_(
    pa.struct(
        [("h", pa.int64()), ("g", pa.int32()), ("p", pa.int32())]
        + [(name, pa.list_(pa.string())) for name in ("words", "before", "after")]
    )
)
Choice = Callable[[Words, np.ndarray], list[tuple[int, np.ndarray, np.ndarray]]]


def grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each run of `size` words of one text."""
    hashes, _ = ngrams(words.hashes, words.owner, tuple(range(size)), 100 + size)
    last = len(words.hashes) - size + 1
    first = np.flatnonzero(words.owner[:last] == words.owner[size - 1 :]) if last > 0 else np.zeros(0, np.int64)
    return hashes, first


def winnow(hashes: np.ndarray, first: np.ndarray, owner: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Indexes of the chosen k-grams: the last minimum of each `window - gram + 1` in a row."""
    span = window - gram + 1
    if len(hashes) < span:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, span)
    chosen = np.arange(len(views)) + span - 1 - views[:, ::-1].argmin(axis=1)
    inside = owner[first[: len(views)]] == owner[first[span - 1 :]]
    return np.unique(chosen[inside])


def marks(words: Words, texts: int, found: list[tuple[int, np.ndarray, np.ndarray]], reach: int = WINDOW - GRAM) -> list[list[dict]]:
    """Fingerprints of each text. `found`: number of words, hashes, first words."""
    out: list[list[dict]] = [[] for _ in range(texts)]
    lower = LOWER[words.raw].tobytes() if any(len(f[1]) for f in found) else b""
    begin = np.searchsorted(words.owner, np.arange(texts))
    end = np.searchsorted(words.owner, np.arange(texts), side="right")

    def read(low: int, high: int) -> list[str]:
        return [lower[words.starts[i] : words.ends[i]].decode("utf-8") for i in range(low, high)]

    for kind, hashes, first in found:
        size, around = abs(kind), reach if kind > 0 else 0
        for h, p in zip(hashes.view(np.int64).tolist(), first.tolist()):
            text = int(words.owner[p])
            low, high = max(int(begin[text]), p - around), min(int(end[text]), p + size + around)
            out[text].append(
                {"h": h, "g": kind, "p": p - int(begin[text]), "words": read(p, p + size),
                 "before": read(low, p)[::-1], "after": read(p + size, high)}
            )
    return out


def fingerprints(df: DataFrame, text: str, choose: Choice) -> DataFrame:
    """All other columns, with n_words (bigint) and marks."""
    kept = [c for c in df.columns if c != text]
    schema = df.select(*kept).schema.add("n_words", T.LongType())
    schema = schema.add("marks", T.DataType.fromDDL(f"array<{MARK}>"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [(t or "").encode("utf-8") for t in batch.column(batch.schema.names.index(text)).to_pylist()]
            counts: list[np.ndarray] = []
            found: list[list[dict]] = []
            for a, b in slices([len(t) for t in data], BLOCK_BYTES):
                words = read_words(data[a:b])
                counts.append(np.bincount(words.owner, minlength=b - a))
                found += marks(words, b - a, choose(words, counts[-1]))
            columns = [batch.column(batch.schema.names.index(c)) for c in kept]
            columns += [pa.array(np.concatenate(counts).astype(np.int64)), pa.array(found, MARK_TYPE)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_words", "marks"])

    return df.select(*kept, text).mapInArrow(read, schema)


def of_items(words: Words, counts: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Winnowed k-grams of items of a window and more; all words of shorter ones."""
    hashes, first = grams(words, GRAM)
    chosen = winnow(hashes, first, words.owner)
    found = [(GRAM, hashes[chosen], first[chosen])]
    for size in range(1, WINDOW):
        hashes, first = grams(words, size)
        whole = counts[words.owner[first]] == size
        found.append((-size, hashes[whole], first[whole]))
    return found


def of_documents(bitmap: np.ndarray, sizes: list[int]) -> Choice:
    """Winnowed k-grams, and all runs as long as a short item, that the Bloom filter lets pass."""

    def passed(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = bloom.held_hashes(bitmap, hashes)
        return hashes[known], first[known]

    def choose(words: Words, counts: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        hashes, first = grams(words, GRAM)
        chosen = winnow(hashes, first, words.owner)
        return [(GRAM, *passed(hashes[chosen], first[chosen]))] + [(-s, *passed(*grams(words, s))) for s in sizes]

    return choose


def common(left: str, right: str) -> Column:
    """Length of the common beginning of two arrays."""
    differs = f"array_position(zip_with({left}, {right}, (x, y) -> coalesce(x = y, false)), false)"
    return F.expr(f"if({differs} = 0, least(size({left}), size({right})), {differs} - 1)").cast("int")


def hits(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (row bigint, their other columns, n_words), and hits (row, s, e, item_id string).

    A hit covers the words s to e - 1, counted from 0. Each row is a document of its own, whatever
    its columns hold. Null and empty texts have no words; items without words match nothing, and
    items with a null id mark words but have no name.
    """
    named = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("t"))
    known = fingerprints(named, "t", of_items).select("item_id", F.inline("marks"))
    known = stage(known, "item-fingerprints")
    sizes = sorted(r["g"] for r in known.filter("g < 0").select("g").distinct().collect())
    choose = of_documents(bloom.from_hashes(known, "h"), [-g for g in sizes])
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    rows = stage(fingerprints(numbered, text, choose), "document-fingerprints")
    met = rows.select("row", F.inline("marks")).alias("d").join(
        known.alias("i"), F.expr("d.h = i.h and d.g = i.g and d.words = i.words")
    )
    spans = met.select(
        "d.row", "i.item_id",
        F.col("d.p").alias("p"), F.abs("d.g").alias("n"), (F.col("d.g") < 0).alias("whole"),
        common("d.before", "i.before").alias("a"), common("d.after", "i.after").alias("b"),
    ).filter(F.col("whole") | (F.col("a") + F.col("n") + F.col("b") >= WINDOW))
    spans = spans.select(
        "row", "item_id", (F.col("p") - F.col("a")).alias("s"), (F.col("p") + F.col("n") + F.col("b")).alias("e")
    )
    return rows.drop("marks"), spans


def covered(spans: Column) -> Column:
    """Number of words in a sorted array of spans (s, e), overlaps counted once."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("e"))
    return F.aggregate(
        spans,
        start,
        lambda t, x: F.struct(
            (t["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], t["e"]))).alias("n"),
            F.greatest(t["e"], x["e"]).alias("e"),
        ),
        lambda t: t["n"].cast("bigint"),
    )


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each document's columns but the text, with n_words, n_hit (bigint) and item_ids (array).

    Columns that have the names of the new ones are replaced; all others pass through, whatever
    their names. What is gathered for a document is its own spans and items.
    """
    kept = docs.drop(text, "n_words", "n_hit", "item_ids")
    whole = packed(docs.select(*[f"`{c}`" for c in kept.columns], F.col(f"`{text}`").alias(f" {text}")), f" {text}")
    rows, spans = hits(whole, items, f" {text}", item_id, item_text)
    found = spans.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("s", "e"))).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
    )
    found = found.select("row", covered(F.col("spans")).alias("n_hit"), "item_ids")
    joined = rows.join(found, "row", "left")
    return joined.select(
        *unpacked(joined.select("given"), kept),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )
