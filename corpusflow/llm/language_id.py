"""Language identification by compression: the language whose sample shrinks a text most.

Each language has a raw-content zstandard dictionary, cut from a bounded sample of labelled rows.
A text, in lower case, is compressed once with each; the smallest result names the language. Where
the runner-up is nearly as small the answer is marked as rejected.

A longer dictionary holds more of any text, so results compare only between dictionaries of one
size. Languages with enough labelled text have one size. A rare language, with less than half of
the longest sample, challenges the best of the others: that one's dictionary is cut to the rare
one's size for this comparison alone, so rare languages change nothing for the rest. A dictionary of a
few rows tells little; below `LEAST_BYTES` it has to win clearly.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
LEAST_BYTES = 16_384
CLEAR_MARGIN = 0.05


def learn(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_rows: int = 400,
    slice_chars: int = 512,
) -> dict[str, bytes]:
    """Dictionary content per language, from about `sample_rows` rows of each.

    The bound: every language gives `sample_rows` rows in expectation, of each at most
    `slice_chars` characters, so the driver gets languages x 200 KB. Rows are chosen by a hash of
    the key, so the choice doesn't depend on partitioning. Rows with null text, language or key
    teach nothing. A table without such rows gives no language.
    """
    usable = df.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).filter(
        "k is not null and t is not null and l is not null"
    )
    rows = {r["l"]: r["n"] for r in usable.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not rows:
        return {}
    draw = F.pmod(F.xxhash64(F.col("k"), F.lit("language sample")), F.lit(1 << 30))
    shares = [F.lit(x) for name, n in rows.items() for x in (name, int(min(1.0, sample_rows / n) * (1 << 30)))]
    share = F.try_element_at(F.create_map(*shares), F.col("l"))
    start = F.pmod(F.xxhash64(F.col("k"), F.lit("offset")), F.greatest(F.lit(1), F.length("t") - slice_chars)) + 1
    sample = usable.withColumn("d", draw).filter(F.col("d") < share)
    sample = sample.select("l", "d", F.substring("t", start.cast("int"), F.lit(slice_chars)).alias("t"))
    parts: dict[str, list[str]] = {name: [] for name in rows}
    for row in sorted(sample.collect(), key=lambda r: (r["l"], r["d"], r["t"])):
        parts[row["l"]].append(row["t"])
    contents = {name: "\n".join(texts).lower().encode("utf-8") for name, texts in sorted(parts.items())}
    longest = max(map(len, contents.values()))
    size = min(len(c) for c in contents.values() if 2 * len(c) >= longest)
    return {name: content[:size] for name, content in contents.items() if content}


class Judge:
    """Finds the language of texts by dictionary contents. Compressors are made when needed."""

    def __init__(self, contents: tuple[tuple[str, bytes], ...], level: int):
        self.contents, self.level = dict(contents), level
        self.size = max((len(c) for c in self.contents.values()), default=0)
        self.common = sorted(n for n, c in self.contents.items() if len(c) == self.size)
        self.rare = sorted((n for n in self.contents if n not in self.common), key=lambda n: (-len(self.contents[n]), n))
        self.made: dict[tuple[str, int], object] = {}

    def length(self, data: bytes, name: str, size: int) -> int:
        """Compressed length with the first `size` bytes of a language's content."""
        import zstandard

        if (name, size) not in self.made:
            content = self.contents[name][:size]
            if len(content) < 8:  # too short for a dictionary
                self.made[name, size] = zstandard.ZstdCompressor(level=self.level)
            else:
                held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=self.level)
                self.made[name, size] = zstandard.ZstdCompressor(level=self.level, dict_data=held)
        return len(self.made[name, size].compress(data))

    def name(self, text: str) -> tuple[str, float]:
        """The language, and the least margin by which it won."""
        data = text.lower().encode("utf-8")
        sizes = sorted((self.length(data, n, self.size), n) for n in self.common)
        best, margin = sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
        for other in self.rare:
            size = len(self.contents[other])
            own, theirs = self.length(data, best, size), self.length(data, other, size)
            if theirs < own * (1.0 if size >= LEAST_BYTES else 1.0 - CLEAR_MARGIN):
                best, margin = other, 1.0 - theirs / own
            else:
                margin = min(margin, max(0.0, 1.0 - own / theirs))
        return best, margin


@functools.lru_cache(maxsize=4)
def judge_of(contents: tuple[tuple[str, bytes], ...], level: int) -> Judge:
    return Judge(contents, level)


def identify(
    df: DataFrame,
    contents: dict[str, bytes],
    text: str = "text",
    into: str = "language",
    level: int = 5,
    least_margin: float = 0.01,
) -> DataFrame:
    """Add a struct (lang string, score double, rejected boolean).

    score = 1 - smallest size / second smallest size, from 0 to 1, and the least of these where rare
    languages were compared too; with a single language it is 1. `rejected` is true where the score is below `least_margin`. Null texts and texts without a
    letter are `und`, score 0, rejected; so is every text if nothing was learned. Ties go to the
    first name in order. A column called `into` is replaced, others pass through. Row-local.
    """
    packed = tuple(sorted(contents.items()))

    def name(text: str) -> tuple[str, float, bool]:
        lang, score = judge_of(packed, level).name(text)
        return lang, score, score < least_margin

    @F.pandas_udf("lang string, score double, rejected boolean")
    def language_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lettered in batches:
            rows = [
                name(t) if packed and ok and t is not None else (UNDETERMINED, 0.0, True)
                for t, ok in zip(texts, lettered)
            ]
            yield pd.DataFrame(rows, columns=["lang", "score", "rejected"])

    return df.withColumn(into, language_of(F.col(text), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))))
