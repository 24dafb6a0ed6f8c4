"""Byte-level BPE by monoid tree reduction: encoding joins halves, decoding concatenates.

The monoid: its elements are token sequences that the merge rules give for their bytes, its unit
is the empty sequence, and `join` gives the sequence of the concatenated bytes. `join` never
encodes both sides again. It encodes a window around the seam and doubles the window on a side
until the tokens beyond it cannot change.

Why that is exact: merges are taken by rank, the leftmost first, and a merge inside one token
never depends on bytes beyond it. If two tokens encoded together come back as the same two, no
merge ever crosses their seam, whatever lies further out. A sequence in which each pair of
neighbours has this property is therefore the sequence of the whole. Pairs inside an encoded side
have it already, so only the two seams of the window are tested.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_BYTES = 8
CACHE_ENTRIES = 150_000
PIECE_ENTRIES = 150_000
CACHED_BYTES = 64


class Memo(dict):
    """Results by argument in two generations of bounded size; what is in use moves on."""

    def __init__(self, function, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.function, self.entries, self.old = function, entries, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.function(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        if len(key) <= CACHED_BYTES:
            self[key] = found
        return found


class BytePairTree:
    """Encoder and decoder for one table of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = np.full(max(ranks.values()) + 1, None, object)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.leaves = Memo(self.merge)
        self.kept_apart = Memo(self.merges_apart)

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token. A pre-token that is itself a token is that token."""
        whole = self.ranks.get(piece)
        return (whole,) if whole is not None else self.reduce(piece)

    def reduce(self, piece: bytes) -> tuple[int, ...]:
        if len(piece) <= LEAF_BYTES:
            return self.leaves[piece]
        middle = len(piece) // 2
        return self.join(self.reduce(piece[:middle]), self.reduce(piece[middle:]))

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if not left or not right:
            return left or right
        apart = self.kept_apart
        if apart[left[-1], right[0]]:
            return left + right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.leaves[b"".join(map(self.bytes_of.__getitem__, left[len(left) - i :] + right[:j]))]
            left_settled = i == len(left) or apart[left[-i - 1], window[0]]
            right_settled = j == len(right) or apart[window[-1], right[j]]
            if left_settled and right_settled:
                return left[: len(left) - i] + window + right[j:]
            i, j = i if left_settled else 2 * i, j if right_settled else 2 * j

    def merges_apart(self, pair: tuple[int, int]) -> bool:
        """True if no merge crosses the seam of the two tokens."""
        return self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == pair

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The merge rules on a few bytes: join the pair of lowest rank, the leftmost first."""
        ranks = self.ranks
        parts = [piece[k : k + 1] for k in range(len(piece))]
        pairs = [ranks.get(a + b, np.inf) for a, b in zip(parts, parts[1:])]
        while pairs:
            lowest = min(pairs)
            if lowest == np.inf:
                break
            k = pairs.index(lowest)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k < len(pairs):
                pairs[k] = ranks.get(parts[k] + parts[k + 1], np.inf)
            if k:
                pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], np.inf)
        return tuple(ranks[p] for p in parts)

    def decode(self, ids: np.ndarray) -> bytes:
        """The concatenation of the tokens' bytes. Raises IndexError for an id beyond the table."""
        return b"".join(self.bytes_of[ids].tolist())


def read_tree(path: str) -> BytePairTree:
    with open(path, "rb") as lines:
        return BytePairTree({base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)})


def made_encoder(path: str, pattern: str):
    """Text to ids, each an int32 of a byte string."""
    import regex

    tree = read_tree(path)
    split = regex.compile(pattern).findall
    known = Memo(lambda piece: np.array(tree.encode(piece.encode("utf-8")), np.int32).tobytes(), PIECE_ENTRIES)
    return lambda text: b"".join(map(known.__getitem__, split(text)))


@functools.lru_cache(maxsize=4)
def tree_of(path: str) -> BytePairTree:
    """The tree that a worker keeps from one task to the next."""
    return read_tree(path)


@functools.lru_cache(maxsize=4)
def encoder_of(path: str, pattern: str):
    """The encoder that a worker keeps from one task to the next, with the pieces it remembers."""
    return made_encoder(path, pattern)


def offsets_of(lengths: list[int]) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())


def encode(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", into: str = "ids", remember: bool = True
) -> DataFrame:
    """Add the array of token ids. Null and empty texts give an empty array.

    Each match of `pattern` is encoded by itself. A column that is already called `into` is
    replaced; all others pass through. Row-local: no shuffle, memory bounded by one batch and the
    pieces remembered. Workers keep those for their next tasks; without `remember` they start anew
    in each task and hold none when other work follows.
    """
    encoder = encoder_of if remember else made_encoder

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode_text = encoder(ranks_path, pattern)
        for texts in batches:
            ids = [encode_text(t) if t else b"" for t in texts.to_pylist()]
            values = pa.array(np.frombuffer(b"".join(ids), np.int32))
            yield pa.ListArray.from_arrays(offsets_of([len(i) // 4 for i in ids]), values)

    return df.withColumn(into, ids_of(F.col(text)))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", into: str = "bytes", remember: bool = True) -> DataFrame:
    """Add the bytes that the ids stand for. A null array gives no bytes."""
    table = tree_of if remember else read_tree

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tree = table(ranks_path)
        for arrays in batches:
            values = arrays.flatten().to_numpy()
            ends = np.cumsum([0 if n is None else n for n in pc.list_value_length(arrays).to_pylist()]).tolist()
            yield pa.array([tree.decode(values[a:b]) for a, b in zip([0, *ends], ends)], pa.binary())

    return df.withColumn(into, bytes_of(F.col(ids)))
