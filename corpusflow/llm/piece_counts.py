"""Token counts of a SentencePiece BPE model by rank-synchronous merging of ragged arrays.

A batch of pre-tokens lies in one flat array of symbols. Each round looks up the ranks of all
neighbouring pairs at once, finds every sequence's lowest rank with a segmented minimum, merges
that pair in all sequences together, and drops the sequences that are done. What survives is
counted; a character outside the vocabulary counts its UTF-8 bytes. Long sequences are merged in
rounds of one rank as well, but only what a merge has changed is looked up again.

Texts are cut before a space mark that follows another character. No piece holds a space mark
after another character, so no merge crosses such a cut.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.runtime import slices

SPACE = "▁"
CACHE_ENTRIES = 300_000
CACHED_CHARS = 64
#: Sequences up to so many symbols are merged by whole rounds; both ways give the same counts.
SHORT_SYMBOLS = 64
NONE = np.iinfo(np.int64).max


class PieceMerges:
    """Ranks and results of all merges, as sorted arrays."""

    def __init__(self, pieces: dict[str, float]):
        """`pieces`: the mergeable pieces and their scores; a higher score merges earlier."""
        self.ids = {piece: i for i, piece in enumerate(pieces)}
        self.width = len(pieces) + 1
        order = {score: i for i, score in enumerate(sorted(set(pieces.values()), reverse=True))}
        keys, ranks, merged = [], [], []
        for piece, score in pieces.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.width + b)
                    ranks.append(order[score])
                    merged.append(self.ids[piece])
        by_key = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[by_key]
        self.ranks = np.array(ranks, np.int64)[by_key]
        self.merged = np.array(merged, np.int64)[by_key]
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("a piece holds a space mark after another character")

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE where the pair doesn't merge) and index of the merge. -1: no piece."""
        if not len(self.keys):
            return np.full(len(left), NONE), np.zeros(len(left), np.int64)
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], NONE), at

    def count(self, words: list[str]) -> np.ndarray:
        """Tokens of each word."""
        lengths = np.array([len(w) for w in words], np.int64)
        joined = "".join(words)
        symbols = np.array([self.ids.get(c, -1) for c in joined], np.int64)
        # Tokens beyond one that a character outside the vocabulary costs; it never merges.
        more = np.array([len(c.encode()) - 1 if s < 0 else 0 for c, s in zip(joined, symbols)], np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = np.bincount(owner, more, len(words)).astype(np.int64)
        short = (lengths <= SHORT_SYMBOLS)[owner]
        self.merge_together(symbols[short], owner[short], counts)
        self.merge_by_rank(symbols[~short], owner[~short], counts)
        return counts

    def merge_together(self, symbols: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> None:
        while len(symbols):
            pair = owner[:-1] == owner[1:]
            ranks, at = self.look_up(symbols[:-1], symbols[1:])
            ranks = np.append(np.where(pair, ranks, NONE), NONE)
            starts = np.flatnonzero(np.append(True, ~pair))
            lowest = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            done = lowest == NONE
            counts[owner[starts[done]]] += sizes[done]
            hit = np.flatnonzero((ranks == np.repeat(lowest, sizes)) & (ranks != NONE))
            first = hit[np.unique(owner[hit], return_index=True)[1]]
            symbols[first] = self.merged[at[first]]
            keep = ~np.repeat(done, sizes)
            keep[first + 1] = False
            symbols, owner = symbols[keep], owner[keep]

    def merge_by_rank(self, symbols: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> None:
        """The same for long sequences, all of them together, without looking at what didn't change.

        Places wait in buckets by the rank of their pair. A round takes the lowest rank: all its
        places are merged at once, the left one of two that share a symbol first. Only the pairs
        around merged places get new ranks. Where a merge makes a pair of the same or a lower rank,
        the sequence's later places wait, since that pair comes first.
        """
        size = len(symbols)
        if not size:
            return
        following = np.append(np.where(owner[1:] == owner[:-1], np.arange(1, size), -1), -1)
        preceding = np.append(-1, np.where(owner[1:] == owner[:-1], np.arange(size - 1), -1))
        alive = np.ones(size, bool)
        rank, at = np.full(size, NONE), np.zeros(size, np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def look_again(places: np.ndarray) -> None:
            places = places[following[places] >= 0]
            if not len(places):
                return
            rank[places], at[places] = self.look_up(symbols[places], symbols[following[places]])
            places = places[rank[places] != NONE]
            by_rank = places[np.argsort(rank[places], kind="stable")]
            for some in np.split(by_rank, np.flatnonzero(np.diff(rank[by_rank])) + 1):
                if len(some):
                    wait(int(rank[some[0]]), some)

        def wait(lowest: int, places: np.ndarray) -> None:
            if lowest not in waiting:
                waiting[lowest] = []
                heapq.heappush(ranks, lowest)
            waiting[lowest].append(places)

        look_again(np.arange(size))
        while ranks:
            lowest = heapq.heappop(ranks)
            places = np.unique(np.concatenate(waiting.pop(lowest)))
            places = places[alive[places] & (rank[places] == lowest)]
            if not len(places):
                continue
            # Of places in a row, each sharing a symbol with the next, every other one is merged.
            joined = np.append(False, following[places[:-1]] == places[1:])
            run = np.arange(len(places))
            run -= np.maximum.accumulate(np.where(joined, 0, run))
            chosen = places[run % 2 == 0]
            made = self.merged[at[chosen]]
            right = following[chosen]
            before, after = preceding[chosen], following[right]
            left = np.where(before >= 0, symbols[before], -1)
            touching = np.append(False, right[:-1] == before[1:])
            left[touching] = made[:-1][touching[1:]]
            new = np.minimum(
                self.look_up(left, made)[0], self.look_up(made, np.where(after >= 0, symbols[after], -1))[0]
            )
            first = np.flatnonzero(new <= lowest)
            if len(first):
                # Per sequence: the first place that makes such a pair; what lies behind it waits.
                hasty, where = np.unique(owner[chosen[first]], return_index=True)
                last = chosen[first[where]]
                seat = np.minimum(np.searchsorted(hasty, owner[places]), len(hasty) - 1)
                later = (hasty[seat] == owner[places]) & (places > last[seat])
                wait(lowest, places[later])
                seat = np.minimum(np.searchsorted(hasty, owner[chosen]), len(hasty) - 1)
                now = ~((hasty[seat] == owner[chosen]) & (chosen > last[seat]))
                chosen, made, right, after = chosen[now], made[now], right[now], after[now]
            symbols[chosen] = made
            alive[right], rank[right], rank[chosen] = False, NONE, NONE
            following[chosen] = after
            preceding[after[after >= 0]] = chosen[after >= 0]
            around = preceding[chosen]
            look_again(np.unique(np.concatenate((chosen, around[around >= 0]))))
        counts += np.bincount(owner[alive], minlength=len(counts)).astype(np.int64)


class TokenCounter:
    """Counts tokens of texts as the model's library would encode them."""

    def __init__(self, merges: PieceMerges):
        self.merges = merges
        self.known: dict[str, int] = {}  # two generations of bounded size
        self.old: dict[str, int] = {}

    @staticmethod
    def words(text: str) -> list[str]:
        """Pre-tokens: the text after a leading space mark, cut before each run of marks."""
        parts = text.replace(SPACE, " ").split(" ")
        if "" not in parts:
            return parts
        out, marks = [], 0  # an empty part stands for a further mark before the next word
        for part in parts:
            if part:
                out.append(SPACE * marks + part)
                marks = 0
            else:
                marks += 1
        if marks:
            out.append(SPACE * (marks - 1))
        return out

    def count(self, texts: list[str]) -> list[int]:
        split = [self.words(t) if t else [] for t in texts]
        words = set().union(*split)
        if len(self.known) + len(words) > CACHE_ENTRIES:
            self.old, self.known = self.known, {}
        known, old = self.known, self.old
        missing = words.difference(known)
        known.update((w, old[w]) for w in missing if w in old)
        new = [w for w in missing if w not in old]
        if new:
            known.update(zip(new, self.merges.count([SPACE + w for w in new]).tolist()))
        counts = [sum(map(known.__getitem__, words)) for words in split]
        for w in new:
            if len(w) > CACHED_CHARS:
                del known[w]
        return counts


@functools.lru_cache(maxsize=4)
def counter_of(path: str) -> TokenCounter:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return TokenCounter(PieceMerges({model.id_to_piece(i): model.get_score(i) for i in normal}))


BATCH_CHARS = 4_000_000


def count_tokens(df: DataFrame, model_path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """Add the number of tokens (bigint). Null and empty texts have none.

    For BPE models with byte fallback, a leading space mark and no other normalisation. A column
    that is already called `into` is replaced; all others pass through. Row-local.
    """
    @F.pandas_udf("bigint")
    def tokens_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = counter_of(model_path)
        for texts in batches:
            texts = [t or "" for t in texts]
            out: list[int] = []
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                out += counter.count(texts[a:b])
            yield pd.Series(out, dtype="int64")

    return df.withColumn(into, tokens_of(F.col(text)))
