"""Words, their hashes and n-gram hashes of many texts at once, as numpy arrays."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Texts are joined up to so many bytes for one call; a longer text is a call of its own.
BLOCK_BYTES = 1 << 18

SPACE, WORD, MARK = 0, 1, 2


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower-case form of each byte. Words are digits, Latin letters and all bytes
    beyond ASCII; marks are the other printable characters."""
    kind = np.full(256, MARK, np.uint8)
    kind[:33] = SPACE
    kind[127] = SPACE
    lower = np.arange(256, dtype=np.uint8)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kind[low:high] = WORD
    lower[65:91] += 32
    return kind, lower


KIND, LOWER = _byte_tables()


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return powers(BASE), powers(INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers; equal numbers stay equal."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(seed: int) -> np.uint64:
    return mix(np.array([(seed + 1) * BASE % (1 << 64)], np.uint64))[0]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end)."""
    size = 1 << max(16, int(len(data)).bit_length())
    power, inverse = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """Tokens of several texts in order: hash, text number, kind, byte range in the joined data."""

    hashes: np.ndarray
    owner: np.ndarray
    kinds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    raw: np.ndarray
    bounds: np.ndarray


def read_words(texts: list[bytes], marks: bool = False) -> Words:
    """Lower-cased words; with `marks` also runs of other printable characters."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = KIND[raw]
    if not marks:
        kind = kind * (kind == WORD)
    change = np.flatnonzero(np.diff(kind, prepend=0, append=0))
    starts, ends = change[:-1], change[1:]
    real = kind[starts] != SPACE if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    hashes = run_hashes(LOWER[raw], starts, ends)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    return Words(hashes, owner, kind[starts] if len(starts) else np.zeros(0, np.uint8), starts, ends, raw, bounds)


def ngrams(hashes: np.ndarray, owner: np.ndarray, offsets: tuple[int, ...], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens at p + each offset, for every p where all lie in one text."""
    last = len(hashes) - offsets[-1]
    if last <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, owner.dtype)
    total = np.full(last, seeded(seed), np.uint64)
    for place, offset in enumerate(offsets):
        total += hashes[offset : offset + last] * seeded(1000 + place)
    inside = owner[:last] == owner[offsets[-1] :]
    return mix(total[inside]), owner[:last][inside]
