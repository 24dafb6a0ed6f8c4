"""What each of several filters removes, by itself and in every order.

Texts are measured by a byte transducer: each byte's class and the state before it select, from
one table, what the byte does (a word begins or ends here, a code point, a capital, a symbol) and
the next state. Words are put into an open-addressing hash table as spans of the text; an entry
counts as the same word only if its bytes are the same, so equal hashes decide nothing.

The audit never sorts or collects documents. Each becomes a set of failed filters, sets are counted
per part, and every order's figures follow from those counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.runtime import prepare, slices
from corpusflow.llm.wordhash import BLOCK_BYTES, mix, seeded
from corpusflow.sources.scratch import stage

# Byte classes, and the states a byte leaves behind. The last three await so many further bytes.
BLANK, CAPITAL, SYMBOL, PLAIN, LEAD2, LEAD3, LEAD4, TRAIL = range(8)
GAP, WORD, WAIT1, WAIT2, WAIT3 = range(5)
# What a byte does.
BEGINS, ENDS, POINT, IS_CAPITAL, IS_SYMBOL = (1 << k for k in range(5))
#: The longest character.
MOST_TRAILS = 3


def byte_classes() -> np.ndarray:
    classes = np.full(256, PLAIN, np.uint8)
    classes[[32, *range(9, 14)]] = BLANK
    classes[65:91] = CAPITAL
    classes[list(b"#$%&*|")] = SYMBOL
    for low, kind in ((0x80, TRAIL), (0xC0, LEAD2), (0xE0, LEAD3), (0xF0, LEAD4)):
        classes[low:] = kind
    return classes


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state and actions, by state and class. A trail byte that no character awaits counts as
    a character by itself."""
    after = np.zeros((5, 8), np.uint8)
    does = np.zeros((5, 8), np.uint8)
    plain = {BLANK: GAP, CAPITAL: WORD, SYMBOL: WORD, PLAIN: WORD, LEAD2: WAIT1, LEAD3: WAIT2, LEAD4: WAIT3, TRAIL: WORD}
    for state in range(5):
        for kind, following in plain.items():
            action = POINT | {CAPITAL: IS_CAPITAL, SYMBOL: IS_SYMBOL}.get(kind, 0)
            if kind == TRAIL and state >= WAIT1:
                following, action = state - 1, 0
            if (state == GAP) != (following == GAP):
                action |= BEGINS if state == GAP else ENDS
            after[state, kind], does[state, kind] = following, action
    return after, does


CLASS = byte_classes()
AFTER, DOES = transitions()


def run(classes: np.ndarray) -> np.ndarray:
    """State after each byte, beginning in a gap. All classes but TRAIL lead to one state from
    anywhere, so only trail bytes look back, at most as far as a character is long."""
    states = AFTER[GAP][classes]
    trails = np.flatnonzero(classes == TRAIL)
    trails = trails[trails > 0]
    for _ in range(MOST_TRAILS):
        states[trails] = AFTER[states[trails - 1], TRAIL]
    return states


class SpanTable:
    """Open addressing over byte ranges of one block. A text's words are told apart from another's."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, bits: int = 64):
        self.owner, self.bits = owner, bits
        self.sizes = ends - starts
        # Eight bytes at a time; what lies beyond a word's end is masked.
        padded = np.concatenate((raw, np.zeros(8, np.uint8)))
        eights = np.ndarray(len(raw) + 1, "<u8", padded.data, strides=(1,))
        self.pieces = -(-self.sizes // 8)
        self.first = np.concatenate(([0], np.cumsum(self.pieces)))
        place = np.arange(self.first[-1]) - np.repeat(self.first[:-1], self.pieces)
        values = eights[np.repeat(starts, self.pieces) + 8 * place]
        left = np.repeat(self.sizes, self.pieces) - 8 * place
        short = left < 8
        values[short] &= (np.uint64(1) << (np.uint64(8) * left[short].astype(np.uint64))) - np.uint64(1)
        self.values, self.place = values, place

    def hashes(self) -> np.ndarray:
        parts = mix(self.values + mix(self.place.astype(np.uint64) + seeded(3)))
        whole = np.add.reduceat(parts, self.first[:-1]) if len(self.sizes) else np.zeros(0, np.uint64)
        hashed = mix(whole + self.sizes.astype(np.uint64) + self.owner.astype(np.uint64) * seeded(5))
        return hashed >> np.uint64(64 - self.bits) if self.bits < 64 else hashed

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words a and b are of one text and equal byte for byte."""
        alike = (self.owner[a] == self.owner[b]) & (self.sizes[a] == self.sizes[b])
        some = np.flatnonzero(alike)
        pieces = self.pieces[a[some]]
        if not len(some):
            return alike
        starts = np.concatenate(([0], np.cumsum(pieces)))
        within = np.arange(starts[-1]) - np.repeat(starts[:-1], pieces)
        differ = self.values[np.repeat(self.first[a[some]], pieces) + within] != self.values[np.repeat(self.first[b[some]], pieces) + within]
        alike[some] = np.add.reduceat(differ, starts[:-1], dtype=np.int64) == 0
        return alike

    def distinct(self) -> np.ndarray:
        """The words that are the first of their kind in the table, by index."""
        size = 1 << max(4, int(2 * len(self.sizes)).bit_length())
        table = np.full(size, -1, np.int64)
        waiting = np.arange(len(self.sizes))
        slot = (self.hashes() & np.uint64(size - 1)).astype(np.int64)
        kept = []
        while len(waiting):
            free = table[slot] < 0
            table[slot[free]] = waiting[free]
            there = table[slot]
            owns = there == waiting
            kept.append(waiting[owns])
            rest = ~owns
            rest[rest] = ~self.same(waiting[rest], there[rest])
            waiting, slot = waiting[rest], (slot[rest] + 1) & (size - 1)
        return np.concatenate(kept) if kept else waiting


MEASURES = ("words", "distinct_words", "code_points", "capitals", "symbols")


def measure(texts: list[bytes], bits: int = 64) -> np.ndarray:
    """Measures by text, in the order of `MEASURES`. `bits` of the hashes are used."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    classes = CLASS[raw]
    states = run(classes)
    before = np.concatenate((np.zeros(1, np.uint8), states[:-1]))
    actions = DOES[before, classes]

    def per_text(places: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(places, bounds))

    starts, ends = np.flatnonzero(actions & BEGINS), np.flatnonzero(actions & ENDS)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    firsts = SpanTable(raw, starts, ends, owner, bits).distinct()
    points = np.add.reduceat((actions & POINT) != 0, bounds[:-1], dtype=np.int64) - 1
    return np.stack([
        per_text(starts),
        np.bincount(owner[firsts], minlength=len(texts)),
        points,
        per_text(np.flatnonzero(actions & IS_CAPITAL)),
        per_text(np.flatnonzero(actions & IS_SYMBOL)),
    ], axis=1)


def measured(text: Column) -> Column:
    """Struct of `MEASURES`, each a bigint, over a whole text. A null text counts as empty.

    Memory grows with one block of texts, or with one text where it is longer.
    """

    @F.arrow_udf("struct<" + ", ".join(f"{m}: bigint" for m in MEASURES) + ">")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
            found = [measure(texts[a:b]) for a, b in slices([len(t) for t in texts], BLOCK_BYTES)]
            values = np.concatenate(found) if found else np.zeros((0, len(MEASURES)), np.int64)
            yield pa.StructArray.from_arrays([pa.array(values[:, i]) for i in range(len(MEASURES))], MEASURES)

    return of(text)


def failed_set(filters: dict[str, Column]) -> Column:
    """Bit k is set if the k-th filter's condition of failure holds; null conditions don't."""
    bits = [F.when(failing, 1 << k).otherwise(0) for k, failing in enumerate(filters.values())]
    return sum(bits[1:], bits[0]).cast("int")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column], copies: str, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step; see `effects` for the figures.

    `filters` maps a letter to its condition of failure over the struct `m` of `MEASURES`. The
    further filter `copies` fails rows whose text another row with a smaller key has too, anywhere
    in the table. Texts are held equal by SHA-256.

    Null texts are empty ones, a null part is the empty string. A null key is smaller than none and
    none is smaller than it, so it never makes or is a copy, and it has no label. Rows that repeat
    a key and text are all counted, and are no copies of each other. A key labelled twice counts as
    good or toxic if one of its labels says so. Further columns are not read, so their names don't
    matter. An empty table gives no rows.

    Texts stay in the tasks that read them; 50-byte rows are shuffled. Equal rows are summed up
    before each shuffle, so a text or label that a third of all rows share costs one row a task.
    """
    spark = docs.sparkSession
    prepare(spark)
    text_or_empty = F.coalesce(F.col(text), F.lit(""))
    letters = [*filters, copies]
    own = docs.select(
        F.col(key).alias("k"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text_or_empty.cast("binary"), 256)).alias("content"), measured(F.col(text)).alias("m"),
    )
    # Null keys have no label and no order, so they may lie anywhere.
    spread = F.when(F.col("k").isNull(), 1 + F.pmod(F.xxhash64("content"), F.lit(4096)).cast("int")).otherwise(0)
    rows = own.select("k", spread.alias("spread"), "part", "content", failed_set(filters).alias("failed"))
    rows = rows.groupBy("k", "spread", "part", "content", "failed").agg(F.count("*").alias("n"))
    said = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    ).withColumn("spread", F.lit(0))
    marked = rows.join(said, ["k", "spread"], "left").select(
        "k", "part", "content", "failed", "n",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    per_key = F.when(F.col("k").isNotNull(), F.struct("k", "n"))
    alike = stage(
        marked.groupBy("part", "content", "failed", "good", "toxic").agg(
            F.sum("n").alias("n"), F.min(per_key).alias("first"),
            F.sum(F.when(F.col("k").isNull(), F.col("n")).otherwise(0)).alias("unkeyed"),
        ),
        "alike",
    )
    smallest = alike.groupBy("content").agg(F.min("first.k").alias("least"))
    with_least = alike.join(smallest, "content")
    firsts = F.col("unkeyed") + F.when(F.col("first.k") == F.col("least"), F.col("first.n")).otherwise(0)
    bit = 1 << len(filters)
    split = F.array(
        F.struct(F.col("failed"), firsts.alias("n")),
        F.struct((F.col("failed") + bit).alias("failed"), (F.col("n") - firsts).alias("n")),
    )
    sets = with_least.select("part", "good", "toxic", F.explode(split).alias("s")).select("part", "good", "toxic", "s.*")
    return effects(sets, letters)


def effects(sets: DataFrame, letters: list[str]) -> DataFrame:
    """From rows (part, failed, n, good, toxic) to one row per part, filter_order and step.

    kept: rows left after the step; removed: rows the step takes; redundant: rows failing its
    filter that an earlier step took; unique_fails: rows failing its filter alone; good_lost and
    toxic_lost: removed rows with such a label; shapley: what its filter removes, summed over all
    orders.
    """
    subsets = range(1 << len(letters))

    def counts(name: str, weight: Column) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("failed") == s, weight)), F.lit(0)) for s in subsets]).alias(name)

    n = F.col("n")
    sets = sets.groupBy("part", "failed", "good", "toxic").agg(F.sum("n").alias("n"))
    parts = sets.groupBy("part").agg(
        counts("rows", n), counts("good", F.when(F.col("good"), n)), counts("toxic", F.when(F.col("toxic"), n))
    )
    orders = ["".join(o) for o in itertools.permutations(letters)]
    steps = parts.select("*", F.explode(F.split(F.lit(",".join(orders)), ",")).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    place = {x: F.instr("filter_order", x) for x in letters}
    before = sum((F.when(place[x] < F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(letters)), F.lit(0))
    own = sum((F.when(place[x] == F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(letters)), F.lit(0))
    steps = steps.withColumns({"before": before, "own": own})

    def total(name: str, holds) -> Column:
        """Sum of the counts of the sets for which `holds`."""
        picked = [F.when(holds(s), F.col(name)[s]).otherwise(F.lit(0).cast("bigint")) for s in subsets]
        return sum(picked[1:], picked[0])

    def fails(s: int) -> Column:
        return F.col("own").bitwiseAND(s) != 0

    def passed(s: int) -> Column:
        return F.col("before").bitwiseAND(s) == 0

    # Of all orders, in a share of one by the size of the set this filter comes first of its set.
    share = [len(orders) // max(1, s.bit_count()) for s in subsets]
    shares = [F.when(fails(s), F.col("rows")[s] * share[s]).otherwise(F.lit(0).cast("bigint")) for s in subsets]
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("rows", lambda s: passed(s) & ~fails(s)).alias("kept"),
        total("rows", lambda s: passed(s) & fails(s)).alias("removed"),
        total("rows", lambda s: ~passed(s) & fails(s)).alias("redundant"),
        total("rows", lambda s: F.col("own") == s).alias("unique_fails"),
        total("good", lambda s: passed(s) & fails(s)).alias("good_lost"),
        total("toxic", lambda s: passed(s) & fails(s)).alias("toxic_lost"),
        sum(shares[1:], shares[0]).alias("shapley"),
    )
