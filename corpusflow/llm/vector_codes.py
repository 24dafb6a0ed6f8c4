"""Codes of vectors by parts, learned by Lloyd's rounds over members that stay where they live.

Vectors become whole numbers and are cut into equal parts. Each part position has a codebook of
its own. A part lives at a home (position, entry, salt), dealt to partitions by a hash of the
three. In a round every owner assigns its resident members anew; those whose entry changes travel
to their new home in one shuffle, the others stay in their partition. Owners then sum up their
residents, and the sums of all homes, one row for each entry, give the next codebooks.

The salt is a run of at most `HOME_MEMBERS` rows of one input partition, so a home holds at most
that many members however many vectors share an entry. Resident members and arrivals have one
partitioner, so Spark joins them without moving the residents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.runtime import prepare, shuffle_partitions
from corpusflow.llm.wordhash import mix, seeded
from corpusflow.sources.scratch import CHECKPOINT_SETTING, scratch_dir, stage

SCALE = 4096
#: Whole numbers are kept within this bound, so that 64-bit sums of squares can't overflow.
LARGEST = 1 << 27
HOME_BITS = 12
HOME_MEMBERS = 1 << HOME_BITS
#: Bytes of parts per partition that the number of partitions aims at.
PARTITION_BYTES = 64 << 20
#: Lineage is cut after so many rounds.
ROUNDS_PER_CHECKPOINT = 3

Home = tuple[int, int, int]
Books = list[np.ndarray]


def cuts_of(width: int, parts: int) -> list[int]:
    """Where the parts begin and end. Widths that `parts` doesn't divide give parts of two sizes."""
    return [width * p // parts for p in range(parts + 1)]


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int32)


def nearest(members: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lowest among equals, and its squared distance."""
    away = np.zeros((len(members), len(book)), np.int64)
    for component in range(members.shape[1]):
        step = members[:, component, None].astype(np.int64) - book[None, :, component]
        away += step * step
    entry = away.argmin(axis=1)
    return entry, away[np.arange(len(members)), entry]


def pack(ids: np.ndarray, members: np.ndarray) -> bytes:
    return ids.astype(np.int64).tobytes() + np.ascontiguousarray(members, np.int32).tobytes()


def unpack(block: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    rows = len(block) // (8 + 4 * width)
    return np.frombuffer(block, np.int64, rows), np.frombuffer(block, np.int32, rows * width, 8 * rows).reshape(rows, width)


def by_entry(entry: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each entry in use with the rows that have it."""
    order = np.argsort(entry, kind="stable")
    starts = np.flatnonzero(np.diff(entry[order], prepend=-1))
    for rows in np.split(order, starts[1:]) if len(order) else ():
        yield int(entry[rows[0]]), rows


def home_hash(home: Home) -> int:
    """Where a home lies. Independent of Python's own hash, and alike on all machines."""
    position, entry, salt = home
    mixed = mix(np.array([salt], np.uint64) * seeded(7) + np.array([position * 65_536 + entry], np.uint64))
    return int(mixed[0] >> np.uint64(2))


def first_homes(books: Books, cuts: list[int]) -> Callable:
    """Rows (rid, vector) to blocks of members at their first homes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def blocks(ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple]:
            for position, book in enumerate(books):
                members = vectors[:, cuts[position] : cuts[position + 1]]
                for entry, rows in by_entry(nearest(members, book)[0]):
                    yield position, entry, int(ids[0]) >> HOME_BITS, pack(ids[rows], members[rows])

        def flushed() -> pa.RecordBatch:
            ids, vectors = (np.concatenate(c) for c in zip(*held))
            held.clear()
            columns = list(zip(*blocks(ids, vectors)))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["position", "entry", "salt", "block"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            vectors = whole_numbers(batch.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), cuts[-1])
            edges = np.flatnonzero(np.diff(ids >> HOME_BITS)) + 1
            for some, those in zip(np.split(ids, edges), np.split(vectors, edges)):
                if held and len(some) and held[0][0][0] >> HOME_BITS != some[0] >> HOME_BITS:
                    yield flushed()
                if len(some):
                    held.append((some, those))
        if held:
            yield flushed()

    return deal


def merged(blocks: Iterator[tuple[Home, bytes]], widths: list[int]) -> Iterator[tuple[Home, bytes]]:
    """One block for each home: the residents, then those that arrived."""
    homes: dict[Home, list[bytes]] = {}
    for home, block in blocks:
        homes.setdefault(home, []).append(block)
    for home, held in homes.items():
        if len(held) > 1:
            ids, members = zip(*(unpack(b, widths[home[0]]) for b in held))
            held = [pack(np.concatenate(ids), np.concatenate(members))]
        yield home, held[0]


def sums(blocks: Iterator[tuple[Home, bytes]], widths: list[int]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """Members of each entry: their number, then their sum."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for (position, entry, _), block in blocks:
        ids, members = unpack(block, widths[position])
        own = np.concatenate(([len(ids)], members.sum(axis=0, dtype=np.int64)))
        total[position, entry] = total.get((position, entry), 0) + own
    yield from total.items()


def reassigned(blocks: Iterator[tuple[Home, bytes]], books: Books) -> Iterator[tuple[bool, tuple[Home, bytes]]]:
    """Members at the home of their nearest entry, and whether they have to go there."""
    for (position, at, salt), block in blocks:
        ids, members = unpack(block, books[position].shape[1])
        for entry, rows in by_entry(nearest(members, books[position])[0]):
            yield entry != at, ((position, entry, salt), pack(ids[rows], members[rows]))


def moved(state: RDD, books: Books, deal: Callable[[RDD], RDD], widths: list[int]) -> tuple[RDD, RDD]:
    """The members at their new homes, and the marked blocks to be dropped once those are computed."""
    marked = state.mapPartitions(lambda b: reassigned(b, books), preservesPartitioning=True)
    marked.persist(StorageLevel.MEMORY_AND_DISK)
    stay = marked.mapPartitions(lambda b: (x for go, x in b if not go), preservesPartitioning=True)
    arrive = deal(marked.mapPartitions(lambda b: (x for go, x in b if go)))
    return stay.union(arrive).mapPartitions(lambda b: merged(b, widths), preservesPartitioning=True), marked


def learn(state: RDD, books: Books, deal: Callable[[RDD], RDD], rounds: int) -> tuple[RDD, Books]:
    """Members at their homes of the last round, and the codebooks that follow from them."""
    widths = [b.shape[1] for b in books]
    spare: list[RDD] = []
    for turn in range(1, rounds + 1):
        if turn > 1:
            before = state
            state, marked = moved(before, books, deal, widths)
            spare = [before, marked]
        state.persist(StorageLevel.MEMORY_AND_DISK)
        if turn % ROUNDS_PER_CHECKPOINT == 0:
            state.checkpoint()
        books = [b.copy() for b in books]
        for (position, entry), total in state.mapPartitions(lambda b: sums(b, widths)).reduceByKey(np.add).collect():
            books[position][entry] = total[1:] // total[0]
        for old in spare:
            old.unpersist()
    return state, books


def final_codes(books: Books) -> Callable:
    """Blocks to rows (rid, position, entry, away) under the last codebooks."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for position, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, members = unpack(block, books[position].shape[1])
                entry, away = nearest(members, books[position])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.full(len(ids), position, np.int32)), pa.array(entry.astype(np.int32)), pa.array(away)],
                    ["rid", "position", "entry", "away"],
                )

    return assign


def books_text(books: Books) -> str:
    """All components in decimal: by part, entry and place within the part, joined by commas."""
    return ",".join(str(int(x)) for book in books for x in book.reshape(-1))


EMPTY_CODES = "rid bigint, position int, entry int, away bigint"


def encode(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6
) -> tuple[DataFrame, Books]:
    """Columns key, label, codes (array of entries), error; and the codebooks.

    Each component x counts as floor(4096 x). Codebooks start as the parts of the `entries` kept
    rows with the smallest keys; among equal keys the smaller vector comes first, null keys come
    last. With fewer kept rows the codebooks have so many entries. An entry without members stays.

    Left out are vectors that are null or hold a null, NaN or infinite component, and vectors of
    another length than the first kept row's, which no codebook fits. Components beyond +-32,768
    count as that. Repeated rows are rows of their own. An empty table gives no rows and no
    codebooks. Further columns are not returned, so their names don't matter.

    To the driver come `entries` rows and one row of sums for each entry and round. Rounds move
    only members whose entry changed; their lineage is cut by checkpoint() in the shared folder.
    """
    spark = df.sparkSession
    prepare(spark)
    if not spark.conf.get(CHECKPOINT_SETTING, None):
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "rounds"))
    unfit = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = df.select(F.col(key).alias("k"), F.col(label).alias("g"), F.col(vector).alias("v")).filter(F.col("v").isNotNull() & ~unfit)
    smallest = kept.select("k", "v").orderBy(F.col("k").asc_nulls_last(), "v").limit(entries)
    width = len((smallest.first() or {"v": []})["v"])
    fit = stage(kept.filter(F.size("v") == width).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    first = [whole_numbers(np.array(r["v"], np.float64)) for r in fit.select("k", "v").orderBy(F.col("k").asc_nulls_last(), "v").limit(entries).collect()]
    cuts = cuts_of(width, parts)
    named = [F.col("k").alias(key), F.col("g").alias(label)]
    if not first:
        return fit.select(*named, F.lit(None).cast("array<int>").alias("codes"), F.lit(0).cast("bigint").alias("error")).limit(0), []
    start = np.stack(first).astype(np.int64)
    books = [start[:, a:b] for a, b in zip(cuts, cuts[1:])]

    size = fit.count() * (8 * parts + 4 * width)
    partitions = max(shuffle_partitions(spark), -(-size // PARTITION_BYTES))

    def deal(blocks: RDD) -> RDD:
        return blocks.partitionBy(partitions, home_hash)

    dealt = fit.select("rid", F.col("v").cast("array<double>")).mapInArrow(
        first_homes(books, cuts), "position int, entry int, salt bigint, block binary"
    )
    state = deal(dealt.rdd.map(lambda r: ((r.position, r.entry, r.salt), bytes(r.block))))
    state, books = learn(state, books, deal, rounds)
    blocks = spark.createDataFrame(state.map(lambda x: (x[0][0], x[1])), "position int, block binary", verifySchema=False)
    found = blocks.mapInArrow(final_codes(books), EMPTY_CODES).groupBy("rid").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda x: x["entry"]).alias("codes"),
        F.sum("away").alias("error"),
    )
    codes = stage(fit.select("rid", "k", "g").join(found, "rid").select(*named, "codes", "error"), "codes")
    state.unpersist()
    return codes, books


def books_digest(books: Books) -> str:
    return hashlib.sha256(books_text(books).encode("ascii")).hexdigest()
